"""Legacy archives: ARC records to WARC records.

ARC files of version 1 and 2 hold records of one header line and as many bytes as the line declares; the two versions
have other fields in the line. The converter reads the line by its file's version, takes the declared bytes (HTTP headers
and payload) and writes a WARC record: an identifier made from the content, the ARC date as an ISO timestamp, the
record type, and base32 SHA-1 digests of block and payload. Of equal payloads one is a response and the others are
revisits that refer to it.

Scale: one task reads or writes one archive file; payloads are never shuffled and never reach the driver. Which payloads
are equal is decided on (digest, id) pairs, aggregated in every task before the shuffle; only revisits are joined back.
Files are written through Spark to the shared folder, as gzip; a lost task writes its file again.

Edge cases: NULL or empty payloads are records of length 0; a NULL or blank address is replaced by one made from the page
id; bytes that end lines or look like headers inside a payload do no harm, because lengths are declared. Repeated rows
are records of their own. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.shared import attach
from sparkmine.session import checkpoint_root

LEAST_BYTES = 0  # smaller payloads are always responses
# Header lines of the two versions of ARC files.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
_EPOCH = datetime(1996, 10, 1)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _address(url: str | None, page_id) -> str:
    url = re.sub(r"\s", lambda m: f"%{ord(m.group()):02X}", url or "")
    return url or f"urn:x-page:{page_id}"


def arc_file_head(version: int, name: str) -> bytes:
    body = f"{version} 0 legacy\n{' '.join(FIELDS[version])}\n".encode()
    middle = "text/plain" if version == 1 else "text/plain 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 19961001000000 {middle} {len(body)}\n".encode() + body


def arc_record(version: int, name: str, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """One record: header line, HTTP response head and payload."""
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\nX-Page-Id: {'' if page_id is None else page_id}\r\n\r\n".encode()
    date = (_EPOCH + timedelta(seconds=(page_id or 0) % 10**9)).strftime("%Y%m%d%H%M%S")
    middle = "text/html" if version == 1 else f"text/html 200 {hashlib.md5(payload).hexdigest()} - 0 {name}"
    return f"{_address(url, page_id)} 127.0.0.1 {date} {middle} {len(head) + len(payload)}\n".encode() + head + payload


class Stream:
    """Bytes of a gzip file, unpacked as they are asked for."""

    def __init__(self, packed: bytes, step: int = 1 << 20):
        self.parts, self.step = memoryview(packed), step
        self.unpack, self.have, self.at, self.done = zlib.decompressobj(31), bytearray(), 0, 0

    def _more(self) -> bool:
        if self.done >= len(self.parts) and not self.unpack.unused_data:
            return False
        if self.unpack.eof:  # another member
            rest = self.unpack.unused_data
            self.unpack = zlib.decompressobj(31)
            if rest:
                del self.have[: self.at]
                self.at = 0
                self.have += self.unpack.decompress(rest)
                return True
        del self.have[: self.at]
        self.at = 0
        self.have += self.unpack.decompress(self.parts[self.done : self.done + self.step])
        self.done += self.step
        return True

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        searched = 0
        while (end := self.have.find(b"\n", self.at + searched)) < 0:
            searched = len(self.have) - self.at
            if not self._more():
                rest = bytes(self.have[self.at :])
                self.at = len(self.have)
                return rest or None
        found = bytes(self.have[self.at : end])
        self.at = end + 1
        return found

    def take(self, n: int) -> bytes:
        while len(self.have) - self.at < n:
            if not self._more():
                raise ValueError("an archive ends inside a record")
        found = bytes(self.have[self.at : self.at + n])
        self.at += n
        return found


def arc_records(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of every record of an ARC file of either version."""
    stream, fields = Stream(packed), None
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode().split(" ")
        content = stream.take(int(parts[-1]))
        if fields is None:
            fields = FIELDS[int(content.split(b" ", 1)[0])]  # the first record tells the version
            continue
        if len(parts) != len(fields):
            raise ValueError(f"not a header line of this version: {line[:200]!r}")
        yield dict(zip(fields, parts)), content


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, head and payload of an HTTP response."""
    end = block.index(b"\r\n\r\n") + 4
    lines = block[: end - 4].decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines), block[:end], block[end:]


def record_id(address: str, page: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{address} {page} {digest}')}>"


def warc_record(fields: dict[str, str], content: bytes, refers_to: int | None) -> bytes:
    """The WARC record of one ARC record; with ``refers_to`` a revisit that holds the HTTP head alone."""
    headers, head, payload = split_http(content)
    date = datetime.strptime(fields["Archive-date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    digest, block = base32_sha1(payload), content if refers_to is None else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(fields['URL'], headers['X-Page-Id'], digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {fields['URL']}",
        f"WARC-IP-Address: {fields['IP-address']}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r"  # the writer ends the line


def warc_records(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every WARC record."""
    stream = Stream(packed)
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        headers = {}
        while (line := stream.line()) is not None and line.strip():
            name, value = line.decode().rstrip("\r").split(": ", 1)
            headers[name] = value
        yield headers, stream.take(int(headers["Content-Length"]))


def _written(records: DataFrame, folder: str) -> DataFrame:
    """Write one ``record`` per row and one gzip file per partition; the files as rows of ``content``."""
    # A cast keeps the bytes as they are, whatever their encoding.
    records.select(F.col("record").cast("string")).write.option("compression", "gzip").text(folder)
    return records.sparkSession.read.format("binaryFile").load(folder).select("content")


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages to ARC files, one per partition, every other one in version 2."""

    def run(batches):
        version, name = 0, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, urls, pages = (batch.column(i).to_pylist() for i in range(3))
            out = []
            if not version:
                name = f"{batch.column('part')[0].as_py():08d}.arc"
                version = 1 + batch.column("part")[0].as_py() % 2
                out.append(arc_file_head(version, name))
            for page_id, url, html in zip(ids, urls, pages):
                out.append(arc_record(version, name, page_id, url, (html or "").encode()))
                if sum(map(len, out[-64:])) > 1 << 20:
                    yield _records(out)
                    out = []
            yield _records(out)

    rows = pages.select(pages["page_id"].cast("bigint").alias("page_id"), "url", "html", F.spark_partition_id().alias("part"))
    return _written(rows.mapInArrow(run, "record binary"), folder)


def _records(found: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])


def arc_payloads(files: DataFrame) -> DataFrame:
    """``page_id, bytes, digest`` of every ARC record."""

    def run(batches):
        for batch in batches:
            for packed in batch.column("content"):
                rows = []
                for _, content in arc_records(packed.as_buffer().to_pybytes()):
                    headers, _, payload = split_http(content)
                    rows.append((int(headers["X-Page-Id"]) if headers["X-Page-Id"] else None, len(payload), base32_sha1(payload)))
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "bytes", "digest"])

    return files.mapInArrow(run, "page_id bigint, bytes bigint, digest string")


def convert(files: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Write the WARC form of ARC files; of equal payloads of at least ``least`` bytes the largest page id is the response."""
    payloads = arc_payloads(files).where((F.col("bytes") >= least) & F.col("page_id").isNotNull())
    kept = payloads.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "response")
    # Every record is looked up by its digest; the table holds repeated payloads only.
    joined = attach(_arc_rows(files), kept, "digest")
    refers = (F.col("bytes") >= least) & F.col("page_id").isNotNull() & (F.col("response") != F.col("page_id"))
    joined = joined.select("header", "content", F.when(refers, F.col("response")).alias("refers_to"))

    def run(batches):
        for batch in batches:
            out = []
            for header, content, refers_to in zip(*(batch.column(i).to_pylist() for i in range(3))):
                out.append(warc_record(dict(zip(("URL", "IP-address", "Archive-date"), header.split(" "))), content, refers_to))
                if len(out) == 64:
                    yield _records(out)
                    out = []
            yield _records(out)

    return _written(joined.mapInArrow(run, "record binary"), folder)


def _arc_rows(files: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for packed in batch.column("content"):
                rows, size = [], 0
                for fields, content in arc_records(packed.as_buffer().to_pybytes()):
                    headers, _, payload = split_http(content)
                    page = int(headers["X-Page-Id"]) if headers["X-Page-Id"] else None
                    rows.append((" ".join(fields[k] for k in ("URL", "IP-address", "Archive-date")), page, len(payload), base32_sha1(payload), content))
                    size += len(content)
                    if size > 1 << 22:
                        yield _arc_batch(rows)
                        rows, size = [], 0
                yield _arc_batch(rows)

    return files.mapInArrow(run, "header string, page_id bigint, bytes bigint, digest string, content binary")


def _arc_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["header", "page_id", "bytes", "digest", "content"])


def read_warc(files: DataFrame) -> DataFrame:
    """``page_id, record_id, payload_bytes, payload_digest, record_type, refers_to`` of every WARC record."""

    def run(batches):
        for batch in batches:
            for packed in batch.column("content"):
                rows = []
                for head, block in warc_records(packed.as_buffer().to_pybytes()):
                    page = split_http(block)[0]["X-Page-Id"]
                    refers = head.get("X-Refers-To-Page")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    rows.append((int(page) if page else None, head["WARC-Record-ID"], int(head["X-Payload-Length"]), digest, head["WARC-Type"], int(refers) if refers else None))
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return files.mapInArrow(run, "page_id bigint, record_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def through_archives(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Pages to ARC files, these to WARC files, and the WARC files read back."""
    spark = pages.sparkSession
    arc = write_arc(pages, new_folder(spark, "arc"))
    return read_warc(convert(arc, new_folder(spark, "warc"), least))
