"""Chat formatting by token-level assembly.

Every piece of content (a text, a role) is encoded alone by a byte-level tokenizer, and the template's marks are spliced in as
reserved ids above the vocabulary, so no content can produce a mark. Lengths of the pieces give, by prefix sums, where each one
begins, and a second prefix sum over +1 and -1 at the borders of assistant texts gives the loss mask. In the formatted
string, marks are spelled out; control strings inside content are escaped there: a backslash follows their first
character, and one more is added to strings that look escaped already, so taking one away restores every text.

Template: a user turn is ``<s>[INST]text[/INST]``, an assistant turn ``text</s>``, any other role
``<<SYS>>role<</SYS>>text</s>``. Only assistant texts are under the mask.

Scale: turns are range-sorted by conversation and turn, so a conversation of any length is spread over tasks, and each task
streams its slice. Assembled rows hold consecutive turns of one conversation up to ``PART_TOKENS`` tokens (one turn at
least). Reading back, a conversation inside one slice is digested where it is; only conversations that cross a slice border or
exceed ``CHUNK`` are stored as chunks of that size and finished by a streaming pass, because SHA-256 is sequential.

Edge cases: NULL text or role is empty. A NULL ``conv_id`` is a conversation of its own. Turns that tie are ordered by role,
then text, by code point; repeated rows are repeated turns. A NULL ``turn`` comes first. A run of white space beyond 20,000
characters is encoded in pieces, which changes its tokens but not the text. An empty table gives no rows. Columns
other than ``conv_id``, ``turn``, ``role`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import durable

# The marks of the template, in the order of their reserved ids.
BEGIN, END, ASK, ASKED, ROLE, ROLED = MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
PART_TOKENS = 65_536
CHUNK = 1 << 20
_GAP = re.compile(r"\s{20000}")


def _controls(backslashes: str) -> str:
    return "|".join(f"{re.escape(m[0])}(?={backslashes}{re.escape(m[1:])})" for m in MARKS)


_ESCAPE, _UNESCAPE = re.compile(rf"({_controls(r'\\*')})"), re.compile(rf"({_controls(r'\\+')})\\")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Codec:
    """Byte-level tokenizer from a file of ranks (``base64 rank`` lines, read on the driver) and its splitting pattern.

    Marks get the ids after the largest rank. It travels as the file's content and is built once per task.
    """

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks, self.pattern, self._library = ranks, pattern, None

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def __reduce__(self):
        return Codec, (self.ranks, self.pattern)

    @property
    def library(self):
        if self._library is None:
            import tiktoken

            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.ranks.splitlines())}
            self._library = tiktoken.Encoding("chat", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            self.first_mark = max(ranks.values()) + 1
        return self._library

    def mark(self, index: int) -> int:
        assert self.library
        return self.first_mark + index

    def encode(self, text: str) -> list[int]:
        ids, at = [], 0
        for gap in _GAP.finditer(text):
            ids += self.library.encode_ordinary(text[at : gap.end()])
            at = gap.end()
        return ids + self.library.encode_ordinary(text[at:]) if at else self.library.encode_ordinary(text)

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode_bytes(ids.tolist()).decode()


def _pieces(codec: Codec, role: str, text: str) -> list[tuple[list[int], bool]]:
    """Ids of a turn's marks and contents, each with whether it is under the loss mask."""
    begin, end, ask, asked, role_mark, roled = ([codec.mark(i)] for i in range(len(MARKS)))
    body = codec.encode(escape(text))
    if role == "user":
        return [(begin, False), (ask, False), (body, False), (asked, False)]
    if role == "assistant":
        return [(body, True), (end, False)]
    return [(role_mark, False), (codec.encode(escape(role)), False), (roled, False), (body, False), (end, False)]


def assembled(pieces: list[tuple[list[int], bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and loss mask of consecutive pieces; both come from prefix sums of the lengths."""
    lengths = np.array([len(ids) for ids, _ in pieces], np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    ids = np.fromiter((i for piece, _ in pieces for i in piece), np.int32, total)
    learned = np.array([flag for _, flag in pieces], bool)
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, (ends - lengths)[learned], 1)
    np.add.at(steps, ends[learned], -1)
    return ids, np.cumsum(steps)[:total].astype(np.int8)


def assemble(turns: DataFrame, codec: Codec) -> DataFrame:
    """``(conv_id, slice, part, n_turns, token_ids, loss_mask)``, sorted by these first three; see the module's docstring."""
    kind = dict(turns.dtypes)["conv_id"]
    rows = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    # The beginning of the text is enough to spread turns that tie, the sort inside the slice takes all of it.
    rows = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        piece, part, held, n, size, conv = TaskContext.get().partitionId(), 0, [], 0, 0, None

        def row():
            ids, mask = assembled(held)
            values = [pa.array([conv], conv_type), pa.array([piece], pa.int32()), pa.array([part]), pa.array([n]), pa.array([ids]), pa.array([mask])]
            return pa.RecordBatch.from_arrays(values, ["conv_id", "slice", "part", "n_turns", "token_ids", "loss_mask"])

        for batch in batches:
            conv_type = batch.column("conv_id").type
            for at, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if n and (at != conv or size >= PART_TOKENS):
                    yield row()
                    part, held, n, size = part + 1 if at == conv else 0, [], 0, 0
                conv = at
                turn = _pieces(codec, role, text)
                held += turn
                n, size = n + 1, size + sum(len(ids) for ids, _ in turn)
        if n:
            yield row()

    return rows.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, slice int, part bigint, n_turns bigint, token_ids array<int>, loss_mask array<tinyint>")


def _segments(codec: Codec, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple[int | None, str, str]]:
    """``(mark before, content, content under the mask)`` of every stretch between marks; both contents are still escaped."""
    marks = np.flatnonzero(ids >= codec.mark(0))
    for begin, end in zip(np.concatenate(([-1], marks)), np.concatenate((marks, [len(ids)]))):
        own, learned = ids[begin + 1 : end], mask[begin + 1 : end] == 1
        before = int(ids[begin]) - codec.mark(0) if begin >= 0 else None
        content = codec.decode(own) if len(own) else ""
        yield before, content, content if learned.all() else codec.decode(own[learned]) if learned.any() else ""


def read_turns(codec: Codec, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple[str, str, str, int]]:
    """``(role, text, text under the mask, formatted characters)`` of every turn, parsed from the tokens alone."""
    role, text, learned, length = "assistant", "", "", 0
    for before, content, masked in _segments(codec, ids, mask):
        if before is not None:
            name = MARKS[before]
            length += len(name)
            if name in (END, ASKED):
                yield role, text, learned, length
                role, text, learned, length = "assistant", "", "", 0
            elif name == ASK:
                role = "user"
            elif name == ROLE:
                role = unescape(content)
                length += len(content)
                continue
        text, learned, length = unescape(content), unescape(masked), length + len(content)


def formatted(parts: DataFrame, codec: Codec) -> DataFrame:
    """``(conv_id, slice, part, text)``: the assembled rows as strings, marks spelled out."""
    kind = dict(parts.dtypes)["conv_id"]

    def run(batches):
        for batch in batches:
            out = []
            for ids in batch.column("token_ids"):
                ids = ids.values.to_numpy()
                out.append("".join(("" if before is None else MARKS[before]) + content for before, content, _ in _segments(codec, ids, np.zeros(len(ids), np.int8))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "slice", "part")), pa.array(out, pa.string())], ["conv_id", "slice", "part", "text"])

    return parts.select("conv_id", "slice", "part", "token_ids").mapInArrow(run, f"conv_id {kind}, slice int, part bigint, text string")


_SUMS = ["n_turns", "loss_chars", "formatted_chars", "n_tokens", "loss_tokens"]
_READ = "seq bigint, turns binary, loss binary, turns_sha256 string, loss_sha256 string, " + ", ".join(f"{c} bigint" for c in _SUMS)


class _Reading:
    """What has been read of one conversation: digests, and the bytes since the last chunk."""

    def __init__(self, conv, kept: bool):
        self.conv, self.crossing, self.seq = conv, kept, 0
        self.turns, self.loss = bytearray(), bytearray()
        self.sums = dict.fromkeys(_SUMS, 0)

    def row(self, done: bool) -> dict:
        """A chunk to be finished elsewhere or, if ``done`` here, the digests."""
        out = {"conv_id": self.conv, "seq": self.seq, **self.sums, "turns": None, "loss": None, "turns_sha256": None, "loss_sha256": None}
        if done:
            out |= {f"{c}_sha256": hashlib.sha256(getattr(self, c)).hexdigest() for c in ("turns", "loss")}
        else:
            out |= {"turns": bytes(self.turns), "loss": bytes(self.loss)}
        self.turns, self.loss, self.seq = bytearray(), bytearray(), self.seq + 1
        self.sums = dict.fromkeys(_SUMS, 0)
        return out


def read_back(parts: DataFrame, codec: Codec) -> DataFrame:
    """Per conversation of :func:`assemble`'s rows, from their tokens and masks alone.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, loss_tokens``.
    """
    kind = dict(parts.dtypes)["conv_id"]

    def batch_of(rows, conv_type):
        kinds = {"conv_id": conv_type, "slice": pa.int32(), "seq": pa.int64(), "turns": pa.binary(), "loss": pa.binary(), "turns_sha256": pa.string(), "loss_sha256": pa.string()}
        names = ["conv_id", "slice", "seq", "turns", "loss", "turns_sha256", "loss_sha256", *_SUMS]
        piece = TaskContext.get().partitionId()
        columns = [pa.array([piece if c == "slice" else r[c] for r in rows], kinds.get(c, pa.int64())) for c in names]
        return pa.RecordBatch.from_arrays(columns, names)

    def read(batches):
        now, out = None, []
        for batch in batches:
            conv_type = batch.column("conv_id").type
            for at, row_ids, row_mask in zip(batch.column("conv_id").to_pylist(), batch.column("token_ids"), batch.column("loss_mask")):
                if now is None or now.conv != at:
                    if now is not None:
                        out.append(now.row(done=not now.crossing))
                    now = _Reading(at, kept=now is None)  # the slice's first conversation may begin in an earlier one
                ids, mask = row_ids.values.to_numpy(), row_mask.values.to_numpy()
                now.sums["n_tokens"] += len(ids)
                now.sums["loss_tokens"] += int(mask.sum())
                for role, text, learned, length in read_turns(codec, ids, mask):
                    now.turns += f"{role}\n{text}\n".encode()
                    now.loss += learned.encode()
                    for name, value in (("n_turns", 1), ("loss_chars", len(learned)), ("formatted_chars", length)):
                        now.sums[name] += value
                    if len(now.turns) > CHUNK:
                        now.crossing = True
                        out.append(now.row(done=False))
                if len(out) > 1000 or (out and out[-1]["turns"]):
                    yield batch_of(out, conv_type)
                    out = []
        if now is not None:
            out.append(now.row(done=False))  # the last one may go on in a later slice
            yield batch_of(out, conv_type)

    def finish(batches):
        conv, digests, sums = None, None, None

        def row():
            found = {"conv_id": conv, **{f"{c}_sha256": d.hexdigest() for c, d in digests.items()}, **sums}
            return pa.RecordBatch.from_arrays([pa.array([v], conv_type if c == "conv_id" else None) for c, v in found.items()], list(found))

        for batch in batches:
            conv_type = batch.column("conv_id").type
            for r in batch.to_pylist():
                if digests is None or r["conv_id"] != conv:
                    if digests is not None:
                        yield row()
                    conv, digests, sums = r["conv_id"], {c: hashlib.sha256() for c in ("turns", "loss")}, dict.fromkeys(_SUMS, 0)
                for c, digest in digests.items():
                    digest.update(r[c])
                for c in _SUMS:
                    sums[c] += r[c]
        if digests is not None:
            yield row()

    found = durable(parts.select("conv_id", "token_ids", "loss_mask").mapInArrow(read, f"conv_id {kind}, slice int, {_READ}"))
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"]
    crossing = found.where("turns IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "slice", "seq")
    schema = f"conv_id {kind}, turns_sha256 string, loss_sha256 string, " + ", ".join(f"{c} bigint" for c in _SUMS)
    finished = crossing.select("conv_id", "turns", "loss", *_SUMS).mapInArrow(finish, schema)
    return found.where("turns IS NULL").select(*columns).unionByName(finished.select(*columns))


def with_turns(turns: DataFrame, added: list[tuple[int, int, str, str]]) -> DataFrame:
    """``conv_id, turn, role, text`` of the table and some more rows."""
    more = turns.sparkSession.createDataFrame(added, "conv_id bigint, turn bigint, role string, text string")
    return turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text").union(more)
