"""Spelling variants by permuterm rotations.

A word marked with a terminator has one rotation per place. Put the edited character last: two words that differ by a
replacement have rotations that agree in everything but the last character, and a word with one more character has a
rotation that continues a whole rotation of the other one by it. So every rotation is filed under itself and under itself
without its last character; equal keys are the prefix ranges that skip the edited character. Sorting by key brings a
range together, and a scan of each range counts neighbours and keeps the best.

Scale: a word gives two rows per character, each a key with a word number and a count. A range holds at most one whole
rotation and one rotation per letter of the alphabet (90), so it is bounded whatever the input. No pairs are made: a
member's neighbours in a range are all others, and the best of them is the first or the second. A deletion out of a
run of equal characters is filed once, so no neighbour is met twice. Keys of long words are fingerprints (122 bits),
which keeps a word of n characters at 2 n short rows. Words are counted with map-side combining; forms are
followed by pointer jumping, at most log2(log2(largest count)) + 2 rounds because counts at least double on the way.

Edge cases: NULL or empty texts and texts without letters have no runs. A NULL ``doc_id`` is written as an empty string where the
checksum is taken. Runs that lose a character may become shorter than five and then are no words. Repeated rows count
as often as they occur. No word, or a word without near words, gives ``form`` NULL and itself as ``root``. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.shared import attach
from sparkmine.operators.ordering import with_row_index
from sparkmine.session import durable

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"  # marks the end of a word; no letter
LONG_KEY = 64  # longer rotations are filed by fingerprint
WHOLE, FIRST, AGAIN = 0, 1, 2  # a whole rotation; one without its last character, that opens a run of equal ones or continues it


def word_counts(docs: DataFrame, least_length: int = 5, least_count: int = 3, damage: int = 97) -> DataFrame:
    """``(word, n)`` of all texts; where ``damage`` divides a run's checksum with its document, one character is missing."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), F.col("run"))))
    place = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


class _Fingerprint:
    """Fingerprints of the rotations of one word and of their beginnings, each in constant time."""

    MODULUS, BASES = (1 << 61) - 1, (0x1D2C3B4A59687786, 0x0F1E2D3C4B5A6978)

    def __init__(self, marked: str):
        self.sums = []
        for base in self.BASES:
            sums, powers, total, power = [0], [1], 0, 1
            for c in marked + marked:
                total = (total * base + ord(c)) % self.MODULUS
                power = power * base % self.MODULUS
                sums.append(total)
                powers.append(power)
            self.sums.append((sums, powers))

    def of(self, start: int, length: int) -> str:
        parts = [(sums[start + length] - sums[start] * powers[length]) % self.MODULUS for sums, powers in self.sums]
        return f"#{length}:{parts[0]:x}:{parts[1]:x}"


def rotation_keys(word: str):
    """``(key, kind)`` of all rotations of the marked word."""
    marked = word + END
    size = len(marked)
    prints = _Fingerprint(marked) if size > LONG_KEY else None
    twice = marked + marked if prints is None else ""
    for start in range(size):
        # The rotation that begins at start; its last character is the one before.
        yield (prints.of(start, size) if size > LONG_KEY else twice[start : start + size]), WHOLE
        if start:
            again = start > 1 and word[start - 2] == word[start - 1]
            yield (prints.of(start, size - 1) if size - 1 > LONG_KEY else (marked[start:] + marked[: start - 1])), AGAIN if again else FIRST


def rotations(words: DataFrame) -> DataFrame:
    """``(key, kind, n, id)``: the keys of every word of ``(word, n, id)``."""

    def run(batches):
        for batch in batches:
            keys, kinds, rows = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                for key, kind in rotation_keys(word):
                    keys.append(key)
                    kinds.append(kind)
                    rows.append(row)
                if len(keys) > 100_000:
                    yield _filed(batch, keys, kinds, rows)
                    keys, kinds, rows = [], [], []
            if keys:
                yield _filed(batch, keys, kinds, rows)

    return words.select("word", "n", "id").mapInArrow(run, "key string, kind int, n bigint, id bigint")


def _filed(batch: pa.RecordBatch, keys: list[str], kinds: list[int], rows: list[int]) -> pa.RecordBatch:
    take = pa.array(rows, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(kinds, pa.int32()), batch.column("n").take(take), batch.column("id").take(take)], ["key", "kind", "n", "id"])


def _best(members: Column) -> Column:
    return F.get(members, F.lit(0))


def neighbours(words: DataFrame) -> DataFrame:
    """``(id, n_near, best)`` of every word of ``(word, n, id)`` that has near words.

    ``best`` is the near word of the largest count, by (``-n``, ``id``); ids follow code-point order, which settles ties.
    """
    member = F.struct((-F.col("n")).alias("less"), "id", "kind")
    # At most 91 members a range, so the list is bounded.
    ranges = rotations(words).groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("all")).where(F.size("all") > 1)
    ranges = ranges.select(
        "all",
        _best(F.filter("all", lambda m: m["kind"] == WHOLE)).alias("whole"),
        F.filter("all", lambda m: m["kind"] == FIRST).alias("first"),
        F.filter("all", lambda m: m["kind"] != WHOLE).alias("skipped"),
    )
    scanned = ranges.select(F.explode("all").alias("m"), "whole", "first", "skipped")
    is_whole, inserted = F.col("m.kind") == WHOLE, (F.col("m.kind") == FIRST) & F.col("whole").isNotNull()
    other = F.when(_best(F.col("skipped")) == F.col("m"), F.get("skipped", F.lit(1))).otherwise(_best(F.col("skipped")))
    near = F.when(is_whole, F.size("first")).otherwise(F.size("skipped") - 1 + inserted.cast("int"))
    found = F.when(is_whole, _best(F.col("first"))).when(inserted, F.least("whole", other)).otherwise(other)
    met = scanned.select(F.col("m.id").alias("id"), near.cast("bigint").alias("near"), F.struct(found["less"].alias("less"), found["id"].alias("id")).alias("best"))
    return met.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(formed: DataFrame) -> DataFrame:
    """``(id, root)`` for every word of ``(id, form)`` with a form: the last word of its chain."""
    steps = durable(formed.where("form IS NOT NULL").select("id", F.col("form").alias("root")))
    while True:
        further = attach(steps, steps.select(F.col("id").alias("root"), F.col("root").alias("next")), "root")
        jumped = durable(further.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = jumped.select("id", "root")
        if not jumped.where("moved").limit(1).count():
            return steps


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, n, form, root, n_near, form_n``."""
    words = durable(with_row_index(word_counts(docs), ["word"], name="id"))
    found = neighbours(words).select("id", "n_near", F.col("best.id").alias("form"), (-F.col("best.less")).alias("form_n"))
    joined = words.join(found, "id", "left")
    strong = F.col("form_n") >= 2 * F.col("n")
    joined = durable(joined.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(strong, F.col(c)).alias(c) for c in ("form", "form_n")]))
    roots = _roots(joined)
    targets = joined.select(F.col("form").alias("id")).union(roots.select(F.col("root"))).where("id IS NOT NULL").distinct()
    names = durable(joined.join(targets, "id", "left_semi").select("id", "word"))
    out = joined.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    out = attach(out, names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
    out = attach(out, names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    return out.select("word", "n", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n_near", "form_n")
