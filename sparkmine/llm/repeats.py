"""Substring dedup by seed and extend over winnowed anchors.

An anchor is the rightmost smallest hash among the ``GRAM``-word grams of a window. Equal windows choose the same
anchor at the same place, so documents that share a window meet at an anchor (the seed). The windows of one anchor
are consecutive; together they are the anchor's reach to the left and right. Where another document has the same
whole reach, the repeat extends over it at once; where a reach only agrees in part (the ends of a repeat), its windows
are compared one by one. Overlapping repeated windows of a document are joined to maximal repeats.

Only the smallest ``doc_id`` that has a window keeps it. That document's anchor never counts as repeated whole, so the
window-by-window comparison always sees it, and the result is that of comparing all windows.

Scale: about one row per 20 words is shuffled, then only the anchors that two documents share. Every group is
aggregated to its smallest and largest ``doc_id`` before the shuffle; a passage of all documents is one row per task.
Texts are joined with their own row's ranges only.

Edge cases: NULL text has no words; a row without ``doc_id`` keeps all words and does not count as a source. Rows are
told apart by ``doc_id`` and text, so repeated rows give equal results and do not remove each other's words; other
columns are ignored. Texts shorter than a window are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.shared import attach
from sparkmine.llm.words import Words, mix, signed, split_words, text_slices
from sparkmine.session import durable

WINDOW = 50
GRAM = 12
_PLACE = np.uint64((1 << 28) - 1)  # a slice has fewer words than that; longer texts than 500 MB do not fit a row


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text")


def anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, reach, lo, hi)`` of every anchor; its windows begin at words ``lo..hi``."""
    none = np.zeros(0, np.int64)
    start, grams = words.windows(gram)
    wide = window - gram + 1
    n = len(words.hashes)
    if n < window:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    # Upper bits rank the grams, lower bits prefer the rightmost place; grams across texts are never read below.
    values = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    values[start] = (grams & ~_PLACE) | (_PLACE - start.astype(np.uint64))
    least, span = values, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])  # of 2 * span grams
        span *= 2
    heads = np.flatnonzero(words.doc[: n - window + 1] == words.doc[window - 1 :])
    place = (_PLACE - (np.minimum(least[heads], least[heads + wide - span]) & _PLACE)).astype(np.int64)
    new = np.ones(len(heads), bool)
    new[1:] = (place[1:] != place[:-1]) | (heads[1:] != heads[:-1] + 1)
    first = np.flatnonzero(new)
    lo, hi, at = heads[first], heads[np.append(first[1:], len(heads)) - 1], place[first]
    inner = (at - lo).astype(np.uint64) * np.uint64(65_537) + (hi - lo).astype(np.uint64)
    reach = mix(words.window_hash(lo, hi + window) ^ mix(inner))
    return grams[np.searchsorted(start, at)], reach, lo, hi


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("row_key").to_numpy()
            for at, to, data, borders in text_slices(batch.column("text")):
                words = split_words(data, borders)
                anchor, reach, lo, hi = anchors(words, window, gram)
                doc = words.doc[lo]
                rows = [signed(anchor), signed(reach), ids.take(pa.array(doc + at)), pa.array(keys[doc + at])]
                rows += [pa.array((x - words.first[doc]).astype(np.int32)) for x in (lo, hi)]
                yield pa.RecordBatch.from_arrays(rows, ["anchor", "reach", "doc_id", "row_key", "lo", "hi"])

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, "anchor bigint, reach bigint, doc_id bigint, row_key bigint, lo int, hi int")


def _range_arrays(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    """The ``(lo, hi)`` structs of one row as an n x 2 array."""
    found = batch.column(name)[i]
    if not found.is_valid:
        return np.zeros((0, 2), np.int64)
    return np.column_stack([found.values.field(j).to_numpy() for j in range(2)]).astype(np.int64)


def _ranges(rows: DataFrame) -> DataFrame:
    """One row per document row, with its ranges of first words joined to maximal ones."""
    ordered = Window.partitionBy("row_key").orderBy("lo", "hi")
    end = F.max("hi").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("opens", F.coalesce(F.col("lo") > end + 1, F.lit(True)).cast("int"))
    numbered = opened.withColumn("run", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row_key", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return whole.groupBy("row_key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def _window_rows(docs: DataFrame, ranges: DataFrame, window: int) -> DataFrame:
    """Hash of every window that begins in the ranges of its row."""

    def run(batches):
        for batch in batches:
            ids, keys = (np.array(batch.column(c).to_pylist()) for c in ("doc_id", "row_key"))
            for at, to, data, borders in text_slices(batch.column("text")):
                words = split_words(data, borders)
                begin, whose = [], []
                for i in range(to - at):
                    for lo, hi in _range_arrays(batch, "ranges", at + i):
                        begin.append(np.arange(lo, hi + 1) + words.first[i])
                        whose.append(np.full(hi + 1 - lo, i))
                if begin:
                    begin, whose = np.concatenate(begin), np.concatenate(whose)
                    rows = [signed(words.window_hash(begin, begin + window)), pa.array(ids[whose + at]), pa.array(keys[whose + at])]
                    rows.append(pa.array((begin - words.first[whose]).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(rows, ["window", "doc_id", "row_key", "lo"])

    joined = attach(docs, ranges, "row_key", "inner").select("doc_id", "row_key", "text", "ranges")
    return joined.mapInArrow(run, "window bigint, doc_id bigint, row_key bigint, lo int")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(row_key, ranges)``: windows of a row, by first word, that a smaller ``doc_id`` has too."""
    keyed = _keyed(docs)
    # Seeds: anchors of two documents.
    rows = _anchor_rows(keyed, window, gram)
    seeds = rows.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("anchor")
    seeds = durable(seeds)  # a stored side lets the adaptive plan split a hot anchor
    shared = durable(_anchor_rows(keyed, window, gram).join(seeds, "anchor"))
    # Extension over the whole reach of an anchor.
    first = shared.groupBy("anchor", "reach").agg(F.min("doc_id").alias("low"))
    extended = durable(shared.join(first, ["anchor", "reach"]).select("doc_id", "row_key", "lo", "hi", (F.col("low") < F.col("doc_id")).alias("whole")))
    # Ends of repeats: window by window.
    windows = durable(_window_rows(keyed, _ranges(extended.where("NOT whole")), window))
    again = windows.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    ends = windows.join(again.select("window", "low"), "window").where("low < doc_id").select("row_key", "lo", F.col("lo").alias("hi"))
    return _ranges(extended.where("whole").select("row_key", "lo", "hi").union(ends))


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: the words left when repeated windows are cut out, joined by one space."""

    def run(batches):
        for batch in batches:
            for at, to, data, borders in text_slices(batch.column("text")):
                words = split_words(data, borders)
                raw, removed, texts = data.tobytes(), [], []
                for i in range(to - at):
                    begin, end = words.first[i], words.first[i + 1]
                    ranges = _range_arrays(batch, "ranges", at + i)
                    if not len(ranges):
                        removed.append(0)
                        texts.append(b" ".join(raw[borders[i] : borders[i + 1]].split()))
                        continue
                    step = np.zeros(end - begin + 1, np.int64)
                    np.add.at(step, ranges[:, 0], 1)
                    np.add.at(step, ranges[:, 1] + window, -1)
                    keep = np.flatnonzero(np.cumsum(step)[:-1] == 0) + begin
                    removed.append(int(end - begin - len(keep)))
                    texts.append(b" ".join(raw[a:b] for a, b in zip(words.starts[keep], words.ends[keep])))
                columns = [batch.column("doc_id").slice(at, to - at), pa.array(words.counts()), pa.array(removed, pa.int64()), pa.array([t.decode() for t in texts])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_text"])

    joined = attach(_keyed(docs), repeated_ranges(docs, window, gram), "row_key").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


