"""Benchmark decontamination: rare n-gram seeds join texts to items, then Smith-Waterman alignment.

The ``GRAM``-word grams of the test items are counted over all texts. Seeds of an item are its grams that occur and are
rare (at most ``RARE`` of all words, or ``FEW`` places), and in any case the rarest one that occurs in every ``RUN`` places,
so that an item of common words, or one with very many copies, has seeds all over. Seeds are joined with the places of the texts.
Around the diagonal of every seed a stretch of text, wide enough for every alignment that scores ``LEAST``, is aligned
with the item word by word if it holds enough of the item's words to score that. The local alignment score, as a share
of the item's own score, tells copies with inserted, dropped or changed words. An alignment that scores 0.6 of an item
of more than five words always has two adjacent words in common with it, so a copy is lost only if all such pairs of
words are common ones.

Scale: texts are read twice where they are. The first reading keeps places whose gram may be one of an item, told by a
bit table of at most 2 ** ``TABLE_BITS`` bits that Spark aggregates from the benchmark; the exact test is the join. A
benchmark of any size takes the same two readings. Hot grams and hot texts are salted above the broadcast limit.
Texts without a seed are not looked at again, and only stretches, never whole texts, meet the items.

Edge cases: NULL or blank texts and items match nothing. Items of one word match as a whole.
Repeated items and repeated texts give equal rows; rows without ``doc_id`` or ``item_id`` are compared like others and
carry the NULL. Case of A-Z is ignored. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.shared import LOOKUP_BYTES, stored, unused
from sparkmine.llm.words import Words, signed, split_words, text_slices
from sparkmine.operators.joins import join_lookup
from sparkmine.session import durable

GRAM = 2
LEAST = 0.6  # alignment score, as a share of the item's own
RARE, FEW = 3e-6, 100  # a rare gram has at most this share of all words, or so many places
RUN = 4  # the rarest gram of each run of so many places of an item is a seed too
TABLE_BITS = 27
PORTION, ALIGNED = 1 << 20, 1 << 16  # words sent on, and words aligned, at a time
HIT, MISS, GAP = 2, -1, -1
SCHEMA = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"


def align(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of one item with each row of ``passages`` (0 = no word): score, first and last word."""
    n, width = passages.shape
    score = np.zeros((n, width + 1), np.int32)
    origin = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
    best, first, last = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    rows = np.arange(n)
    for word in item:
        step = np.where(passages == word, HIT, MISS)
        down, diagonal = score + GAP, np.zeros_like(score)
        diagonal[:, 1:] = score[:, :-1] + step
        new = np.maximum(np.maximum(down, diagonal), 0)
        came = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
        shifted = np.zeros_like(origin)
        shifted[:, 1:] = origin[:, :-1]
        came = np.where((new > 0) & (new == diagonal), shifted, came)
        came = np.where((new > 0) & (new == down) & (new != diagonal), origin, came)
        # Gaps along the passage: a running maximum of the score with the gap cost taken out.
        lifted = new + slope
        peak = np.maximum.accumulate(lifted, axis=1)
        place = np.maximum.accumulate(np.where(lifted == peak, np.arange(width + 1), 0), axis=1)
        score = peak - slope
        origin = np.take_along_axis(came, place, axis=1)
        at = score.argmax(axis=1)
        top = score[rows, at]
        better = top > best
        best[better], first[better], last[better] = top[better], origin[rows, at][better], at[better] - 1
    return best, first, last


def _grams(words: Words, gram: int, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of all grams of the texts; with ``single`` also of the single words that a tiny item may be."""
    start, hashes = words.windows(gram)
    if not single:
        return start, hashes
    more, ones = words.windows(1)
    return np.concatenate([start, more]), np.concatenate([hashes, ones])


def item_words(items: DataFrame) -> DataFrame:
    """``item, n, words, grams`` of ``items(item, text)``: word count, word hashes as bytes, gram hashes by place."""

    def run(batches):
        for batch in batches:
            keys = batch.column("item").to_numpy()
            for at, to, data, borders in text_slices(batch.column("text")):
                words = split_words(data, borders, lower=True)
                sizes = words.counts()
                rows = []
                for i, n in enumerate(sizes.tolist()):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    places = words.first[i] + np.arange(max(n - GRAM + 1, min(n, 1)))
                    grams = words.window_hash(places, np.minimum(places + GRAM, words.first[i + 1]))
                    rows.append((own.tobytes(), grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at:to], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([r[0] for r in rows], pa.binary()),
                        pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    ],
                    ["item", "n", "words", "grams"],
                )

    return items.mapInArrow(run, "item bigint, n bigint, words binary, grams array<bigint>").where("n > 0")


class BitTable:
    """Tells which 64-bit values may be in a set: one bit for each value of their leading bits."""

    def __init__(self, values: DataFrame, column: str, n: int):
        self.bits = min(TABLE_BITS, max(15, n.bit_length() + 10))
        slot = F.shiftrightunsigned(column, 64 - self.bits) + 1
        parts = values.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("held"))
        self.held = np.zeros(1 << (self.bits - 3), np.uint8)
        for row in parts.collect():  # at most 2 ** TABLE_BITS bits together
            own = np.frombuffer(bytes(row["held"]), np.uint8)
            self.held[(row["part"] - 1) * len(own) :][: len(own)] = own

    def find(self, values: np.ndarray) -> np.ndarray:
        """Places in ``values`` that may be in the set."""
        slot = values >> np.uint64(64 - self.bits)
        return np.flatnonzero((self.held[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)


def _hits(texts: DataFrame, table: BitTable, single: bool) -> DataFrame:
    """``key, word, gram`` of places that may hold an item's gram; rows without a gram give a number of words read."""

    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for at, _, data, borders in text_slices(batch.column("text")):
                words = split_words(data, borders, lower=True)
                start, hashes = _grams(words, GRAM, single)
                held = table.find(hashes)
                word = start[held]
                doc = words.doc[word]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at + doc], pa.int64()), pa.array(word - words.first[doc], pa.int64()), signed(hashes[held])],
                    ["key", "word", "gram"],
                )
                total = [pa.array([v], pa.int64()) for v in (None, len(words.hashes), None)]
                yield pa.RecordBatch.from_arrays(total, ["key", "word", "gram"])

    return texts.mapInArrow(run, "key bigint, word bigint, gram bigint")


def rare_seeds(items: DataFrame, hits: DataFrame) -> DataFrame:
    """``gram, item, place, n``: where the items hold their seeds."""
    words = hits.where("gram IS NULL").agg(F.sum("word")).first()[0] or 0
    places = items.select("item", "n", F.posexplode("grams").alias("place", "gram"))
    counts = hits.where("gram IS NOT NULL").groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    met = durable(places.groupBy("gram").agg(F.count(F.lit(1)).alias("places")).join(counts, "gram").select("gram", (F.col("places") * F.col("held")).alias("pairs")))
    nth = F.row_number().over(Window.partitionBy("item", F.expr(f"place DIV {RUN}")).orderBy("pairs", "gram", "place"))
    few = max(FEW, math.ceil(RARE * words))
    chosen = places.join(met, "gram").withColumn("nth", nth)
    return chosen.where((F.col("pairs") <= few) | (F.col("nth") == 1)).select("gram", "item", "place", "n")


def _stretches(texts: DataFrame, least: float) -> DataFrame:
    """For each text and item the stretches around the diagonals: their first words, sizes and word hashes."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            near = batch.column("near")
            sizes = np.diff(near.offsets.to_numpy())
            flat = near.flatten()
            item, n, begin = (c.to_numpy(zero_copy_only=False) for c in flat.flatten())
            border = np.concatenate(([0], np.cumsum(sizes)))
            for at, to, data, borders in text_slices(batch.column("text")):
                words = split_words(data, borders, lower=True)
                part = slice(border[at], border[to])
                doc = np.repeat(np.arange(to - at), sizes[at:to])
                for found in _merged(words, doc, item[part], n[part], begin[part], least):
                    d, i, first, size, hashes = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([at + x for x in d], pa.int64())),
                            pa.array(i, pa.int64()),
                            pa.array(first, pa.list_(pa.int64())),
                            pa.array(size, pa.list_(pa.int64())),
                            pa.array(hashes, pa.binary()),
                        ],
                        ["doc_id", "item", "first", "size", "hashes"],
                    )

    return texts.mapInArrow(run, "doc_id bigint, item bigint, first array<bigint>, size array<bigint>, hashes binary")


def _merged(words: Words, doc: np.ndarray, item: np.ndarray, n: np.ndarray, begin: np.ndarray, least: float):
    """Unions of overlapping stretches, listed for each text and item, in portions of about ``PORTION`` words."""
    order = np.lexsort((begin, item, doc))
    doc, item, n, begin = doc[order], item[order], n[order], begin[order] + words.first[doc[order]]
    # An alignment that scores enough has at most so many edits, thus no word further from the diagonal.
    slack = np.floor(HIT * n * (1 - least) / -GAP + 1e-9).astype(np.int64)
    first = np.maximum(begin - slack, words.first[doc])
    last = np.minimum(begin + n + slack, words.first[doc + 1])
    pair = (np.diff(item, prepend=0) != 0) | (np.diff(doc, prepend=-1) != 0)
    pair[:1] = True
    fresh = pair.copy()
    fresh[1:] |= first[1:] > last[:-1]
    head = np.flatnonzero(fresh)
    if not len(head):
        return
    last = last[np.append(head[1:], len(last)) - 1]
    doc, item, first, pair = doc[head], item[head], first[head], pair[head]
    size = last - first
    found, room = [], 0
    groups = np.flatnonzero(pair).tolist()
    for a, b in zip(groups, [*groups[1:], len(doc)]):
        own = np.concatenate([words.hashes[x:y] for x, y in zip(first[a:b], last[a:b])])
        found.append((int(doc[a]), int(item[a]), first[a:b] - words.first[doc[a]], size[a:b], own.tobytes()))
        room += len(own)
        if room >= PORTION:
            yield found
            found, room = [], 0
    if found:
        yield found


def best_stretch(own: np.ndarray, stretches: list[tuple[int, int, np.ndarray]], least: float) -> dict[int, tuple[float, int, int]]:
    """For each row of ``(row, first word, hashes)`` the best alignment with the item: score, first and last word."""
    if not stretches:
        return {}
    need = math.ceil(len(own) * least - 1e-9)
    sizes = np.array([len(h) for _, _, h in stretches])
    # No alignment scores above its share of equal words.
    held = np.isin(np.concatenate([h for _, _, h in stretches]), own)
    enough = np.bincount(np.repeat(np.arange(len(stretches)), sizes)[held], minlength=len(stretches)) >= need
    left = sorted((s for s, ok in zip(stretches, enough) if ok), key=lambda s: len(s[2]))
    best: dict[int, tuple[float, int, int]] = {}
    a = 0
    while a < len(left):
        b = a + 1
        while b < len(left) and (b - a + 1) * len(left[b][2]) <= ALIGNED:
            b += 1
        part, a = left[a:b], b
        table = np.zeros((len(part), max(len(h) for _, _, h in part)), np.uint64)
        for r, (_, _, h) in enumerate(part):
            table[r, : len(h)] = h
        score, lo, hi = align(own, table)
        for (row, x, _), s, p, q in zip(part, (score / (HIT * len(own))).tolist(), lo.tolist(), hi.tolist()):
            if s >= least and (row not in best or (-s, x + p) < (-best[row][0], best[row][1])):
                best[row] = (s, x + p, x + q)
    return best


def _scored(pairs: DataFrame, least: float) -> DataFrame:
    """The alignments that score ``least``, of rows of stretches with the words of their item."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, items, firsts, sizes, hashes, own = (batch.column(i) for i in range(6))
            rows: dict[int, list[int]] = {}
            for row, i in enumerate(items.to_pylist()):
                rows.setdefault(i, []).append(row)
            found = []
            for item, mine in rows.items():
                stretches = []
                for row in mine:
                    every = np.frombuffer(hashes[row].as_buffer(), np.uint64)
                    size = np.array(sizes[row].as_py())
                    ends = np.cumsum(size)
                    stretches += [(row, x, every[e - k : e]) for x, k, e in zip(firsts[row].as_py(), size, ends)]
                words = np.frombuffer(own[mine[0]].as_buffer(), np.uint64)
                found += [(ids[row].as_py(), item, *best) for row, best in best_stretch(words, stretches, least).items()]
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item", "score", "first_word", "last_word"])

    return pairs.select("doc_id", "item", "first", "size", "hashes", "words").mapInArrow(run, SCHEMA.replace("item_id", "item"))


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, broadcast_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` for every text that holds a copy of a test item.

    The best stretch of each text and item is given; words are counted from 0 in the whole text.
    """
    named = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text", F.xxhash64("text").alias("item")).where(F.length(F.trim("text")) > 0)
    items = durable(item_words(named.groupBy("item").agg(F.first("text").alias("text"))))
    n, single = items.agg(F.sum(F.size("grams")), F.min("n")).first()
    if not n:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    table = BitTable(items.select(F.explode("grams").alias("gram")), "gram", n)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("key")).where("text IS NOT NULL")
    hits = durable(_hits(texts.select("key", "text"), table, single < GRAM))
    seeds = rare_seeds(items, hits)
    met = join_lookup(hits.where("gram IS NOT NULL"), seeds, ["gram"], broadcast_bytes=broadcast_bytes)
    met = met.select("key", "item", "n", (F.col("word") - F.col("place")).alias("begin")).distinct()
    near = met.groupBy("key").agg(F.collect_list(F.struct("item", "n", "begin")).alias("near"))
    looked = join_lookup(texts, near, ["key"], broadcast_bytes=broadcast_bytes)
    pairs = _stretches(looked.select("doc_id", "text", "near"), least)
    found = _scored(join_lookup(pairs, items.select("item", "words"), ["item"], broadcast_bytes=broadcast_bytes), least)
    return join_lookup(found, named.select("item", "item_id"), ["item"], broadcast_bytes=broadcast_bytes).select(*[c.split()[0] for c in SCHEMA.split(", ")])


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no copy of a test item."""
    found = contaminated(docs, benchmark).where("doc_id IS NOT NULL").select("doc_id").distinct()
    gone = stored(found.toDF(free := unused(docs, "found")))
    return docs.join(gone.hinted(), docs["doc_id"].cast("bigint") == F.col(free), "left_anti")
