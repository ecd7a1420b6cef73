"""N-gram Jaccard join by parity sketches.

A document's set of word shingles is folded into a bit sketch: every shingle flips one bit. A flip can cancel
another one, so the Hamming distance of two sketches never exceeds the symmetric difference of the sets. Documents
are put into size bands; in a band the threshold bounds the symmetric difference by ``d``, the sketch has at least ``d + r``
pieces, and so two linked documents agree in at least ``r`` whole pieces (pigeonhole; ``r`` is 1 for the smallest sets and
up to ``AGREED``). Pieces are joined, documents that meet others in fewer pieces have no partner, and every candidate pair is
verified on the exact shingle sets (64-bit hashes).

Scale: one row per piece is shuffled once, about 0.3 rows per word. Copies with equal sets are one node. Each piece
group is read as a sorted stream, never collected: members are paired with the group's first node. Members that these
links leave in different components meet again by their rarest shingles (see ``_rarest_items``), first with the least
edited member and then with all that are still apart, so no pair above the threshold is lost, and neither a group of
many near copies nor one of copies that are not similar enough makes all its pairs.

Edge cases: NULL or blank text has an empty set, which is linked with nothing. Fewer words than a shingle form one
shingle. Rows without ``doc_id`` are returned with a NULL component and take part in no link. Rows that repeat a
``doc_id`` are one document whose component is shared. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.shared import Stored, attach, components, more_components, stored, unused
from sparkmine.llm.words import mix, signed, split_words, text_slices
from sparkmine.session import durable

BAND = 1.3
AGREED = 6  # pieces in which linked sets agree at least, where a band allows so many differences that they cost little


@dataclass(frozen=True)
class Rule:
    """Shingle length and the similarity threshold ``num / den``."""

    k: int = 5
    num: int = 80
    den: int = 100

    def bands(self, largest: int) -> list[tuple[int, int, int]]:
        """Smallest size, piece count and largest difference of every band up to ``largest``."""
        low, out = 1, []
        while low <= largest:
            up = max(low + 1, math.ceil(low * BAND))
            d = (self.den - self.num) * ((up - 1) * self.den // self.num) // self.den
            out.append((low, d + self.agreed(d) + self._spare(low, d), d))
            low = up
        return out

    @staticmethod
    def agreed(d: int) -> int:
        """In how many pieces linked sets of a band with at most ``d`` differences agree at least."""
        return min(AGREED, 1 + d // 8)

    def partners_from(self, n: Column) -> Column:
        """In how many pieces a set of ``n`` shingles meets others at least if it is linked with any."""
        need, bands = F.lit(1), self.bands(100 * AGREED * self.den // max(1, self.den - self.num))
        for r in range(2, AGREED + 1):
            low = next((low for low, _, d in bands if self.agreed(d) >= r), None)
            if low is not None:  # larger sets join no band below this one
                need = F.when(n * self.num > self.den * (low - 1), F.lit(r)).otherwise(need)
        return need

    @classmethod
    def _spare(cls, low: int, d: int) -> int:
        """Further pieces, so that the pieces without any shingle rarely use up the pigeonhole."""
        least = d + cls.agreed(d)
        for spare in range(d // 2 + 1):
            empty = (least + spare) * math.exp(-low / (least + spare))
            if d == 0 or spare >= empty + 2 * math.sqrt(empty):
                return spare
        return d // 2 + 1


def _sets(rule: Rule, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For consecutive rows: the distinct shingle hashes of each."""
    for at, to, data, borders in text_slices(column):
        words = split_words(data, borders, lower=True)
        start, hashes = words.windows(rule.k)
        cut = np.searchsorted(start, words.first)
        counts = words.counts()
        found = []
        for i in range(to - at):
            if counts[i] >= rule.k:
                found.append(np.unique(hashes[cut[i] : cut[i + 1]]))
            elif counts[i]:
                found.append(words.window_hash(words.first[i : i + 1], words.first[i + 1 : i + 2]))
            else:
                found.append(hashes[:0])
        yield at, found


def _node(shingles: np.ndarray) -> int:
    total = np.add.reduce(mix(shingles ^ np.uint64(len(shingles))), keepdims=True)
    return int(mix(total).view(np.int64)[0])


def shingle_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, n_shingles, node)`` per row; equal sets have equal nodes, empty sets none."""

    def run(batches):
        for batch in batches:
            for at, sets in _sets(rule, batch.column("text")):
                nodes = [_node(s) if len(s) else None for s in sets]
                columns = [batch.column("doc_id").slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, node bigint")


def sketch_pieces(rule: Rule, bands: list[tuple[int, int, int]], shingles: np.ndarray) -> np.ndarray:
    """Join keys of all sketch pieces of one set, for its own size band and, as the larger partner, for lower ones."""
    n = len(shingles)
    own = bisect.bisect_right(bands, (n, math.inf, 0)) - 1
    keys, cell_of, bit = [], shingles >> np.uint64(20), mix(shingles & np.uint64(0xFFFFF))
    for band in range(own, -1, -1):
        # The smaller partner has at least num / den of this size.
        if band < own and rule.den * (bands[band + 1][0] - 1) < rule.num * n:
            break
        _, count, most = bands[band]
        cells = np.zeros(count, np.uint64)
        np.bitwise_xor.at(cells, cell_of % np.uint64(count), bit)
        slot = np.arange(count)
        if (cells == 0).sum() <= count - most - rule.agreed(most):  # else a pair may agree in too few others: keep them
            slot = slot[cells != 0]
        keys.append(mix(cells[slot] ^ mix(slot.astype(np.uint64) + np.uint64((band + 1) << 32))))
    return np.concatenate(keys)


def _pieces(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches):
        seen: set[int] = set()  # copies in one task are emitted once; beyond the bound again, which changes nothing
        bands = rule.bands(1000)
        for batch in batches:
            known = batch.column("doc_id").is_valid().to_pylist()
            for at, sets in _sets(rule, batch.column("text")):
                keys, nodes = [], []
                if (largest := max(map(len, sets))) >= bands[-1][0]:
                    bands = rule.bands(2 * largest)
                for i, s in enumerate(sets):
                    if not len(s) or not known[at + i] or (node := _node(s)) in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(node)
                    keys.append(sketch_pieces(rule, bands, s))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([signed(np.concatenate(keys)), pa.array(np.concatenate(nodes))], ["key", "node"])

    return docs.select("doc_id", "text").mapInArrow(run, "key bigint, node bigint")


def _pair_stream(batches):
    """Sorted ``(key, node)`` rows to ``(key, a, b, opens)``: every further node of a key with the key's first node.

    ``opens`` is 1 in the first row of a key, else 0.
    """
    last_key = last_node = leader = last_out = None
    for batch in batches:
        key, node = (batch.column(i).to_numpy() for i in range(2))
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        fresh[0] = last_key is None or key[0] != last_key
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
        lead = np.where(begin < 0, leader if leader is not None else 0, node[begin])
        again = np.zeros(len(key), bool)
        again[1:] = (node[1:] == node[:-1]) & ~fresh[1:]
        again[0] = not fresh[0] and node[0] == last_node
        keep = ~again & (node != lead)
        last_key, last_node, leader = key[-1], node[-1], lead[-1]
        if keep.any():
            out = key[keep]
            opens = np.ones(len(out), np.int32)
            opens[1:] = out[1:] != out[:-1]
            opens[0] = last_out is None or out[0] != last_out
            last_out = out[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (out, lead[keep], node[keep], opens)], ["key", "a", "b", "opens"])


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity sketch of a whole set in at least two bits a shingle; the number of 64-bit words is a power of two."""
    words = 1 << max(0, math.ceil(math.log2(len(shingles) / 32)))
    sketch, place = np.zeros(words, np.uint64), shingles & np.uint64(64 * words - 1)
    np.bitwise_xor.at(sketch, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    return sketch


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays)))


def _hamming(x: str, y: str) -> Column:
    """Distance of two sketches, at most the symmetric difference of the sets; halves of the longer one are folded together."""

    def folded(a: str, b: str) -> Column:
        half = F.size(b)
        halves = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(a) > half, halves).otherwise(F.col(a))

    flips = F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(flips, F.lit(0), lambda total, n: total + n)


def _candidate_sets(docs: DataFrame, wanted: Stored, rule: Rule) -> DataFrame:
    """``(node, items, bits)``: shingle hashes and bit sketch of every ``(node, head)``, read from the text of ``doc_id`` = ``head``.

    Only repeated rows of that ``doc_id`` can give a node twice, which the uses of the sets allow.
    """

    def run(batches):
        for batch in batches:
            asked = batch.column("node").to_numpy()
            for at, sets in _sets(rule, batch.column("text")):
                ids, kept, bits = [], [], []
                for i, s in enumerate(sets):
                    if len(s) and _node(s) == asked[at + i]:
                        ids.append(asked[at + i])
                        kept.append(s.view(np.int64))
                        bits.append(bit_sketch(s).view(np.int64))
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists(kept), _lists(bits)], ["node", "items", "bits"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("head"), "text").join(wanted.hinted(), "head")
    return durable(texts.select("node", "text").mapInArrow(run, "node bigint, items array<bigint>, bits array<bigint>"))


def _verified(sets: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose sets reach the threshold.

    Sizes and sketches bound the similarity from above: only pairs that they do not rule out meet their sets.
    """
    small = sets.select("node", F.size("items").alias("n"), "bits")
    sized = pairs.join(small.toDF("a", "n_a", "bits_a"), "a").join(small.toDF("b", "n_b", "bits_b"), "b")
    sized = sized.where(F.least("n_a", "n_b") * rule.den >= F.greatest("n_a", "n_b") * rule.num)
    most = F.col("n_a") + F.col("n_b") - 2 * _shared(F.col("n_a"), F.col("n_b"), rule)
    near = durable(sized.where(_hamming("bits_a", "bits_b") <= most).select("a", "b", "n_a", "n_b"))
    kept = sets.select("node", "items").join(near.select(F.explode(F.array("a", "b")).alias("node")), "node", "left_semi")
    both = F.size(F.array_intersect("of_a", "of_b"))
    compared = near.join(kept.toDF("a", "of_a"), "a").join(kept.toDF("b", "of_b"), "b")
    return compared.where(both * rule.den >= (F.col("n_a") + F.col("n_b") - both) * rule.num).select("a", "b")


def _rarest_items(sets: DataFrame, rule: Rule) -> DataFrame:
    """``item, node, n, p``: the first shingles of every set, in order of how many of the sets hold them, rarest first.

    Two linked sets of n and m shingles share at least o (see :func:`_shared`). Those before the first one that they
    share, p in one and q in the other, are not in the other set, so p <= n - o and q <= m - o. Edited copies begin
    with shingles of their own, which nobody shares.
    """
    held = sets.select("node", F.size("items").alias("n"), F.explode("items").alias("item"))
    common = held.groupBy("item").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    # The shingles that nobody shares come first; only the others are placed.
    rarest = Window.partitionBy("node").orderBy("holders", "item")
    every = Window.partitionBy("node")
    placed = held.join(common, "item").withColumn("p", F.col("n") - F.count(F.lit(1)).over(every) + F.row_number().over(rarest) - 1)
    # The other set has at least num / den of this size.
    least = F.ceil(F.col("n") * rule.num / rule.den)
    return durable(placed.where(F.col("p") <= F.col("n") - least).select("item", "node", "n", "p"))


def _shared(n: Column, m: Column, rule: Rule) -> Column:
    """How many shingles linked sets of these sizes share at least."""
    return F.ceil((n + m) * rule.num / (rule.num + rule.den))


def _with_roots(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose ends are not in one component yet."""
    of_a, of_b = labels.toDF("a", "root_a"), labels.toDF("b", "root_b")
    return pairs.join(of_a, "a", "left").join(of_b, "b", "left").where("coalesce(root_a, a) <> coalesce(root_b, b)").select("a", "b")


def _ordered_pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).where("a <> b").distinct()


def _early_enough(rule: Rule) -> Column:
    shared = _shared(F.col("n"), F.col("other_n"), rule)
    return (F.col("p") <= F.col("n") - shared) & (F.col("q") <= F.col("other_n") - shared)


def _central_pairs(placed: DataFrame, rule: Rule) -> DataFrame:
    """Every holder of a shingle with the holder that has the fewest shingles before it, the least edited one."""
    center = placed.groupBy("item").agg(F.min(F.struct("p", "node", "n")).alias("c"))
    center = center.select("item", F.col("c.p").alias("q"), F.col("c.node").alias("other"), F.col("c.n").alias("other_n"))
    return _ordered_pairs(placed.join(center, "item").where(_early_enough(rule)))


def _open_pairs(placed: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """All pairs that share one of their rarest shingles and may still be linked; the smaller set holds it early."""
    rooted = placed.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    early = rooted.where(F.col("p") <= F.col("n") - _shared(F.col("n"), F.col("n"), rule))
    names = {"node": "other", "root": "other_root", "n": "other_n", "p": "q"}
    met = early.join(rooted.withColumnsRenamed(names), "item").where("root <> other_root AND n <= other_n")
    return _ordered_pairs(met.where(_early_enough(rule)))


def links(docs: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """``(node, root)``: the nodes of linked sets with the smallest node of their component; ``rows`` as of :func:`shingle_sets`."""
    groups = _pieces(docs, rule).repartition("key").sortWithinPartitions("key", "node")
    groups = durable(groups.mapInArrow(_pair_stream, "key bigint, a bigint, b bigint, opens int"))
    # Nodes that meet others in as many pieces as a linked set does, with the row that their set is read from.
    met = groups.select(F.col("a").alias("node"), F.col("opens").alias("times")).union(groups.select("b", F.lit(1)))
    times = met.groupBy("node").agg(F.sum("times").alias("times"))
    heads = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
    heads = heads.agg(F.min("doc_id").alias("head"), F.min(rule.partners_from(F.col("n_shingles"))).alias("need"))
    often = stored(times.join(heads, "node").where("times >= need").select("node", "head", "need"))
    # A group keeps its members when its first node goes.
    names = often.hinted().select("node")
    kept = groups.select("key", "a", "b").join(names.toDF("b"), "b").join(names.select(F.col("node").alias("a"), F.lit(True).alias("led")), "a", "left")
    groups = durable(kept)
    sets = _candidate_sets(docs, Stored(often.rows.drop("need"), often.size), rule)
    pairs = durable(groups.where("led").select("a", "b").distinct())
    first = durable(_verified(sets, pairs, rule))
    labels = components(first)

    # Members of one piece group that the group's first node did not bring together.
    members = groups.select("key", F.col("b").alias("node")).join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = members.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    apart = members.join(split, "key", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("times"))
    apart = stored(apart.join(often.hinted(), "node").where("times >= need").select("node"))
    if not apart.size:
        return labels
    placed = _rarest_items(sets.join(apart.hinted(), "node"), rule)
    # First with the least edited holder of each shingle, then with all that this leaves apart.
    central = durable(_with_roots(_central_pairs(placed, rule), labels).join(pairs, ["a", "b"], "left_anti"))
    labels = more_components(labels, _verified(sets, central, rule))
    rest = durable(_open_pairs(placed, labels, rule).join(pairs.union(central), ["a", "b"], "left_anti"))
    if not rest.limit(1).count():
        return labels
    return more_components(labels, _verified(sets, rest, rule))


def jaccard_components(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id`` (smallest linked ``doc_id``)."""
    rows = durable(shingle_sets(docs, rule))
    joined = links(docs, rows, rule)
    nodes = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    nodes = nodes.join(joined, "node", "left").select("node", "low", "high", F.coalesce("root", "node").alias("root"))
    lowest = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    found = nodes.join(lowest, "root").where("low <> component_id OR high <> component_id").select("node", "component_id")
    result = attach(rows, found, "node").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return result.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def keep_one(docs: DataFrame, rule: Rule) -> DataFrame:
    """The documents without near copies: of every component the rows of its smallest ``doc_id`` stay."""
    rows = jaccard_components(docs, rule)
    gone = stored(rows.where("component_id <> doc_id").select("doc_id").distinct().toDF(free := unused(docs, "gone")))
    return docs.join(gone.hinted(), docs["doc_id"].cast("bigint") == F.col(free), "left_anti")
