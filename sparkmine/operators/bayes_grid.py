"""Cross-validated naive Bayes over vocabulary sizes and model types, all points and folds from one table of counts.

Every sum that a fit needs (documents, words and squares of word counts per class) is the total of the other folds' sums, so the
texts are read once to count and once to score. Models are those of MLlib: the vocabulary are the commonest words of the
training rows (ties by word), multinomial with smoothed priors or gaussian with a variance floor of 1e-9 of the largest one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.operators import metrics as M
from sparkmine.session import durable

KINDS = ("multinomial", "gaussian")
FLOOR = 1e-9


def left_out_sums(bags: DataFrame, folds: int, size: int, min_df: int) -> DataFrame:
    """``(fold, rank, term, label, n, squares)``: sums over the other folds, for the ``size`` commonest terms in them."""
    sums = F.sum("tf").alias("n"), F.sum(F.col("tf") * F.col("tf")).alias("squares")
    counts = durable(bags.where("term IS NOT NULL").groupBy("term", "fold", "label").agg(*sums, F.count(F.lit(1)).alias("df")))
    vocabulary = None
    for v in range(folds):
        known = counts.where(F.col("fold") != v).groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).where(F.col("df") >= min_df)
        top = known.orderBy(F.desc("n"), "term").limit(size)
        # At most `size` rows.
        listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "term"))).alias("all"))
        part = listed.select(F.lit(v).alias("left_out"), F.posexplode("all").alias("rank", "t")).select("left_out", "rank", F.col("t.term").alias("term"))
        vocabulary = part if vocabulary is None else vocabulary.unionByName(part)
    own = counts.join(F.broadcast(durable(vocabulary)), "term").where(F.col("fold") != F.col("left_out"))
    summed = own.groupBy("left_out", "rank", "term", "label").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"))
    return summed.withColumnRenamed("left_out", "fold")


def _fold_model(sums: pd.DataFrame, docs: dict[str, int], sizes: Sequence[int], smoothing: float, width: int):
    """Class names, ``base`` (kind, size, class) and the terms' ``weights`` (term, part, size, class) of one left-out fold.

    The parts are: times the count under the multinomial model; times the count, and times its square, under the gaussian one.
    """
    labels = sorted(docs, key=lambda c: (-docs[c], c))
    of = {c: i for i, c in enumerate(labels)}
    n_docs, terms = np.array([docs[c] for c in labels], float), int(sums["rank"].max()) + 1 if len(sums) else 0
    n, squares = np.zeros((len(labels), terms)), np.zeros((len(labels), terms))
    at = sums["label"].map(of).to_numpy(int), sums["rank"].to_numpy(int)
    n[at], squares[at] = sums["n"].to_numpy(float), sums["squares"].to_numpy(float)
    base, weights = np.full((len(KINDS), len(sizes), width), -np.inf), np.zeros((terms, 3, len(sizes), width))
    every, k = n_docs.sum(), len(labels)
    for s, size in enumerate(sizes):
        m, q = n[:, :size], squares[:, :size]
        weights[:size, 0, s, :k] = (np.log(m + smoothing) - np.log(m.sum(1) + smoothing * m.shape[1])[:, None]).T
        base[0, s, :k] = np.log(n_docs + smoothing) - np.log(every + smoothing * k)
        mean = m / n_docs[:, None]
        floor = FLOOR * (q.sum(0) / every - (m.sum(0) / every) ** 2).max(initial=0)
        variance = floor + q / n_docs[:, None] - mean * mean
        with np.errstate(divide="ignore", invalid="ignore"):
            weights[:size, 1, s, :k], weights[:size, 2, s, :k] = (mean / variance).T, (-0.5 / variance).T
            base[1, s, :k] = np.log(n_docs / every) - 0.5 * (mean * mean / variance + np.log(variance)).sum(1)
    return labels, base, weights


def cross_validated(bags: DataFrame, docs: DataFrame, folds: int, sizes: Sequence[int], smoothing: float = 1.0, min_df: int = 2) -> DataFrame:
    """``(size, kind, avg_f1)``: mean weighted F1 over the folds of every size with both kinds of model.

    ``bags`` are outer bags ``(doc_id, label, fold, term, tf)`` of the documents ``docs`` ``(doc_id, label, fold)``. The models, at most
    ``folds * max(sizes)`` terms, are made on the driver; documents are scored where they are.
    """
    spark, points = bags.sparkSession, [(k, s) for k in range(len(KINDS)) for s in range(len(sizes))]
    per_class = docs.groupBy("fold", "label").count().collect()  # folds x classes
    sums = left_out_sums(bags, folds, max(sizes), min_df).toArrow().to_pandas()
    width, lookup, bases = len({r["label"] for r in per_class}), [], []
    for v in range(folds):
        rest: dict[str, int] = {}
        for r in per_class:
            if r["fold"] != v:
                rest[r["label"]] = rest.get(r["label"], 0) + r["count"]
        own = sums[sums["fold"] == v]
        labels, base, weights = _fold_model(own, rest, sizes, smoothing, width)
        names = own.drop_duplicates("rank").sort_values("rank")["term"]
        begins = pa.array(np.arange(len(weights) + 1, dtype=np.int32) * (3 * len(sizes) * width))
        columns = pa.array(np.full(len(weights), v, np.int32)), pa.array(names, pa.string()), pa.ListArray.from_arrays(begins, weights.ravel())
        lookup.append(pa.table(list(columns), ["fold", "term", "w"]))
        bases.append((v, labels, [float(x) for x in base.ravel()]))
    model = spark.createDataFrame(pa.concat_tables(lookup))  # an Arrow table, whatever the session says about pandas
    joined = bags.join(F.broadcast(durable(model)), ["fold", "term"], "left")

    def weight(part: int, s: int, c: int):
        return F.get("w", F.lit((part * len(sizes) + s) * width + c))

    def gain(k: int, s: int, c: int):
        if KINDS[k] == "multinomial":
            return F.col("tf") * weight(0, s, c)
        return F.col("tf") * (weight(1, s, c) + F.col("tf") * weight(2, s, c))

    parts = [F.coalesce(F.sum(gain(k, s, c)), F.lit(0.0)).alias(f"g_{k}_{s}_{c}") for k, s in points for c in range(width)]
    summed = joined.groupBy("doc_id", "label", "fold").agg(*parts)
    summed = summed.join(F.broadcast(spark.createDataFrame(bases, "fold int, labels array<string>, base array<double>")), "fold")
    told = []
    for k, s in points:
        scores = F.array(*[F.get("base", F.lit((k * len(sizes) + s) * width + c)) + F.col(f"g_{k}_{s}_{c}") for c in range(width)])
        first = F.get("labels", (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
        told.append(F.struct(F.lit(sizes[s]).alias("size"), F.lit(KINDS[k]).alias("kind"), first.alias("predicted")))
    rows = summed.select("label", "fold", F.inline(F.array(*told)))
    found = M.weighted_metrics(rows, "label", "predicted", by=["size", "kind", "fold"])
    return found.groupBy("size", "kind").agg(F.avg("f1").alias("avg_f1"))
