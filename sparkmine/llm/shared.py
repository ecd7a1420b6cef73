"""Distributed helpers of the operators: checked lookups and connected components."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import durable

LOOKUP_BYTES = 32 << 20


@dataclass(frozen=True)
class Stored:
    """A lookup in the shared checkpoint folder with its measured size, reusable by many joins."""

    rows: DataFrame
    size: int

    def hinted(self, limit: int = LOOKUP_BYTES) -> DataFrame:
        return F.broadcast(self.rows) if self.size <= limit else self.rows.hint("merge")


def stored(lookup: DataFrame) -> Stored:
    rows = durable(lookup)
    return Stored(rows, rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0)


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as it takes to differ from every column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def attach(facts: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left", limit: int = LOOKUP_BYTES) -> DataFrame:
    """Join a lookup with unique keys to facts.

    The lookup is stored in the shared checkpoint folder and measured. Up to ``limit`` bytes it is broadcast;
    beyond that both sides are shuffled and the adaptive plan splits hot keys of the facts.
    """
    return facts.join(stored(lookup).hinted(limit), on, how)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges(a, b)``; root is the smallest reachable node.

    Each round gives a node the smallest label among its neighbours and itself, then the label of that label.
    Labels only travel through aggregated joins, and every round is cut by a checkpoint.
    """
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = durable(lower.join(jump, "root", "left").select("node", F.least("root", "next").alias("root"), "was"))
        changed = step.where("root <> was").limit(1).count()
        labels = step.select("node", "root")
        if not changed:
            return labels


def more_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` of :func:`components` after further edges: only edges between different components are followed."""
    first, second = labels.toDF("a", "root_a"), labels.toDF("b", "root_b")
    lifted = edges.select("a", "b").join(first, "a", "left").join(second, "b", "left")
    lifted = durable(lifted.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a <> b").distinct())
    if not lifted.limit(1).count():
        return labels
    merged = components(lifted)
    # A node without a label so far is its own root, and then it is a node of the lifted edges.
    both = labels.select("node", F.col("root").alias("old")).join(merged.toDF("old", "new"), "old", "full")
    return durable(both.select(F.coalesce("node", "old").alias("node"), F.coalesce("new", "old").alias("root")))
