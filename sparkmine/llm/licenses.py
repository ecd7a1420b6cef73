"""License scans by an exact set-similarity join, in DataFrame functions only.

A template is the set of words of a license sentence. A text block is a window of twice as many words as the sentence has that
begins with one of its words, anywhere in the words of the whole text: line breaks and comment signs do not count. A block meets
a template when it holds at least ``THRESHOLD`` of the template's words; its stretch ends with the last word that is new to it,
and a block whose first word occurs again in its stretch gives way to the shorter one from there. Words that templates
use are ranked by their frequency in all texts, rarest first. A template of n words that needs o of them in a block has
n - o + 1 prefix words (its rarest): every block that meets it holds one of these, so only texts that hold any are taken apart
(prefix filter) and only places within a block's reach of one are kept (positional filter). A block with fewer than o places of
template words is out before its set is formed (length filter); the others are verified on the sets, in one sliding frame
over the places in order, which each place enters and leaves once.

Besides, the base phrases are looked up word by word. Template matches add the labels of the
templates that a stretch meets best: a match that shares a word with a better one is dropped.

Scale: the frequency count is a partial aggregate over at most as many words as the templates have. Only places of template
words leave their text, once for all equal texts, and join the templates, which are fixed and small. Frames hold at most a
block's width of places, so a text of any length takes time in proportion to it; a text is never gathered again, only its labels.

Edge cases: NULL text is empty: no words, no labels, score 0. Rows that repeat a ``doc_id`` give a row each with their own
text's result; rows without ``doc_id`` likewise. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm.shared import attach

# The base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Sentences by which licenses are granted.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("all-rights-reserved", "copyright all rights reserved no part may be reproduced without permission"),
]
THRESHOLD = 0.8
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """Only A-Z change."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), GAP), "")


def _template_words() -> list[str]:
    return sorted({w for _, text in TEMPLATES for w in text.split()})


def word_ranks(docs: DataFrame) -> dict[str, int]:
    """Rank of every template word by its frequency in all texts, 0 for the rarest."""
    words = docs.select(F.explode(F.split(lowered(docs["text"]), GAP)).alias("word")).where(F.col("word").isin(_template_words()))
    counts = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}  # as many as templates have words
    return {w: i for i, w in enumerate(sorted(_template_words(), key=lambda w: (counts.get(w, 0), w)))}


def _pattern(words: list[str]) -> str:
    """A line that holds one of the (lower-case) words, before any other work is done."""
    return "(?i)(?<![0-9A-Za-z\\x{80}-\\x{10FFFF}])(?:" + "|".join(words) + ")(?![0-9A-Za-z\\x{80}-\\x{10FFFF}])"


def _places(words: Column, known: list[str]) -> Column:
    """``(at, word)`` of every known word of a text."""
    pairs = F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    return F.filter(pairs, lambda p: p["word"].isin(known))


def template_matches(rows: DataFrame, ranks: dict[str, int], threshold: float = THRESHOLD) -> DataFrame:
    """``__row, template, label, score, from, to`` of the blocks of ``(__row, text)`` that meet a template."""
    table, prefixes = [], set()
    for i, (label, text) in enumerate(TEMPLATES):
        ordered = sorted(set(text.split()), key=lambda w: ranks[w])
        need, width = math.ceil(threshold * len(ordered) - 1e-9), 2 * len(text.split())
        rare = ordered[: len(ordered) - need + 1]
        table += [(word, i, label, word in rare, len(ordered), need, width) for word in ordered]
        prefixes |= set(rare)
    templates = rows.sparkSession.createDataFrame(table, "word string, template int, label string, rare boolean, size int, need int, width int")

    texts = rows.where(F.col("text").rlike(_pattern(sorted(prefixes))))
    places = texts.select("__row", F.explode(_places(words_of(F.col("text")), _template_words())).alias("place")).select("__row", "place.*")
    # Equal texts give each place once.
    held = places.distinct().join(F.broadcast(templates), "word")
    # On a scale on which every template's block is `unit` long; a block ends before the place one unit on.
    unit = math.lcm(*(width for *_, width in table))
    reach = unit - 1
    held = held.withColumn("unit", F.col("at") * F.expr(f"CAST({unit} DIV width AS BIGINT)"))
    one = Window.partitionBy("__row", "template")
    rare = F.when(F.col("rare"), F.col("unit"))
    held = held.withColumns({
        "before": F.last(rare, ignorenulls=True).over(one.orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)),
        "after": F.last(rare, ignorenulls=True).over(one.orderBy(F.desc("unit")).rowsBetween(Window.unboundedPreceding, 0)),
        "prev": F.lag("at").over(Window.partitionBy("__row", "template", "word").orderBy("unit")),
    })
    held = held.where((F.col("unit") - F.col("before") <= reach) | (F.col("after") - F.col("unit") <= reach))
    block = F.collect_list(F.struct("at", "prev")).over(one.orderBy("unit").rangeBetween(0, reach))
    held = held.withColumn("block", block).where(F.size("block") >= F.col("need"))
    # A word is new to a block if its place before lies before the block.
    new = F.transform(F.filter("block", lambda h: h["prev"].isNull() | (h["prev"] < F.col("at"))), lambda h: h["at"])
    found = held.withColumn("new", new).where(F.size("new") >= F.col("need")).withColumn("to", F.element_at("new", -1))
    again = F.exists("block", lambda h: (h["prev"] == F.col("at")) & (h["at"] <= F.col("to")))
    score = (F.size("new") / F.col("size")).alias("score")
    return found.where(~F.coalesce(again, F.lit(False))).select("__row", "template", "label", score, F.col("at").alias("from"), "to")


def best_labels(matches: DataFrame) -> DataFrame:
    """``__row, added, best``: the templates met by windows that share no word with a window that meets one better."""
    match = ["template", "label", "score", "from", "to"]
    places = matches.select("__row", F.explode(F.sequence("from", "to")).alias("place"), F.struct(*match).alias("match"))
    # At a place are at most as many windows as templates times their widths.
    places = places.groupBy("__row", "place").agg(F.max("match.score").alias("top"), F.collect_set("match").alias("all"))
    windows = places.select("__row", "top", F.explode("all").alias("match")).groupBy("__row", "match").agg(F.max("top").alias("top"))
    kept = windows.where(F.col("match.score") == F.col("top"))
    return kept.groupBy("__row").agg(F.collect_set("match.label").alias("added"), F.max("top").alias("best"))


def _starts_here(words: Column, asked: list[str]) -> Callable[[Column, Column], Column]:
    def place(word: Column, i: Column) -> Column:
        test = word == asked[0]
        for j, other in enumerate(asked[1:], 1):
            test = test & F.coalesce(F.get(words, i + j) == other, F.lit(False))
        return F.when(test, i)

    return place


def _labelled(label: str) -> Callable[[Column], Column]:
    return lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))


def phrase_places(text: Column) -> Column:
    """Array of ``(start, label)`` of every place of a base phrase, words counted from 0."""

    def found(words: Column) -> Column:
        parts = []
        for phrase, label in PHRASES.items():
            at = F.transform(words, _starts_here(words, phrase.split()))
            parts.append(F.transform(F.filter(at, lambda i: i.isNotNull()), _labelled(label)))
        return F.concat(*parts)

    return F.transform(F.array(words_of(text)), found)[0]


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 with a base phrase, else the largest share of a template's words that a window holds, if that
    meets the threshold, else 0.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text.alias("text"))
    ranks = word_ranks(docs)
    added = best_labels(template_matches(rows.withColumn("__row", F.xxhash64("text")), ranks, threshold))
    n_words = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("bigint")
    between = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    likely = "|".join(between.join(f"(?i:{w})" for w in p.split()) for p in PHRASES)
    places = F.when(F.col("text").rlike(likely), phrase_places(F.col("text"))).otherwise(F.array().cast("array<struct<start:int,label:string>>"))
    base = rows.select("doc_id", F.xxhash64("text").alias("__row"), n_words.alias("n_words"), places.alias("places"))
    joined = attach(base, added, "__row")
    starts = F.transform("places", lambda p: p["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base_labels, F.coalesce("added", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
