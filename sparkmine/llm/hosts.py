"""Quality rules at host level, in DataFrame functions only.

Every text is measured (words, symbols, repeated lines and phrases). Rule failures are aggregated by host (the document's
``source``); a host's failure rate is shrunk towards the rate of all hosts with a beta prior whose strength is fitted to
the spread of the host rates (method of moments). A host whose shrunk rate reaches ``HOST_LIMIT`` is judged bad, and the
verdict is joined back: documents that fail a base rule go, documents of a bad host go if they fail any rule. A document
that fails no rule always stays.

Scale: measures are computed inside the row; the hosts are a partial aggregate (one row per host and task), so a host with
a third of all rows is as cheap as any. The verdicts are broadcast only if they are small, else joined by host.

Edge cases: NULL text counts as empty and fails the base rule (too few words); the NULL host is a host of its own; rows
may repeat; no rows give no rows. Input columns with the names of measures are kept apart by a struct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.shared import attach

LEAST_WORDS = 10
REPEAT_PERCENT = 20
SYMBOL_PERCENT = 50
LINE_PERCENT = 30
HOST_LIMIT = 0.5
WINDOW = 5
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column, width: int) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""

    def in_order(pairs: Column) -> Column:
        def twice(p: Column, j: Column) -> Column:
            return (F.get(pairs, j - 1)["h"] == p["h"]) | (F.get(pairs, j + 1)["h"] == p["h"])

        starts = F.sort_array(F.transform(F.filter(pairs, lambda p, j: F.coalesce(twice(p, j), F.lit(False))), lambda p: p["i"]))
        return let(starts, lambda s: F.aggregate(F.transform(s, lambda at, j: F.least(F.lit(width), F.coalesce(F.get(s, j + 1) - at, F.lit(width)))), F.lit(0), lambda a, b: a + b))

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(pairs, in_order))


def measures(text: Column) -> Column:
    """Struct of ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of one text."""
    whole = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        def window(w: Column, i: Column) -> Column:
            return F.xxhash64(w, *[F.get(words, i + j) for j in range(1, WINDOW)])

        many = F.size(words)
        windows = F.slice(F.transform(words, window), 1, F.greatest(many - (WINDOW - 1), F.lit(0)))
        return F.struct(many.cast("bigint").alias("n_words"), let(windows, lambda h: _covered(h, WINDOW)).cast("bigint").alias("n_repeat_words"))

    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = F.struct(
        let(F.array_remove(F.split(whole, SPACE), ""), of_words).alias("w"),
        let(lines, lambda a: F.struct(F.size(a).alias("all"), (F.size(a) - F.size(F.array_distinct(a))).alias("again"))).alias("l"),
        F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("chars"),
        (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("bigint").alias("symbols"),
    )
    return let(
        found,
        lambda m: F.struct(
            m["w"]["n_words"].alias("n_words"),
            m["chars"].alias("word_chars"),
            m["symbols"].alias("n_symbols"),
            m["l"]["all"].cast("bigint").alias("n_lines"),
            m["l"]["again"].cast("bigint").alias("n_dup_lines"),
            m["w"]["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])


def any_failed(m: Column) -> Column:
    """A base rule, or too many symbols or repeated lines."""
    return base_failed(m) | (100 * m["n_symbols"] > SYMBOL_PERCENT * m["n_words"]) | (100 * m["n_dup_lines"] > LINE_PERCENT * m["n_lines"])


def host_verdicts(rows: DataFrame) -> DataFrame:
    """``host, bad`` from rows of ``(host, failed)``."""
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("failed").cast("double")).alias("fails"))
    rate = F.col("fails") / F.col("n")
    totals = hosts.agg(F.sum("n").alias("n"), F.sum("fails").alias("fails"), F.sum(F.col("n") * rate * rate).alias("square"), F.count(F.lit(1)).alias("hosts"))
    mean = F.col("fails") / F.col("n")
    noise = mean * (1 - mean)
    # Spread of the host rates beyond what drawing n documents gives; none means one rate for all hosts.
    spread = F.greatest(F.col("square") / F.col("n") - mean * mean - noise * F.col("hosts") / F.col("n"), F.lit(1e-9))
    strength = F.least(F.greatest(noise / spread - 1, F.lit(1.0)), F.lit(1e6))
    prior = totals.select(F.struct(mean.alias("mean"), strength.alias("strength")).alias("prior")).scalar()
    with_prior = hosts.withColumn("prior", prior)
    shrunk = (F.col("fails") + F.col("prior.mean") * F.col("prior.strength")) / (F.col("n") + F.col("prior.strength"))
    return with_prior.select("host", shrunk.alias("rate"), (shrunk >= HOST_LIMIT).alias("bad"))


def judged(docs: DataFrame) -> DataFrame:
    """The input with a struct ``__m`` of measures, ``__failed`` (base rule) and ``__kept``."""
    measured = docs.withColumn("__m", measures(docs["text"])).withColumn("__host", F.coalesce(F.concat(F.lit("s"), docs["source"].cast("string")), F.lit("")))
    verdicts = host_verdicts(measured.select(F.col("__host").alias("host"), any_failed(F.col("__m")).alias("failed")))
    bad = verdicts.where("bad").select(F.col("host").alias("__host"), F.lit(True).alias("__bad"))
    joined = attach(measured, bad, "__host")
    dropped = base_failed(F.col("__m")) | (F.col("__bad").isNotNull() & any_failed(F.col("__m")))
    return joined.withColumn("__failed", base_failed(F.col("__m"))).withColumn("__kept", ~dropped)


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns only."""
    # One number, read once, so that the filter does not measure a text again: 2 base rule, 1 another rule, 0 none.
    level = let(measures(docs["text"]), lambda m: F.when(base_failed(m), 2).when(any_failed(m), 1).otherwise(0))
    # The input travels in a struct, so its columns may bear any name.
    host = F.coalesce(F.concat(F.lit("s"), docs["source"].cast("string")), F.lit(""))
    measured = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), level.alias("level"), host.alias("host"))
    verdicts = host_verdicts(measured.select("host", (F.col("level") > 0).alias("failed")))
    joined = attach(measured, verdicts.where("bad").select("host", F.lit(1).alias("bad")), "host")
    return joined.where(F.col("level") + F.coalesce("bad", F.lit(0)) < 2).select("doc.*")
