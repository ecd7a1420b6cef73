"""Multinomial naive Bayes as grouped sums and one lookup join.

One job fits any number of models: ``keys`` name the columns that identify a model
(an entity, a left-out fold), and nothing loops over them on the driver. Per-class
numbers are arrays in the order of ``labels``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.joins import BROADCAST_BYTES, Lookup, heavy_and_light, join_lookup, measured_lookup, salted_join, stored_lookup
from sparkmine.session import durable

GLOBAL = "*"


@dataclass(frozen=True)
class BayesModel:
    """``models``: one row per model, (keys..., n_docs, n_terms, log_prior, unseen), NULL prior
    for a class the model lacks. ``terms``: the term lookup, joined on ``term_keys``;
    ``gain(i)`` is what a joined term adds to class i over an unseen term, ``known`` tells
    whether the model's vocabulary has the term."""

    keys: tuple[str, ...]
    labels: list[str]
    models: Lookup
    terms: Lookup
    term_keys: tuple[str, ...]
    gain: Callable[[int], Column]
    known: Column


def class_counts(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., class, n_docs)``."""
    return docs.groupBy(*keys, "class").agg(F.count(F.lit(1)).alias("n_docs"))


def class_labels(per_class: DataFrame) -> list[str]:
    """Sorted class names; as few as a label encoder holds."""
    return sorted(r["class"] for r in per_class.select("class").distinct().collect())


def _per_class(labels: Sequence[str], value: str) -> Column:
    """Array of a value's sums by class."""
    return F.array(*[F.coalesce(F.sum(F.when(F.col("class") == c, F.col(value))), F.lit(0)) for c in labels])


def _in_all(array: str, labels: Sequence[str]) -> Column:
    """Sum of an array with one value a class."""
    return sum((F.get(array, F.lit(i)) for i in range(1, len(labels))), F.get(array, F.lit(0)))


def _added(array: str, size: int) -> Column:
    """Element-wise sum of arrays over a group."""
    return F.array(*[F.sum(F.get(array, F.lit(i))) for i in range(size)])


def term_counts(doc_terms: DataFrame, labels: Sequence[str], keys: Sequence[str] = (), min_df: int = 1) -> DataFrame:
    """``(keys..., term, n)`` with the term's count per class, from bags ``(keys..., class, term, tf)``.

    ``min_df`` counts rows of a term, so it needs one row per text and term; otherwise
    rows may also be single words.
    """
    counts = doc_terms.where("term IS NOT NULL").groupBy(*keys, "term").agg(
        F.count(F.lit(1)).alias("__df"), _per_class(labels, "tf").alias("n")
    )
    return counts.where(F.col("__df") >= min_df).drop("__df")


def _model_rows(sizes: DataFrame, smoothing: float, smooth_prior: bool, labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Priors and unseen-term costs from ``(keys..., n_docs, n_terms, n_vocabulary)``."""
    extra = smoothing if smooth_prior else 0.0
    docs = [F.get("n_docs", F.lit(i)) for i in range(len(labels))]
    all_docs, present = F.lit(0.0), F.lit(0.0)
    for d in docs:
        all_docs, present = all_docs + d, present + F.when(d > 0, 1.0).otherwise(0.0)
    prior = [F.when(d > 0, F.log((d + extra) / (all_docs + extra * present))) for d in docs]
    mass = [F.get("n_terms", F.lit(i)) + F.lit(smoothing) * F.col("n_vocabulary") for i in range(len(labels))]
    unseen = [F.when(m > 0, F.log(F.lit(smoothing)) - F.log(m)).otherwise(F.lit(0.0)) for m in mass]
    return sizes.select(*keys, "n_docs", "n_terms", F.array(*prior).alias("log_prior"), F.array(*unseen).alias("unseen"))


def _checked(smoothing: float) -> float:
    if smoothing <= 0:
        raise ValueError("smoothing must be positive: an unseen term would cost minus infinity")
    return smoothing


def fit(
    counts: DataFrame, per_class: DataFrame, labels: Sequence[str], smoothing: float, keys: Sequence[str] = (), smooth_prior: bool = False
) -> BayesModel:
    """Model tables from :func:`term_counts` and :func:`class_counts`.

    ``smooth_prior`` also smooths the class priors (as MLlib does); otherwise they are the
    plain class shares. ``seen`` among the counts tells how often a term is expected in the
    texts to score, if that is not its count.
    """
    keys, labels, smoothing = list(keys), list(labels), _checked(smoothing)
    weights = [F.log(F.get("n", F.lit(i)) + F.lit(smoothing)) - F.log(F.lit(smoothing)) for i in range(len(labels))]
    seen = F.col("seen") if "seen" in counts.columns else _in_all("n", labels)
    terms = durable(counts.withColumns({"weights": F.array(*weights), "seen": seen}))
    totals = terms.groupBy(*keys).agg(_added("n", len(labels)).alias("n_terms"), F.count(F.lit(1)).alias("n_vocabulary"))
    docs = per_class.groupBy(*keys).agg(_per_class(labels, "n_docs").alias("n_docs"))
    if keys:
        sizes = docs.join(totals, keys, "left")
        none = F.array(*[F.lit(0).cast("bigint") for _ in labels])
        sizes = sizes.withColumns({"n_terms": F.coalesce("n_terms", none), "n_vocabulary": F.coalesce("n_vocabulary", F.lit(0))})
    else:
        both = totals.select(F.struct("n_terms", "n_vocabulary")).scalar()
        sizes = docs.withColumns({"n_terms": both["n_terms"], "n_vocabulary": both["n_vocabulary"]})
    models = stored_lookup(_model_rows(sizes, smoothing, smooth_prior, labels, keys))
    lookup = measured_lookup(terms.select(*keys, "term", "weights", "seen"), weight="seen")
    return BayesModel(
        tuple(keys), labels, models, lookup, (*keys, "term"),
        lambda i: F.get("weights", F.lit(i)), F.col("weights").isNotNull(),
    )


def fit_left_out(doc_terms: DataFrame, docs: DataFrame, folds: int, smoothing: float, fold: str = "fold") -> BayesModel:
    """One model per left-out fold from a single pass: totals minus the fold's own counts.

    A term's row holds its count per class and, sparsely, per (fold, class), so the lookup
    has as many rows as the vocabulary, whatever the number of folds.
    """
    smoothing = _checked(smoothing)
    own_docs = durable(class_counts(docs, [fold]))
    labels = class_labels(own_docs)
    size, codes = len(labels), range(folds * len(labels))
    place = F.col(fold) * size + F.array_position(F.array(*[F.lit(c) for c in labels]), F.col("class")).cast("int") - 1
    own = F.array(*[F.coalesce(F.sum(F.when(F.col("__place") == j, F.col("tf"))), F.lit(0)) for j in codes])
    dense = doc_terms.where("term IS NOT NULL").withColumn("__place", place).groupBy("term").agg(own.alias("__own"))
    filled = F.filter(F.transform("__own", lambda n, j: F.struct(j.alias("place"), n.alias("n"))), lambda e: e["n"] > 0)
    total = F.array(*[sum((F.get("__own", F.lit(f * size + i)) for f in range(1, folds)), F.get("__own", F.lit(i))) for i in range(size)])
    terms = durable(dense.select("term", total.alias("n"), F.map_from_entries(filled).alias("own")))
    seen = sum((F.get("n", F.lit(i)) for i in range(1, size)), F.get("n", F.lit(0)))

    # Tables of folds x classes from here on.
    sums = terms.select(F.explode("own").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n"))
    sole = F.floor(F.array_min(F.map_keys("own")) / size)
    only_here = terms.where(sole == F.floor(F.array_max(F.map_keys("own")) / size)).groupBy(sole.cast("int").alias(fold)).count()
    all_terms = terms.agg(F.struct(_added("n", size).alias("n"), F.count(F.lit(1)).alias("v"))).scalar()
    all_docs = own_docs.agg(_per_class(labels, "n_docs")).scalar()
    per_fold = own_docs.groupBy(fold).agg(_per_class(labels, "n_docs").alias("__docs"))
    fold_terms = sums.groupBy(F.floor(F.col("place") / size).cast("int").alias(fold)).agg(
        F.array(*[F.coalesce(F.sum(F.when(F.pmod("place", F.lit(size)) == i, F.col("n"))), F.lit(0)) for i in range(size)]).alias("__terms")
    )
    joined = per_fold.join(fold_terms, fold, "left").join(only_here, fold, "left").withColumns({"__at": all_terms, "__ad": all_docs})

    def rest(whole: Column, part: str) -> Column:
        return F.array(*[F.get(whole, F.lit(i)) - F.coalesce(F.get(part, F.lit(i)), F.lit(0)) for i in range(size)])

    sizes = joined.select(
        fold, rest(F.col("__ad"), "__docs").alias("n_docs"), rest(F.col("__at.n"), "__terms").alias("n_terms"),
        (F.col("__at.v") - F.coalesce("count", F.lit(0))).alias("n_vocabulary"),
    )
    models = stored_lookup(_model_rows(sizes, smoothing, False, labels, [fold]))

    def remaining(i: int) -> Column:
        return F.get("n", F.lit(i)) - F.coalesce(F.try_element_at("own", F.col(fold) * size + i), F.lit(0))

    def gain(i: int) -> Column:
        return F.log(remaining(i) + F.lit(smoothing)) - F.log(F.lit(smoothing))

    known = sum((remaining(i) for i in range(1, size)), remaining(0)) > 0
    return BayesModel((fold,), labels, models, measured_lookup(terms.withColumn("seen", seen), weight="seen"), ("term",), gain, known)


def _with_model(df: DataFrame, model: BayesModel, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add each row's ``__prior`` and ``__unseen`` arrays."""
    rows = model.models.rows.select(*model.keys, F.col("log_prior").alias("__prior"), F.col("unseen").alias("__unseen"))
    if model.keys:
        return join_lookup(df, Lookup(rows, model.models.size), model.keys, broadcast_bytes=broadcast_bytes)
    only = rows.select(F.struct("__prior", "__unseen")).scalar()
    return df.withColumns({"__prior": only["__prior"], "__unseen": only["__unseen"]})


def class_table(model: BayesModel) -> DataFrame:
    """``(keys..., class, n_docs, n_terms, log_prior)`` of the classes each model knows."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("class"), *[F.get(col, F.lit(i)).alias(col) for col in ("n_docs", "n_terms", "log_prior")])
            for i, c in enumerate(model.labels)
        ]
    )
    return model.models.rows.select(*model.keys, F.inline(rows)).where("log_prior IS NOT NULL")


def likelihoods(model: BayesModel) -> DataFrame:
    """``(keys..., class, term, log_prob)`` for every class and vocabulary term."""
    joined = _with_model(model.terms.rows, model)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.when(F.get("__prior", F.lit(i)).isNotNull(), F.get("__unseen", F.lit(i)) + model.gain(i)).alias("log_prob"),
            )
            for i, c in enumerate(model.labels)
        ]
    )
    return joined.select(*model.keys, "term", F.inline(rows)).where("log_prob IS NOT NULL")


def _words_once(doc_terms: DataFrame, model: BayesModel, doc: Sequence[str], broadcast_bytes: int) -> DataFrame:
    """Bags joined to a lookup beyond the broadcast limit, in one pass over the words.

    A document's words of the heaviest keys are summed into one row without a term, each of its
    other words is one row. Only these rows are stored, counted for hot keys and shuffled to the lookup.
    """
    heavy, light = heavy_and_light(model.terms, broadcast_bytes)
    if heavy is None:
        found = doc_terms.withColumns({"__found": F.lit(False), "__known": F.lit(False), **{f"__g_{i}": F.lit(0.0) for i in range(len(model.labels))}})
    else:
        marked = F.broadcast(heavy.withColumn("__heavy", F.lit(True)))
        joined = doc_terms.join(marked, list(model.term_keys), "left")
        gains = {f"__g_{i}": F.col("tf") * model.gain(i) for i in range(len(model.labels))}
        found = joined.withColumns({"__found": F.col("__heavy").isNotNull(), "__known": F.coalesce(model.known, F.lit(False)), **gains})
    other = F.when(~F.col("__found"), F.col("term")).alias("term")
    sums = [F.coalesce(F.sum(F.when(F.col("__known"), F.col(f"__g_{i}"))), F.lit(0.0)).alias(f"__gain_{i}") for i in range(len(model.labels))]
    words = F.sum(F.when(F.col("__known"), F.col("tf")).otherwise(0)).alias("__n")
    once = durable(found.groupBy(*doc, other).agg(F.sum("tf").alias("tf"), words, *sums))
    return salted_join(once, light, model.term_keys, "left")


def score(doc_terms: DataFrame, model: BayesModel, doc: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc..., scores)``: log posteriors (unnormalised) in label order, NULL for a class
    the model lacks.

    ``doc_terms`` are outer bags or word rows ``(doc..., term, tf)``, with the model keys
    among ``doc``.
    Terms outside a model's vocabulary are ignored; a text without known terms is scored
    by the priors. A document's rows lie in one task, so only one row of partial sums per
    document is shuffled, and beyond the broadcast limit its words of light keys.
    """
    size = range(len(model.labels))
    if model.terms.size > broadcast_bytes and model.terms.weight:
        joined, words, gains = _words_once(doc_terms, model, doc, broadcast_bytes), F.col("__n"), [F.col(f"__gain_{i}") for i in size]
    else:
        joined, words, gains = join_lookup(doc_terms, model.terms, model.term_keys, "left", broadcast_bytes), F.lit(0), [F.lit(0.0) for _ in size]
    known = F.coalesce(model.known, F.lit(False))
    summed = joined.groupBy(*doc).agg(
        F.sum(words + F.when(known, F.col("tf")).otherwise(0)).alias("__n"),
        *[F.sum(gains[i] + F.when(known, F.col("tf") * model.gain(i)).otherwise(0.0)).alias(f"__gain_{i}") for i in size],
    )
    scores = [F.get("__prior", F.lit(i)) + F.col("__n") * F.get("__unseen", F.lit(i)) + F.col(f"__gain_{i}") for i in size]
    return _with_model(summed, model, broadcast_bytes).select(*doc, F.array(*scores).alias("scores"))


def predict(doc_terms: DataFrame, model: BayesModel, doc: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc..., predicted, score)``: the class with the largest score, first label on ties."""
    scored = score(doc_terms, model, doc, broadcast_bytes)
    options = [
        F.when(F.get("scores", F.lit(i)).isNotNull(), F.struct((-F.get("scores", F.lit(i))).alias("cost"), F.lit(c).alias("label")))
        for i, c in enumerate(model.labels)
    ]
    best = F.array_min(F.array(*options))
    return scored.select(*doc, best["label"].alias("predicted"), (-best["cost"]).alias("score"))


def entity_models(doc_terms: DataFrame, docs: DataFrame, entity: str, smoothing: float, min_rows: int = 2) -> BayesModel:
    """One model per lower-case entity with at least ``min_rows`` texts, and the global
    model, whose counts are the sums of the entities' counts."""
    lower = F.lower(F.col(entity))
    per_class = durable(class_counts(docs.withColumn(entity, lower), [entity]))
    labels = class_labels(per_class)
    per_term = durable(term_counts(doc_terms.withColumn(entity, lower), labels, [entity]))
    eligible = per_class.groupBy(entity).agg(F.sum("n_docs").alias("__n")).where(F.col("__n") >= min_rows).select(entity)
    key = F.lit(GLOBAL).alias(entity)
    all_docs = per_class.groupBy("class").agg(F.sum("n_docs").alias("n_docs")).select(key, "class", "n_docs")
    # Texts of an entity with a model of its own do not meet the global terms.
    marked = join_lookup(per_term.withColumn("seen", _in_all("n", labels)), eligible.withColumn("__own", F.lit(True)), [entity], "left")
    elsewhere = F.sum(F.when(F.col("__own").isNull(), F.col("seen")).otherwise(0)).alias("seen")
    all_terms = marked.groupBy("term").agg(_added("n", len(labels)).alias("n"), elsewhere).select(key, "term", "n", "seen")
    own_docs = per_class.join(eligible, entity).select(entity, "class", "n_docs")
    own_terms = marked.where("__own").select(entity, "term", "n", "seen")
    return fit(own_terms.unionByName(all_terms), own_docs.unionByName(all_docs), labels, smoothing, [entity])


def resolve_entity(df: DataFrame, model: BayesModel, entity: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace the entity by the key of its model, or by the global key if it has none."""
    known = model.models.rows.select(F.col(entity).alias("__key"), F.lit(True).alias("__found"))
    keyed = df.withColumn("__key", F.lower(F.col(entity)))
    matched = join_lookup(keyed, Lookup(known, model.models.size), ["__key"], "left", broadcast_bytes)
    return matched.withColumn(entity, F.when(F.col("__found"), F.col("__key")).otherwise(F.lit(GLOBAL))).drop("__key", "__found")
