"""Text classification with naive Bayes: authors are languages, entities are sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.operators import bayes as B
from sparkmine.operators import metrics as M
from sparkmine.operators import sampling as S
from sparkmine.operators.text import doc_terms, word_rows
from sparkmine.plans.registry import registrar
from sparkmine.plans.sampling import sql_seeded_key, sql_stratified_folds
from sparkmine.plans.text import SQL_TOKENS
from sparkmine.session import durable
from sparkmine.sources.tables import spread, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)

SPLIT_SEED, FOLDS = 7, 10


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, class, entity, split, text) of all documents."""
    documents = table(spark, sf_dir, "documents")
    named = documents.select("doc_id", F.col("lang").alias("class"), F.col("source").alias("entity"), "text")
    return S.hash_split(named, "doc_id", {"train": 0.8, "test": 0.2}, SPLIT_SEED)


def bag_of_words(documents: DataFrame, columns: list[str], rule: bool = False, counted: bool = False) -> DataFrame:
    """Words of the texts; recomputed where needed, since they outweigh the texts."""
    items = X.rule_words("text") if rule else X.tokens("text")
    return doc_terms(spread(documents), columns, items, outer=True) if counted else word_rows(spread(documents), columns, items)


def _split_model(spark: SparkSession, sf_dir: str, smoothing: float, min_df: int) -> B.BayesModel:
    train = labelled_documents(spark, sf_dir).where("split = 'train'")
    per_class = durable(B.class_counts(train))
    labels = B.class_labels(per_class)
    return B.fit(B.term_counts(bag_of_words(train, ["class"], counted=min_df > 1), labels, min_df=min_df), per_class, labels, smoothing)


SQL_SPLIT = f"""CASE WHEN {sql_seeded_key("doc_id", SPLIT_SEED)} < cast(floor(0.8::DOUBLE * 2147483647) AS BIGINT)
    THEN 'train' ELSE 'test' END"""
SQL_MODEL = f"""
    bag AS (SELECT doc_id, lang AS class, {SQL_SPLIT} AS split, term, count(*) AS tf FROM {SQL_TOKENS} GROUP BY ALL),
    doc AS (SELECT doc_id, lang AS class, {SQL_SPLIT} AS split FROM documents),
    vocab AS (SELECT term FROM bag WHERE split = 'train' GROUP BY term HAVING count(*) >= 2),
    cnt AS (SELECT class, term, sum(tf) AS n FROM bag SEMI JOIN vocab USING (term) WHERE split = 'train' GROUP BY ALL),
    cls AS (SELECT class, count(*) AS n_docs, ln(count(*) / (SELECT count(*) FROM doc WHERE split = 'train')::DOUBLE) AS log_prior
            FROM doc WHERE split = 'train' GROUP BY class),
    tot AS (SELECT class, sum(n) AS n FROM cnt GROUP BY class)"""
SQL_SCORES = """
    known AS (SELECT doc_id, term, tf FROM bag SEMI JOIN vocab USING (term)),
    part AS (SELECT k.doc_id, c.class, sum(k.tf * ln((coalesce(x.n, 0) + 0.2) / (t.n + 0.2 * (SELECT count(*) FROM vocab))::DOUBLE)) AS gain
             FROM known k CROSS JOIN cls c JOIN tot t ON t.class = c.class LEFT JOIN cnt x ON x.class = c.class AND x.term = k.term
             GROUP BY ALL),
    scored AS (SELECT d.doc_id, d.split, c.class, c.log_prior + coalesce(p.gain, 0) AS score
               FROM doc d CROSS JOIN cls c LEFT JOIN part p ON p.doc_id = d.doc_id AND p.class = c.class),
    best AS (SELECT doc_id, split, class AS predicted, score,
                    row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS place FROM scored)"""


@query(f"WITH {SQL_MODEL} SELECT class, n_docs, round(log_prior, 9) AS log_prior FROM cls")
def nb_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _split_model(spark, sf_dir, 0.2, 2)
    return B.class_table(model).select("class", "n_docs", F.round("log_prior", 9).alias("log_prior"))


@query(f"""WITH {SQL_MODEL}
    SELECT c.class, v.term, round(ln((coalesce(x.n, 0) + 0.2) / (t.n + 0.2 * (SELECT count(*) FROM vocab))::DOUBLE), 7) AS log_prob
    FROM cls c CROSS JOIN vocab v JOIN tot t ON t.class = c.class LEFT JOIN cnt x ON x.class = c.class AND x.term = v.term""")
def nb_likelihoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _split_model(spark, sf_dir, 0.2, 2)
    return B.likelihoods(model).withColumn("log_prob", F.round("log_prob", 7))


def predicted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "class", "split"]
    bags = bag_of_words(labelled_documents(spark, sf_dir), columns)
    return B.predict(bags, _split_model(spark, sf_dir, 0.2, 2), columns)


@query(f"WITH {SQL_MODEL}, {SQL_SCORES} SELECT doc_id, split, predicted, round(score, 4) AS score FROM best WHERE place = 1")
def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the train part, classify all documents."""
    return predicted_documents(spark, sf_dir).select("doc_id", "split", "predicted", F.round("score", 4).alias("score"))


@query(f"""WITH {SQL_MODEL}, {SQL_SCORES}
    SELECT b.split, count(*) AS n, round(avg((d.class = b.predicted)::INTEGER), 9) AS accuracy
    FROM best b JOIN doc d ON d.doc_id = b.doc_id WHERE place = 1 GROUP BY b.split""")
def nb_train_test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy on the train and on the test part."""
    found = M.weighted_metrics(predicted_documents(spark, sf_dir), "class", "predicted", by=["split"])
    return found.select("split", "n", F.round("accuracy", 9).alias("accuracy"))


def entity_model(spark: SparkSession, sf_dir: str) -> B.BayesModel:
    train = labelled_documents(spark, sf_dir).where("split = 'train'")
    bags = bag_of_words(train, ["class", "entity"], rule=True)
    return B.entity_models(bags, train, "entity", smoothing=1.0)


def entity_predictions(requests: DataFrame, model: B.BayesModel, columns: tuple[str, ...] = ("doc_id", "entity")) -> DataFrame:
    """Classify texts with an ``entity``, each with its entity's model or the global one."""
    bags = bag_of_words(B.resolve_entity(requests, model, "entity"), list(columns), rule=True)
    return B.predict(bags, model, columns)


SQL_RULE_WORDS = r"""(SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)"""
SQL_ENTITY = f"""
    WITH bag AS (SELECT doc_id, lang AS class, source AS entity, {SQL_SPLIT} AS split, term, count(*) AS tf FROM {SQL_RULE_WORDS} GROUP BY ALL),
    doc AS (SELECT doc_id, lang AS class, source AS entity, {SQL_SPLIT} AS split FROM documents),
    cnt AS (SELECT entity, class, term, sum(tf) AS n FROM bag WHERE split = 'train' GROUP BY ALL),
    vocab AS (SELECT DISTINCT entity, term FROM cnt), size AS (SELECT entity, count(*) AS v FROM vocab GROUP BY entity),
    total AS (SELECT entity, count(*) AS n FROM doc WHERE split = 'train' GROUP BY entity),
    cls AS (SELECT d.entity, d.class, ln(count(*) / any_value(t.n)::DOUBLE) AS log_prior
            FROM doc d JOIN total t ON t.entity = d.entity WHERE split = 'train' GROUP BY ALL),
    tot AS (SELECT entity, class, sum(n) AS n FROM cnt GROUP BY ALL),
    known AS (SELECT doc_id, entity, term, tf FROM bag SEMI JOIN vocab USING (entity, term)),
    part AS (SELECT k.doc_id, c.class, sum(k.tf * ln((coalesce(x.n, 0) + 1) / (t.n + s.v)::DOUBLE)) AS gain
             FROM known k JOIN cls c ON c.entity = k.entity JOIN tot t ON t.entity = k.entity AND t.class = c.class
             JOIN size s ON s.entity = k.entity LEFT JOIN cnt x ON x.entity = k.entity AND x.class = c.class AND x.term = k.term
             GROUP BY ALL),
    best AS (SELECT d.doc_id, d.entity, c.class AS predicted, c.log_prior + coalesce(p.gain, 0) AS score,
                    row_number() OVER (PARTITION BY d.doc_id ORDER BY c.log_prior + coalesce(p.gain, 0) DESC, c.class) AS place
             FROM doc d JOIN cls c ON c.entity = d.entity LEFT JOIN part p ON p.doc_id = d.doc_id AND p.class = c.class)
    SELECT doc_id, entity, predicted, round(score, 4) AS score FROM best WHERE place = 1"""


SQL_SOURCE_METRICS = SQL_ENTITY[: SQL_ENTITY.rindex("    SELECT doc_id, entity, predicted")].rstrip() + """,
    told AS (SELECT b.entity, d.class, b.predicted FROM best b JOIN doc d ON d.doc_id = b.doc_id WHERE place = 1 AND d.split = 'test'),
    m AS (SELECT t.entity, k.c, count(*) FILTER (class = c) AS support, count(*) FILTER (predicted = c) AS predicted, count(*) FILTER (class = c AND predicted = c) AS tp
          FROM told t JOIN (SELECT DISTINCT class AS c FROM doc) k ON t.class = c OR t.predicted = c GROUP BY ALL)
    SELECT entity, CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support)::DOUBLE, 9) AS accuracy,
           round(sum(CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted::DOUBLE END * support) / sum(support), 9) AS weighted_precision,
           round(sum(CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END * support) / sum(support), 9) AS weighted_recall,
           round(sum(2 * tp / (predicted + support)::DOUBLE * support) / sum(support), 9) AS f1 FROM m GROUP BY entity"""


@query(SQL_SOURCE_METRICS)
def result_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model per source, fitted in one grouped pass, and its metrics on the source's held-out documents, one row each."""
    test = labelled_documents(spark, sf_dir).where("split = 'test'")
    told = entity_predictions(test, entity_model(spark, sf_dir), ("doc_id", "entity", "class"))
    found = M.weighted_metrics(told, "class", "predicted", by=["entity"])
    return found.select("entity", "n", *[F.round(c, 9).alias(c) for c in ("accuracy", "weighted_precision", "weighted_recall", "f1")])


@query(SQL_ENTITY)
def nb_entity_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per entity plus the global one; every document scored by its entity's."""
    documents = labelled_documents(spark, sf_dir).select("doc_id", "entity", "text")
    predicted = entity_predictions(documents, entity_model(spark, sf_dir))
    return predicted.withColumn("score", F.round("score", 4))


def _cross_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold predictions of all documents; folds are left out by subtraction."""
    named = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("class"), "text")
    documents = S.stratified_kfold(named, "doc_id", "class", FOLDS)
    bags = bag_of_words(documents, ["doc_id", "class", "fold"])
    model = B.fit_left_out(bags, documents, FOLDS, 0.2)
    return B.predict(bags, model, ["doc_id", "fold", "class"])


SQL_CV = f"""
    fold_of AS (SELECT doc_id, lang AS class, fold FROM {sql_stratified_folds(FOLDS)}),
    bag AS (SELECT t.doc_id, f.class, f.fold, term, count(*) AS tf FROM {SQL_TOKENS} t JOIN fold_of f ON f.doc_id = t.doc_id GROUP BY ALL),
    k AS (SELECT cast(i AS INTEGER) AS fold FROM range({FOLDS}) r(i)),
    own AS (SELECT fold, class, term, sum(tf) AS n FROM bag GROUP BY ALL),
    cnt AS (SELECT k.fold, o.class, o.term, sum(o.n) AS n FROM own o JOIN k ON k.fold <> o.fold GROUP BY ALL),
    vocab AS (SELECT DISTINCT fold, term FROM cnt), size AS (SELECT fold, count(*) AS v FROM vocab GROUP BY fold),
    total AS (SELECT k.fold, count(*) AS n FROM fold_of f JOIN k ON k.fold <> f.fold GROUP BY ALL),
    cls AS (SELECT k.fold, f.class, ln(count(*) / any_value(t.n)::DOUBLE) AS log_prior
            FROM fold_of f JOIN k ON k.fold <> f.fold JOIN total t ON t.fold = k.fold GROUP BY ALL),
    tot AS (SELECT fold, class, sum(n) AS n FROM cnt GROUP BY ALL),
    known AS (SELECT doc_id, fold, term, tf FROM bag SEMI JOIN vocab USING (fold, term)),
    part AS (SELECT q.doc_id, c.class, sum(q.tf * ln((coalesce(x.n, 0) + 0.2) / (t.n + 0.2 * s.v)::DOUBLE)) AS gain
             FROM known q JOIN cls c ON c.fold = q.fold JOIN tot t ON t.fold = q.fold AND t.class = c.class
             JOIN size s ON s.fold = q.fold LEFT JOIN cnt x ON x.fold = q.fold AND x.class = c.class AND x.term = q.term
             GROUP BY ALL),
    best AS (SELECT d.doc_id, d.fold, d.class, c.class AS predicted, c.log_prior + coalesce(p.gain, 0) AS score,
                    row_number() OVER (PARTITION BY d.doc_id ORDER BY c.log_prior + coalesce(p.gain, 0) DESC, c.class) AS place
             FROM fold_of d JOIN cls c ON c.fold = d.fold LEFT JOIN part p ON p.doc_id = d.doc_id AND p.class = c.class)"""


@query(f"WITH {SQL_CV} SELECT doc_id, fold, class, predicted, round(score, 4) AS score FROM best WHERE place = 1")
def nb_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified 10-fold cross-validation, one prediction per document."""
    predicted = _cross_validated(spark, sf_dir)
    return predicted.select("doc_id", "fold", "class", "predicted", F.round("score", 4).alias("score"))


@query(f"""WITH {SQL_CV},
    p AS (SELECT fold, class AS y, predicted AS z FROM best WHERE place = 1),
    c AS (SELECT fold, y AS class FROM p UNION SELECT fold, z FROM p),
    m AS (SELECT c.fold, c.class, count(*) FILTER (y = c.class AND z = c.class) AS tp, count(*) FILTER (z = c.class) AS predicted,
                 count(*) FILTER (y = c.class) AS support FROM c JOIN p ON p.fold = c.fold GROUP BY ALL)
    SELECT fold, round(sum(tp) / sum(support)::DOUBLE, 9) AS accuracy,
           round(avg(coalesce(tp / nullif(predicted, 0)::DOUBLE, 0)), 9) AS "precision",
           round(avg(coalesce(tp / nullif(support, 0)::DOUBLE, 0)), 9) AS recall,
           round(avg(2 * tp / (predicted + support)::DOUBLE), 9) AS f1_score FROM m GROUP BY fold""")
def nb_cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro metrics of every fold."""
    found = M.macro_metrics(_cross_validated(spark, sf_dir), "class", "predicted", by=["fold"])
    return found.withColumns({c: F.round(c, 9) for c in ("accuracy", "precision", "recall", "f1_score")})
