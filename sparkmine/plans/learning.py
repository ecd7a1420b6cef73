"""Reports from MLlib models: documents with quality labels, daily orders, order lines."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, StringIndexer
from pyspark.ml.linalg import SparseVector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.functions.dates import periodic_columns
from sparkmine.operators import bayes_grid as NB
from sparkmine.operators import learning as ML
from sparkmine.operators import linear as L
from sparkmine.operators import logistic as G
from sparkmine.operators import metrics as M
from sparkmine.operators import sampling as S
from sparkmine.operators import trees as R
from sparkmine.operators.text import doc_terms
from sparkmine.plans.registry import registrar
from sparkmine.plans.sampling import sql_hash_split
from sparkmine.plans.sqlmath import newton_logistic
from sparkmine.plans.text import SQL_SPACES, SQL_TOKENS
from sparkmine.plans.timeseries import daily_orders
from sparkmine.session import durable
from sparkmine.sources.tables import spread, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)

SPLIT = {"train": 0.7, "test": 0.3}
QUALITY_FEATURES = ["chars", "words", "word_length"]


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size measures of all documents."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars"))
    words = X.word_count("text").cast("double")
    return documents.select(
        "doc_id", "lang", (F.col("n_chars") / 1000).alias("chars"), (words / 100).alias("words"),
        F.coalesce(F.try_divide(F.col("n_chars"), words), F.lit(0.0)).alias("word_length"),
    )


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _measured(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return durable(S.hash_split(labelled, "doc_id", SPLIT, seed=123))


SQL_MEASURED = f"""(SELECT doc_id, lang, chars, words, CASE WHEN words = 0 THEN 0 ELSE n_chars / (words * 100) END AS word_length FROM (
    SELECT doc_id, lang, n_chars, n_chars / 1000.0::DOUBLE AS chars,
           len(list_filter(regexp_split_to_array(text, {SQL_SPACES}), lambda x: x <> '')) / 100.0::DOUBLE AS words FROM documents))"""
SQL_QUALITY = f"""measured AS MATERIALIZED (SELECT * FROM {SQL_MEASURED}),
    quality AS MATERIALIZED (SELECT m.*, quality, {sql_hash_split("doc_id", SPLIT, 123)} AS split FROM measured m JOIN labels USING (doc_id)),
    train AS MATERIALIZED (SELECT * FROM quality WHERE split = 'train' AND chars IS NOT NULL AND words IS NOT NULL AND word_length IS NOT NULL)"""
REG = 0.1
SQL_P1 = "1 / (1 + exp(-(b + w0 * chars + w1 * words + w2 * word_length)))"


def _sql_best(rows: str) -> str:
    """(threshold, f): the score with the best F-measure, the highest one on ties."""
    return f"""(SELECT arg_max(p1, (f, p1)) AS threshold, max(f) AS f FROM (
        SELECT p1, 2 * sum(y) OVER w / (sum(y) OVER w + sum(n - y) OVER w + sum(y) OVER ())::DOUBLE AS f FROM (
            SELECT p1, count(*) AS n, sum(quality) AS y FROM {rows} GROUP BY p1) WINDOW w AS (ORDER BY p1 DESC)))"""


def _quality_model(rows: DataFrame) -> G.Logistic:
    return G.fit_logistic(rows, QUALITY_FEATURES, "quality", REG)


def _tuned(model: G.Logistic, rows: DataFrame) -> tuple[G.Logistic, float]:
    """The model with the threshold of the best F-measure on labelled rows, and that measure."""
    scored = model.score(rows).where("p1 IS NOT NULL")
    best = M.best_threshold(M.fmeasure_by_threshold(scored, "p1", "quality")).first()
    return replace(model, threshold=best["threshold"]), best["f_measure"]


@query(f"""
    WITH {SQL_QUALITY}, fit AS MATERIALIZED (SELECT * FROM {newton_logistic("train", QUALITY_FEATURES, "quality", REG)}),
    scored AS (SELECT quality.*, {SQL_P1} AS p1 FROM quality, fit)
    SELECT doc_id, split, quality, (p1 > 0.5)::DOUBLE AS prediction, round(p1, 9) AS p1, round(greatest(p1, 1 - p1), 9) AS prob FROM scored""")
def logreg_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic model of quality: every labelled document with its class and confidence; NULL where a feature is."""
    rows = _quality(spark, sf_dir)
    scored = _quality_model(rows.where("split = 'train'")).score(rows)
    prob = F.round(F.greatest(F.col("p1"), 1 - F.col("p1")), 9).alias("prob")
    return scored.select("doc_id", "split", "quality", "prediction", F.round("p1", 9).alias("p1"), prob)


@query(f"""
    WITH {SQL_QUALITY}, fit AS (SELECT * FROM {newton_logistic("train", QUALITY_FEATURES, "quality", REG)}),
    terms AS (SELECT unnest({QUALITY_FEATURES}) AS feature, unnest([w0, w1, w2]) AS coef FROM fit)
    SELECT feature, round(coef, 8) AS coef, round(exp(coef), 8) AS odds_ratio, round((exp(coef) - 1) * 100, 6) AS percent_change FROM terms""")
def odds_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds effect of a thousand characters, a hundred words and one letter per word."""
    table_ = G.odds_table(_quality_model(_quality(spark, sf_dir).where("split = 'train'")), spark)
    return table_.select("feature", *[F.round(c, d).alias(c) for c, d in (("coef", 8), ("odds_ratio", 8), ("percent_change", 6))])


@query(f"""
    WITH {SQL_QUALITY}, fit AS MATERIALIZED (SELECT * FROM {newton_logistic("train", QUALITY_FEATURES, "quality", REG)}),
    scored AS MATERIALIZED (SELECT quality.*, {SQL_P1} AS p1 FROM quality, fit),
    best AS (SELECT * FROM {_sql_best("(SELECT * FROM scored WHERE split = 'train' AND p1 IS NOT NULL)")}),
    t AS (SELECT quality AS y, (p1 > threshold)::INTEGER AS p, threshold, f FROM scored, best WHERE split = 'test' AND p1 IS NOT NULL),
    c AS (SELECT c, count(*) FILTER (y = c) AS support, count(*) FILTER (p = c) AS predicted, count(*) FILTER (y = c AND p = c) AS tp,
                 count(*) AS n, any_value(threshold) AS threshold, any_value(f) AS f FROM t, (VALUES (0), (1)) v(c) GROUP BY c),
    m AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted::DOUBLE END AS pr, CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END AS re,
                 2 * tp / (predicted + support)::DOUBLE AS f1, CASE WHEN n = support THEN 0 ELSE (predicted - tp) / (n - support)::DOUBLE END AS fpr
          FROM c WHERE predicted + support > 0)
    SELECT any_value(n) AS n, round(sum(tp) / any_value(n), 9) AS accuracy, round(sum(pr * support) / any_value(n), 9) AS weighted_precision,
           round(sum(re * support) / any_value(n), 9) AS weighted_recall, round(sum(f1 * support) / any_value(n), 9) AS f1,
           round(sum(fpr * support) / any_value(n), 9) AS weighted_fpr, round(any_value(threshold), 9) AS threshold, round(any_value(f), 9) AS train_f FROM m""")
def logreg_test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test metrics at the threshold with the best training F-measure."""
    rows = _quality(spark, sf_dir)
    train = rows.where("split = 'train'")
    tuned, best = _tuned(_quality_model(train), train)
    scored = tuned.score(rows.where("split = 'test'")).where("p1 IS NOT NULL")
    found = M.weighted_metrics(scored.withColumn("quality", F.col("quality").cast("double")), "quality", "prediction")
    found = found.withColumns({"threshold": F.lit(tuned.threshold), "train_f": F.lit(best)})
    return found.select("n", *[F.round(c, 9).alias(c) for c in found.columns if c != "n"])


@query(f"""
    WITH {SQL_QUALITY}, every AS MATERIALIZED (SELECT * FROM quality WHERE chars IS NOT NULL AND words IS NOT NULL AND word_length IS NOT NULL),
    fit AS MATERIALIZED (SELECT * FROM {newton_logistic("every", QUALITY_FEATURES, "quality", REG)}),
    best AS (SELECT * FROM {_sql_best(f"(SELECT quality, {SQL_P1} AS p1 FROM every, fit)")})
    SELECT doc_id, round(chars, 9) AS chars, round(words, 9) AS words, round(word_length, 9) AS word_length,
           CASE WHEN {SQL_P1} > threshold THEN 'good' WHEN {SQL_P1} <= threshold THEN 'poor' END AS result FROM measured, fit, best""")
def grid_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained and tuned model applied to every document, labelled or not; no result where a feature is NULL."""
    rows = _quality(spark, sf_dir)
    tuned, _ = _tuned(_quality_model(rows), rows)
    scored = tuned.score(_measured(spark, sf_dir))
    result = F.when(F.col("prediction").isNotNull(), ML.label_text("prediction", "good", "poor"))
    return scored.select("doc_id", *[F.round(c, 9).alias(c) for c in QUALITY_FEATURES], result.alias("result"))


@query("""
    SELECT doc_id, round(l, 9) AS logit, round(1 / (1 + exp(-l)), 9) AS p1, round(1 - 1 / (1 + exp(-l)), 9) AS p0
    FROM (SELECT doc_id, 1.9840::DOUBLE + n_chars / 1000.0::DOUBLE * -0.0375::DOUBLE + length(source) * 0.125::DOUBLE AS l FROM documents)""")
def logit_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logit and probabilities of every document from given coefficients."""
    documents = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / 1000).alias("chars"), F.length("source").alias("name"))
    explained = documents.withColumns(ML.logit_columns({"chars": -0.0375, "name": 0.125}, 1.984))
    return explained.select("doc_id", *[F.round(c, 9).alias(c) for c in ("logit", "p1", "p0")])


VOCABULARY = 10_000
HASHED = 1 << 16  # columns that all words of the texts fall into


def _token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("author"), "text")
    rows = spread(documents).select("doc_id", "author", X.tokens("text").alias("tokens"))
    return S.hash_split(rows, "doc_id", {"train": 0.8, "test": 0.2}, seed=7)


TREE_DEPTH = 30


def _tree(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, R.Tree]:
    """Stored bags of all documents, their vocabulary and the tree grown on the training documents."""
    rows = _token_rows(spark, sf_dir).where("author IS NOT NULL")
    rows = rows.withColumn("fold", F.when(F.col("split") == "train", 1).otherwise(-1))
    terms = doc_terms(rows, ["doc_id", "fold"], F.col("tokens"), packed=True)
    bags, vocabulary = R.ranked_bags(terms, rows.select("doc_id", F.col("author").alias("label"), "fold"), 0, VOCABULARY)
    return bags, vocabulary, R.grow(bags, [R.Tree(0, VOCABULARY)], TREE_DEPTH)[0]


@query()
def tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 words that a decision tree uses most to tell authors apart."""
    _, vocabulary, tree = _tree(spark, sf_dir)
    names = [r["term"] for r in vocabulary.orderBy("rank").collect()]
    return ML.importances(SparseVector(len(names), R.importances(tree)), names, spark, 20)


@query()
def tree_test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision-tree metrics on training and held-out documents."""
    bags, _, tree = _tree(spark, sf_dir)
    told = R.predictions(bags, [tree], [TREE_DEPTH], trained=True).withColumn("split", F.when(F.col("train"), "train").otherwise("test"))
    return M.weighted_metrics(told, "label", "prediction", by=["split"])


@query()
def svm_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-versus-rest linear classifier of authors over all words of the texts: macro metrics per part."""
    rows = _token_rows(spark, sf_dir)
    train = rows.where("split = 'train'")
    index = StringIndexer(inputCol="author", outputCol="label", stringOrderType="alphabetAsc").fit(train)
    hashed = HashingTF(inputCol="tokens", outputCol=ML.FEATURES, numFeatures=HASHED)
    featured = durable(index.transform(hashed.transform(rows)).select("split", "label", ML.FEATURES))
    model = ML.one_vs_rest_svm("label", max_iter=10, parallelism=4).fit(featured.where("split = 'train'"))
    return M.macro_metrics(model.transform(featured), "label", "prediction", by=["split"])


NB_FOLDS, NB_SIZES = 3, [100, 1000, 5000, 10_000]


@query()
def nb_grid_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-fold grid over vocabulary size and model type; every fit builds its vocabulary from its own training rows."""
    train = _token_rows(spark, sf_dir).where("split = 'train' AND author IS NOT NULL").select("doc_id", F.col("author").alias("label"), "tokens")
    folded = S.hash_split(train, "doc_id", {str(i): 1.0 for i in range(NB_FOLDS)}, 11, "fold").withColumn("fold", F.col("fold").cast("int"))
    bags = doc_terms(folded, ["doc_id", "label", "fold"], F.col("tokens"), outer=True)
    points = NB.cross_validated(bags, folded, NB_FOLDS, NB_SIZES).collect()
    rows = [({"CountVectorizer.vocabSize": str(p["size"]), "NaiveBayes.modelType": p["kind"]}, p["avg_f1"]) for p in points]
    return ML.points_report(rows, spark)


TREE_FOLDS, TREE_SIZES, TREE_DEPTHS = 3, [100, 1000, 10_000], [1, 10, 20, 30]
PART = {"train": 0.8, "test": 0.2}
TREE_PARTS = {str(i): 1.0 for i in range(TREE_FOLDS)}


def _sql_tree_grid() -> str:
    """The same trees by recursion over the levels; children of node n are 2 n + 1 and 2 n + 2."""
    trees = ", ".join(f"({v * len(TREE_SIZES) + i}, {v}, {s})" for v in range(TREE_FOLDS + 1) for i, s in enumerate(TREE_SIZES))
    depths = ", ".join(f"({d})" for d in TREE_DEPTHS)
    return f"""
    WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, lang AS label, CASE WHEN {sql_hash_split("doc_id", PART, 7)} = 'test' THEN -1
        ELSE CAST({sql_hash_split("doc_id", TREE_PARTS, 11)} AS INTEGER) END AS fold FROM documents WHERE lang IS NOT NULL),
    bag AS MATERIALIZED (SELECT doc_id, fold, term, count(*) AS tf FROM {SQL_TOKENS} JOIN docs USING (doc_id) GROUP BY ALL),
    tree(tree, variant, size) AS (VALUES {trees}),
    vocabulary AS (SELECT variant, term, row_number() OVER (PARTITION BY variant ORDER BY sum(tf) DESC, term) - 1 AS word
        FROM bag JOIN range({TREE_FOLDS + 1}) v(variant) ON fold >= 0 AND fold <> variant GROUP BY variant, term HAVING count(*) >= 2),
    member AS MATERIALIZED (SELECT tree, variant, size, doc_id, label, fold >= 0 AND fold <> variant AS train FROM docs, tree WHERE fold >= 0 OR variant = {TREE_FOLDS}),
    seen AS MATERIALIZED (SELECT tree, doc_id, word, least(tf, 31) AS c FROM member JOIN bag USING (doc_id) JOIN vocabulary USING (variant, term) WHERE word < size),
    state(level, tree, doc_id, label, train, node) AS (
        SELECT 0, tree, doc_id, label, train, 0::BIGINT FROM member
        UNION ALL
        SELECT level + 1, s.tree, s.doc_id, label, train, 2 * s.node + 1 + (coalesce(c, 0) >= b)::INTEGER
        FROM state s JOIN (
            SELECT tree, node, arg_max(word, (score, -word, -b)) AS word, arg_max(b, (score, -word, -b)) AS b FROM (
                SELECT tree, node, word, b, (any_value(squares) + sum((a - n) * (a - n) - a * a)) / (any_value(every) - sum(n))::DOUBLE + sum(n * n) / sum(n)::DOUBLE AS score,
                       any_value(squares) / any_value(every)::DOUBLE AS now
                FROM (SELECT tree, node, word, b, label, count(*)::BIGINT AS n FROM (
                        SELECT st.tree, node, label, word, unnest(range(1, c + 1)) AS b FROM state st JOIN seen USING (tree, doc_id) WHERE train) GROUP BY ALL)
                JOIN (SELECT tree, node, label, count(*)::BIGINT AS a FROM state WHERE train GROUP BY ALL) USING (tree, node, label)
                JOIN (SELECT tree, node, sum(a)::BIGINT AS every, sum(a * a)::BIGINT AS squares FROM (SELECT tree, node, label, count(*)::BIGINT AS a FROM state WHERE train GROUP BY ALL) GROUP BY ALL) USING (tree, node)
                GROUP BY tree, node, word, b HAVING sum(n) < any_value(every)
            ) WHERE score > now + 1e-9 GROUP BY tree, node
        ) best ON best.tree = s.tree AND best.node = s.node LEFT JOIN seen ON seen.tree = s.tree AND seen.doc_id = s.doc_id AND seen.word = best.word
        WHERE level < {max(TREE_DEPTHS)}
    ),
    kept AS MATERIALIZED (SELECT * FROM state),
    major AS (SELECT tree, node, arg_min(label, (-n, label)) AS prediction FROM (SELECT tree, node, label, count(*) AS n FROM kept WHERE train GROUP BY ALL) GROUP BY ALL),
    reached AS (SELECT tree, depth, doc_id, any_value(label) AS label, arg_max(node, level) AS node FROM kept, (VALUES {depths}) d(depth) WHERE NOT train AND level <= depth GROUP BY ALL),
    told AS MATERIALIZED (SELECT tree, depth, label, prediction FROM reached JOIN major USING (tree, node)),
    class AS (SELECT tree, depth, c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted, count(*) FILTER (label = c AND prediction = c) AS tp
        FROM told JOIN (SELECT DISTINCT label AS c FROM docs) ON label = c OR prediction = c GROUP BY ALL),
    f AS (SELECT tree, depth, sum(2 * tp / (predicted + support)::DOUBLE * support) / sum(support) AS f1, sum(tp) / sum(support)::DOUBLE AS accuracy FROM class GROUP BY ALL),
    grid AS (SELECT size, depth, avg(f1) AS avg_f1 FROM f JOIN tree USING (tree) WHERE variant < {TREE_FOLDS} GROUP BY ALL),
    top AS (SELECT size, depth, TRUE AS best FROM grid ORDER BY round(avg_f1, 12) DESC, size, depth LIMIT 1)
    SELECT size, depth, round(avg_f1, 9) AS avg_f1, coalesce(best, FALSE) AS best, round(CASE WHEN best THEN f1 END, 9) AS test_f1, round(CASE WHEN best THEN accuracy END, 9) AS test_accuracy
    FROM grid LEFT JOIN top USING (size, depth) LEFT JOIN (SELECT size, depth, f1, accuracy FROM f JOIN tree USING (tree) WHERE variant = {TREE_FOLDS}) USING (size, depth)"""


@query(_sql_tree_grid())
def tree_grid_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-fold grid over vocabulary size and tree depth; the best point refitted on all folds and scored on held-out documents."""
    rows = _token_rows(spark, sf_dir).where("author IS NOT NULL")
    rows = S.hash_split(rows, "doc_id", TREE_PARTS, 11, name="fold")
    rows = rows.withColumn("fold", F.when(F.col("split") == "test", -1).otherwise(F.col("fold").cast("int")))
    terms = doc_terms(rows, ["doc_id", "fold"], F.col("tokens"), packed=True)
    bags, _ = R.ranked_bags(terms, rows.select("doc_id", F.col("author").alias("label"), "fold"), TREE_FOLDS, max(TREE_SIZES))
    grid, _ = R.tuned_tree(bags, TREE_FOLDS, TREE_SIZES, TREE_DEPTHS)
    return grid.select("size", "depth", "best", *[F.round(c, 9).alias(c) for c in ("avg_f1", "test_f1", "test_accuracy")])


DAY_FEATURES = ["yr", "mnth", "weekday", "workingday", "unixdate"]


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily orders with calendar columns, in parts."""
    days = daily_orders(spark, sf_dir).withColumns({
        "yr": F.year("day"), "mnth": F.month("day"), "weekday": F.weekday("day"),
        "workingday": (F.weekday("day") < 5).cast("int"), "unixdate": F.unix_timestamp(F.col("day").cast("timestamp")).cast("double"),
    })
    return durable(S.hash_split(days, "t", {"train": 0.8, "test": 0.2}, seed=42))


@query()
def regressor_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear, tree, forest and boosted regression of the daily orders, best r2 first."""
    days = _days(spark, sf_dir)
    estimators = {
        "LinearRegression": LinearRegression(maxIter=100, regParam=0.3, elasticNetParam=0.5),
        "DecisionTreeRegressor": DecisionTreeRegressor(seed=42),
        "RandomForestRegressor": RandomForestRegressor(seed=42),
        "GBTRegressor": GBTRegressor(seed=42),
    }
    table_, _ = ML.compare_regressors(days.where("split = 'train'"), days.where("split = 'test'"), DAY_FEATURES, "y", estimators)
    return table_


def _scaled(days: DataFrame) -> DataFrame:
    """Time scaled to [0, 1] keeps high powers comparable."""
    return days.withColumn("instant", F.col("t") / F.greatest(days.agg(F.max("t")).scalar(), F.lit(1)))


@query()
def poly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend polynomials of degree 2 to 4 with their fit summaries."""
    days = durable(_scaled(daily_orders(spark, sf_dir)))
    trials = [(2, 10, 0.01, 0.0), (3, 1000, 0.01, 1.0), (4, 1000, 0.001, 0.0)]
    report = None
    for degree, max_iter, reg, net in trials:
        estimator = LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=net)
        model = ML.linear_pipeline(["instant"], "y", degree, estimator=estimator).fit(days)
        row = ML.fit_summary(model.stages[-1], spark).withColumn("degree", F.lit(degree))
        report = row if report is None else report.unionByName(row)
    return report


@query()
def periodic_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degree-4 trend with weekly and yearly waves: true and predicted daily orders."""
    days = durable(_scaled(daily_orders(spark, sf_dir)).withColumns(periodic_columns(F.col("t"), [7, 365.25])))
    waves = list(periodic_columns(F.col("t"), [7, 365.25]))
    estimator = LinearRegression(maxIter=1000, regParam=0.001, elasticNetParam=0.0)
    model = ML.linear_pipeline(["instant"], "y", 4, extra=waves, estimator=estimator).fit(days)
    return ML.true_and_predicted(model, days, ["t"], "y")


@query()
def onehot_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line price from one-hot flags and squared measures: metrics on both parts."""
    columns = ["l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"]
    lines = spread(table(spark, sf_dir, "lineitem").select(columns).na.drop())
    lines = lines.withColumns(L.squared_columns(["l_quantity", "l_discount"])).drop("l_tax")
    split = S.hash_split(lines, "l_orderkey", {"train": 0.8, "test": 0.2}, seed=42)
    flags = ["l_returnflag", "l_linestatus"]
    numbers = ["l_quantity", "l_discount", "l_linenumber", "l_quantity_sq", "l_discount_sq"]
    estimator = LinearRegression(maxIter=100, regParam=0.3, elasticNetParam=0.5)
    regression = ML.linear_pipeline([*numbers, *[f"{f}_vec" for f in flags]], "l_extendedprice", handle_invalid="keep", estimator=estimator)
    model = Pipeline(stages=[*ML.one_hot_stages(flags), *regression.getStages()]).fit(split.where("split = 'train'"))
    parts = {name: split.where(F.col("split") == name) for name in ("train", "test")}
    return ML.train_test_metrics(model, parts, "l_extendedprice")
