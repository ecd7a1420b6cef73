import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.operators import bayes as B
from sparkmine.operators.text import doc_terms

# The seven demo rows; the tests below hold their published probabilities.
DEMO = [
    ("Ala", "aaa aaa bbb ccc"), ("Ala", "aaa bbb ddd"), ("Ala", "aaa bbb"), ("Ala", "aaa bbb bbb"),
    ("Ola", "aaa ccc ddd"), ("Ola", "bbb ccc ddd"), ("Ola", "ccc ddd eee"),
]


def bags(df, columns):
    return doc_terms(df, columns, X.tokens("text"), outer=True)


def fitted(df, smoothing, smooth_prior=False, min_df=1):
    per_class = B.class_counts(df)
    labels = B.class_labels(per_class)
    return B.fit(B.term_counts(bags(df, ["class"]), labels, min_df=min_df), per_class, labels, smoothing, smooth_prior=smooth_prior)


@pytest.fixture(scope="module")
def demo(spark):
    return spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(DEMO)], "id int, class string, text string")


def test_demo_parameters(demo):
    model = fitted(demo, 0.01, smooth_prior=True)
    prob = {(r["class"], r["term"]): math.exp(r["log_prob"]) for r in B.likelihoods(model).collect()}
    expected = {
        ("Ala", "aaa"): 0.415768, ("Ala", "bbb"): 0.415768, ("Ala", "ccc"): 0.083817, ("Ala", "ddd"): 0.083817, ("Ala", "eee"): 0.000830,
        ("Ola", "aaa"): 0.111602, ("Ola", "bbb"): 0.111602, ("Ola", "ccc"): 0.332597, ("Ola", "ddd"): 0.332597, ("Ola", "eee"): 0.111602,
    }
    assert prob.keys() == expected.keys() and all(prob[k] == pytest.approx(v, abs=1e-6) for k, v in expected.items())
    prior = {r["class"]: math.exp(r["log_prior"]) for r in B.class_table(model).collect()}
    assert prior["Ala"] == pytest.approx(0.571225, abs=1e-6) and prior["Ola"] == pytest.approx(0.428775, abs=1e-6)


@pytest.mark.parametrize("limit", [B.BROADCAST_BYTES, 500, 0])
def test_demo_posterior(spark, demo, limit):
    request = spark.createDataFrame([(0, "aaa ccc ccc ddd")], "id int, text string")
    model = fitted(demo, 0.01, smooth_prior=True)
    scores = B.score(bags(request, ["id"]), model, ["id"], limit).first()["scores"]
    assert scores == pytest.approx([-8.87494, -6.34211], abs=1e-5)
    assert B.predict(bags(request, ["id"]), model, ["id"], limit).first()["predicted"] == "Ola"


def test_matches_library_model(spark, demo):
    from pyspark.ml.classification import NaiveBayes

    from sparkmine.operators.text import label_index, vectorizer

    vector = vectorizer(doc_terms(demo, ["id"], X.tokens("text")), "w", "features", 100)
    labels = {r["label"]: float(r["index"]) for r in label_index(demo, "class").collect()}
    rows = vector.transform(demo.withColumn("w", X.tokens("text")))
    rows = rows.withColumn("label", F.when(F.col("class") == "Ala", labels["Ala"]).otherwise(labels["Ola"]))
    library = NaiveBayes(smoothing=0.01).fit(rows)
    ours = {(r["class"], r["term"]): r["log_prob"] for r in B.likelihoods(fitted(demo, 0.01, smooth_prior=True)).collect()}
    for c, i in labels.items():
        for j, term in enumerate(vector.vocabulary):
            assert library.theta.toArray()[int(i), j] == pytest.approx(ours[(c, term)])


def test_unknown_words_and_empty_texts_use_priors(spark, demo):
    request = spark.createDataFrame([(0, "zzz"), (1, ""), (2, None)], "id int, text string")
    found = {r["id"]: (r["predicted"], r["score"]) for r in B.predict(bags(request, ["id"]), fitted(demo, 1.0), ["id"]).collect()}
    assert found == {i: ("Ala", pytest.approx(math.log(4 / 7))) for i in range(3)}


def test_zero_smoothing_is_refused(demo):
    with pytest.raises(ValueError):
        fitted(demo, 0.0)


def test_min_df_drops_rare_terms(demo):
    terms = {r["term"] for r in B.likelihoods(fitted(demo, 1.0, min_df=2)).collect()}
    assert terms == {"aaa", "bbb", "ccc", "ddd"}


def brute_force(train, text, smoothing):
    counts, docs = defaultdict(Counter), Counter()
    for c, t in train:
        docs[c] += 1
        counts[c].update(t.split())
    vocabulary = set().union(*counts.values())
    best = []
    for c in docs:
        mass = sum(counts[c].values()) + smoothing * len(vocabulary)
        s = math.log(docs[c] / sum(docs.values()))
        s += sum(math.log((counts[c][w] + smoothing) / mass) for w in text.split() if w in vocabulary)
        best.append((-s, c))
    return min(best)[1], -min(best)[0]


@pytest.mark.parametrize("limit", [B.BROADCAST_BYTES, 400, 0])
def test_left_out_models_equal_refits(spark, limit):
    rows = [(i, c, t + (" only%d" % i if i % 4 == 0 else ""), i % 3) for i, (c, t) in enumerate(DEMO * 3)]
    df = spark.createDataFrame(rows, "id int, class string, text string, fold int").repartition(5)
    columns = ["id", "fold", "class"]
    model = B.fit_left_out(bags(df, columns), df, 3, 0.2)
    found = {r["id"]: (r["predicted"], r["score"]) for r in B.predict(bags(df, columns), model, columns, limit).collect()}
    for i, _, text, fold in rows:
        predicted, score = brute_force([(c, t) for _, c, t, f in rows if f != fold], text, 0.2)
        assert found[i] == (predicted, pytest.approx(score))


@pytest.mark.parametrize("limit", [B.BROADCAST_BYTES, 500, 0])
def test_entities_fall_back_to_the_global_model(spark, limit):
    rows = [(f"E{i % 2}", c, t) for i, (c, t) in enumerate(DEMO)] + [("Solo", "Ala", "aaa")]
    df = spark.createDataFrame(rows, "entity string, class string, text string")
    model = B.entity_models(doc_terms(df, ["class", "entity"], X.tokens("text"), outer=True), df, "entity", 1.0)
    assert {r["entity"] for r in model.models.rows.collect()} == {"e0", "e1", "*"}
    requests = spark.createDataFrame([(0, "E0", "aaa eee"), (1, "SOLO", "ccc ddd"), (2, "unseen", "eee")], "id int, entity string, text string")
    resolved = B.resolve_entity(requests, model, "entity", limit)
    assert {r["id"]: r["entity"] for r in resolved.collect()} == {0: "e0", 1: "*", 2: "*"}
    found = B.predict(bags(resolved, ["id", "entity"]), model, ["id", "entity"], limit).collect()
    for r in found:
        train = [(c, t) for e, c, t in rows if r["entity"] in ("*", e.lower())]
        text = {0: "aaa eee", 1: "ccc ddd", 2: "eee"}[r["id"]]
        assert (r["predicted"], r["score"]) == (brute_force(train, text, 1.0)[0], pytest.approx(brute_force(train, text, 1.0)[1]))


@pytest.mark.parametrize("limit", [B.BROADCAST_BYTES, 300, 0])
def test_scoring_reads_the_texts_once(spark, demo, limit):
    """Whatever part of the model is broadcast; the scan, not the join, sees a text again."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    model = fitted(demo, 0.01)
    texts = demo.unionByName(demo).select(F.monotonically_increasing_id().alias("id"), seen.asNondeterministic()("text").alias("text"))
    found = B.predict(bags(texts, ["id"]), model, ["id"], limit).collect()
    assert len(found) == read.value == 2 * len(DEMO)


def test_global_terms_weigh_what_is_met_elsewhere(spark):
    rows = [("A", "x", "aaa bbb"), ("A", "y", "aaa"), ("Solo", "x", "aaa ccc")]
    df = spark.createDataFrame(rows, "entity string, class string, text string")
    model = B.entity_models(bags(df, ["class", "entity"]), df, "entity", 1.0)
    weights = {(r["entity"], r["term"]): r["seen"] for r in model.terms.rows.collect()}
    assert weights == {("a", "aaa"): 2, ("a", "bbb"): 1, ("*", "aaa"): 1, ("*", "bbb"): 0, ("*", "ccc"): 1}
