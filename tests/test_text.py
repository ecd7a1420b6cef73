import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.operators import text as T

TEXTS = [
    "Ala ma kota, a kot — „Ala”… i “Ola”!",
    "  leading and  trailing\t\n ",
    "",
    "?!...",
    "non breaking space x\u000by",
    "ZAŻÓŁĆ gęślą jaźń A_B c1 2",
]


def table(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_tokens_split_on_spaces_punctuation_and_typographic_marks(spark):
    separators = "[\\s" + re.escape(string.punctuation) + "—…“„]+"
    rows = table(spark).select("id", X.non_empty(X.tokens("text")).alias("w")).collect()
    for r in rows:
        assert r["w"] == [t for t in re.split(separators, TEXTS[r["id"]].lower(), flags=re.ASCII) if t] or r["id"] == 4


def test_tokens_equal_library_tokenizer(spark):
    from pyspark.ml.feature import RegexTokenizer

    library = RegexTokenizer(inputCol="text", outputCol="w", pattern=X.TOKEN_SEPARATORS)
    rows = library.transform(table(spark)).select("w", X.non_empty(X.tokens("text")).alias("ours")).collect()
    assert all(r["w"] == r["ours"] for r in rows)


def test_words_equal_whitespace_split(spark):
    rows = table(spark).select("id", X.non_empty(X.words("text")).alias("w"), X.word_count("text").alias("n")).collect()
    for r in rows:
        assert r["w"] == TEXTS[r["id"]].split() and r["n"] == len(r["w"])


def test_rule_words_have_two_characters(spark):
    rows = table(spark).select("id", X.rule_words("text").alias("w")).collect()
    assert {r["id"]: r["w"] for r in rows} == {i: re.findall(r"\w\w+", t.lower()) for i, t in enumerate(TEXTS)}


def test_bags_count_like_a_counter(spark):
    texts = ["b a b", "a", "", None, "  ", "x x x x y"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    bags = T.doc_terms(df, ["id"], X.words("text"))
    expected = {(i, w): n for i, t in enumerate(texts) for w, n in Counter((t or "").split()).items()}
    assert {(r["id"], r["term"]): r["tf"] for r in bags.collect()} == expected
    outer = T.doc_terms(df, ["id"], X.words("text"), outer=True)
    known = {(r["id"], r["term"]): r["tf"] for r in outer.where("term IS NOT NULL").collect()}
    assert known == expected


def test_outer_bags_keep_every_text(spark):
    from sparkmine.operators.text import doc_terms

    df = spark.createDataFrame([(1, ""), (2, None), (3, "a"), (4, " . ")], "id int, text string")
    kept = {r["id"] for r in doc_terms(df, ["id"], X.tokens("text"), outer=True).select("id").collect()}
    assert kept == {1, 2, 3, 4}


def test_vocabulary_breaks_ties_by_term_on_any_partitioning(spark):
    df = spark.createDataFrame([(0, "b a c b"), (1, "c a d")], "id int, text string")
    for n in (1, 7):
        terms = T.doc_terms(df.repartition(n), ["id"], X.words("text"))
        assert [r["term"] for r in T.vocabulary(terms).orderBy("term_id").collect()] == ["a", "b", "c", "d"]
        assert [r["term"] for r in T.vocabulary(terms, min_df=2).orderBy("term_id").collect()] == ["a", "c"]
        model = T.vectorizer(terms, "w", "features", size=2)
        assert model.vocabulary == ["a", "b"]


def test_top_and_rare_words(spark):
    counts = T.word_counts(spark.createDataFrame([("x y x",), ("y z x",)], "text string"), X.words("text"))
    assert [tuple(r) for r in T.most_common(counts, 2).collect()] == [("x", 3), ("y", 2)]
    assert [tuple(r) for r in T.rarest(counts, 1).collect()] == [("z", 1)]


def test_html_text_drops_code_and_decodes_entities(spark):
    page = (
        "<!DOCTYPE html><title>T&amp;C</title><script>var t='<p>x</p>';</script><STYLE>p{}</STYLE>"
        "<p>a<b>b</b>c &copy; &#65;&#x42; &lt;i&gt; &unknown; &amp;lt;</p><!-- hidden --><p>12.5 [note] x-y 7"
    )
    df = spark.createDataFrame([(page,)], "html string")
    text = df.select(X.html_text("html").alias("t")).first()["t"]
    assert text.split() == ["T&C", "a", "b", "c", "©", "AB", "<i>", "&unknown;", "&lt;", "12.5", "[note]", "x-y", "7"]
    cleaned = df.select(X.non_empty(X.words(X.cleaned_web_text("html"))).alias("w")).first()["w"]
    assert cleaned == ["T", "C", "a", "b", "c", "AB", "i", "unknown", "lt", "x", "y"]


def test_label_index_orders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "l string")
    by_count = {r["label"]: r["index"] for r in T.label_index(df, "l").collect()}
    by_name = {r["label"]: r["index"] for r in T.label_index(df, "l", by_frequency=False).collect()}
    assert by_count == {"b": 0, "a": 1, "c": 2} and by_name == {"a": 0, "b": 1, "c": 2}


def test_table_function_splits_words(spark):
    T.register_word_function(spark)
    rows = spark.sql("SELECT word FROM VALUES ('a b'), (NULL) AS t(text), LATERAL split_words(text) ORDER BY position").collect()
    assert [r["word"] for r in rows] == ["a", "b"]


def test_exploded_keeps_columns_by_name(spark):
    df = spark.createDataFrame([(1, "x y")], "id int, body string")
    rows = T.exploded(df, X.words(F.col("body")), "word").collect()
    assert [tuple(r) for r in rows] == [(1, "x y", "x"), (1, "x y", "y")]


def test_packed_bags_are_the_long_ones(spark):
    from sparkmine.operators.text import doc_terms, packed_terms, unpacked

    texts = ["a b a", "", None, " ".join(["x"] * 700 + ["y"] * 255 + ["z"] * 256), "b c é é"] * 3
    docs = spark.createDataFrame([(i, f"k{i % 2}", t) for i, t in enumerate(texts)], "doc_id long, kind string, text string").repartition(3)
    long = doc_terms(docs, ["doc_id", "kind"], F.split("text", " "))
    expected = sorted(map(tuple, long.collect()))

    def rows(packed):
        found = []
        for batch in packed.toArrow().to_batches():
            for row, terms, begins, places, counts in unpacked(batch):
                ids, kinds, names = row.column("doc_id")[0].as_py(), row.column("kind")[0].as_py(), terms.to_pylist()
                for i, kind, lo, hi in zip(ids, kinds, begins, begins[1:]):
                    found += [(i, kind, names[p], int(n)) for p, n in zip(places[lo:hi], counts[lo:hi])]
        return sorted(found)

    assert rows(doc_terms(docs, ["doc_id", "kind"], F.split("text", " "), packed=True)) == expected and max(r[3] for r in expected) == 700
    assert rows(packed_terms(long.repartition(5), ["doc_id", "kind"])) == expected
    with pytest.raises(ValueError):
        doc_terms(docs, ["doc_id"], F.split("text", " "), outer=True, packed=True)
