"""Text reports over documents and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.operators import text as T
from sparkmine.plans.registry import registrar
from sparkmine.sources.tables import spread, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


query = registrar(QUERIES, ORACLE)

# The same separators in DuckDB's regex dialect.
SQL_TOKENS = r"""(SELECT doc_id, lang, source, term FROM (
    SELECT doc_id, lang, source, unnest(regexp_split_to_array(lower(text), '[\s[:punct:]\x{2014}\x{2026}\x{201C}\x{201E}]+')) AS term
    FROM documents) WHERE term <> '')"""
SQL_SPACES = r"'[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'"
SQL_WORDS = f"""(SELECT doc_id, lang, source, word FROM (
    SELECT doc_id, lang, source, unnest(regexp_split_to_array(text, {SQL_SPACES})) AS word FROM documents) WHERE word <> '')"""
SQL_PAGE_TEXT = r"""replace(replace(replace(replace(
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
            '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
            '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
        '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'), '&amp;', '&')"""
SQL_CLEAN = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({SQL_PAGE_TEXT},
        '[#",!?;<>/\\*&-]', ' ', 'g'), '\[[^\]]*\]', ' ', 'g'), '[:.+=()–©°′″•↑—]', ' ', 'g'), '\d+\.?\d*', ' ', 'g')"""
SQL_PAGE_COUNTS = f"""
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array({SQL_CLEAN}, {SQL_SPACES})) AS word FROM pages)
    WHERE word <> '' GROUP BY word"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Texts spread over all cores, with the columns a report keeps."""
    return spread(_documents(spark, sf_dir).select(*columns, "text"))


def page_counts(pages: DataFrame) -> DataFrame:
    return T.word_counts(spread(pages.select("html")), X.words(X.cleaned_web_text("html")))


@query(SQL_PAGE_COUNTS)
def page_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of the visible, cleaned text of all web pages."""
    return page_counts(table(spark, sf_dir, "pages"))


@query(f"SELECT * FROM ({SQL_PAGE_COUNTS}) ORDER BY n DESC, word LIMIT 10")
def page_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.most_common(page_counts(table(spark, sf_dir, "pages")), 10)


@query(f"SELECT word, count(*) AS n FROM {SQL_WORDS} GROUP BY word ORDER BY n DESC, word LIMIT 10")
def word_count_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.most_common(T.word_counts(_texts(spark, sf_dir), X.words("text")), 10)


@query(f"SELECT word, count(*) AS n FROM {SQL_WORDS} GROUP BY word ORDER BY n, word LIMIT 20")
def word_count_rarest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rarest(T.word_counts(_texts(spark, sf_dir), X.words("text")), 20)


@query(f"SELECT term, count(*) AS n FROM {SQL_TOKENS} GROUP BY term")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.word_counts(_texts(spark, sf_dir), X.tokens("text"), "term")


@query(f"SELECT doc_id, term, count(*) AS tf FROM {SQL_TOKENS} GROUP BY doc_id, term")
def doc_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.doc_terms(_texts(spark, sf_dir, "doc_id"), ["doc_id"], X.tokens("text"))


@query(f"""
    SELECT term, n, df, row_number() OVER (ORDER BY n DESC, term) - 1 AS term_id
    FROM (SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM {SQL_TOKENS} GROUP BY term) WHERE df >= 2""")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of at least two documents, ranked by count."""
    return T.vocabulary(T.doc_terms(_texts(spark, sf_dir, "doc_id"), ["doc_id"], X.tokens("text")), min_df=2)


@query("""
    SELECT lang AS label, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS "index"
    FROM documents GROUP BY lang""")
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.label_index(_documents(spark, sf_dir), "lang")


@query("""
    SELECT source AS label, count(*) AS n, row_number() OVER (ORDER BY source) - 1 AS "index"
    FROM documents GROUP BY source""")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.label_index(_documents(spark, sf_dir), "source", by_frequency=False)


@query("SELECT source AS entity, lang AS sentiment, count(*) AS \"count()\" FROM documents GROUP BY 1, 2")
def entity_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(F.col("source").alias("entity"), F.col("lang").alias("sentiment"))
    return docs.groupBy("entity", "sentiment").agg(F.count(F.lit(1)).alias("count()"))


@query(f"""
    SELECT source AS entity, lang AS sentiment, sum(len(list_filter(regexp_split_to_array(text, {SQL_SPACES}), lambda x: x <> '')))::BIGINT AS word_sum
    FROM documents GROUP BY 1, 2""")
def entity_word_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per entity and class: a row map followed by a grouped sum."""
    counted = _texts(spark, sf_dir, "source", "lang").withColumn("word_count", X.word_count("text"))
    return counted.groupBy(F.col("source").alias("entity"), F.col("lang").alias("sentiment")).agg(
        F.sum("word_count").alias("word_sum")
    )


@query(f"SELECT word FROM {SQL_WORDS}")
def flat_map_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every text, one row each."""
    return T.exploded(_texts(spark, sf_dir), X.words("text"), "word", keep=[])


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE source = 'src3'")
def entity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one entity by a native predicate, which reaches the scan."""
    return _documents(spark, sf_dir).where(F.col("source") == "src3").select("doc_id", "lang", "source", "n_chars")


@query(f"SELECT doc_id, lang, source, word, count(*) AS n FROM {SQL_WORDS} GROUP BY ALL")
def flat_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words next to the columns of their source row, counted per row."""
    texts = _texts(spark, sf_dir, "doc_id", "lang", "source")
    return T.doc_terms(texts, ["doc_id", "lang", "source"], X.words("text")).select(
        "doc_id", "lang", "source", F.col("term").alias("word"), F.col("tf").alias("n")
    )
