"""Word counts, vocabularies and document-term tables in long form."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators.ordering import top_k, with_row_index


def exploded(df: DataFrame, items: Column, name: str, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per non-empty array element, next to the columns in ``keep`` (all by default)."""
    return df.select(*(df.columns if keep is None else keep), F.explode(items).alias(name)).where(F.col(name) != "")


def word_counts(df: DataFrame, items: Column, name: str = "word") -> DataFrame:
    """Occurrences per word over the table; counted per task before the shuffle."""
    return exploded(df, items, name, keep=[]).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def most_common(counts: DataFrame, k: int, name: str = "word") -> DataFrame:
    return top_k(counts, k, F.desc("n"), F.asc(name))


def rarest(counts: DataFrame, k: int, name: str = "word") -> DataFrame:
    return top_k(counts, k, F.asc("n"), F.asc(name))


def doc_terms(df: DataFrame, doc: Sequence[str], items: Column, outer: bool = False, packed: bool = False) -> DataFrame:
    """``(doc..., term, tf)``: bag of words of every row, in long form.

    A text is one row, so its equal words are counted inside the row (runs of the sorted
    array) and nothing is shuffled. ``outer`` keeps texts without words, with a NULL term.
    ``packed`` gives the same rows in the form of :func:`packed_terms`, for operators that count them by numpy.
    """
    if packed:
        if outer:
            raise ValueError("a packed bag has no place for texts without words")
        return _packed_bags(df.select(*doc, items.alias("__words")), doc)
    ordered = df.select(*doc, F.sort_array(items).alias("__words"))
    words, size = F.col("__words"), F.size("__words")
    starts = F.filter(F.sequence(F.lit(0), size), lambda i: (i < size) & ((i == 0) | (F.get(words, i) != F.get(words, i - 1))))
    runs = ordered.select(*doc, "__words", starts.alias("__starts"))
    begin = F.col("__starts")
    bag = F.transform(
        begin,
        lambda p, j: F.struct(
            F.get(F.col("__words"), p).alias("term"), (F.coalesce(F.get(begin, j + 1), F.size("__words")) - p).cast("bigint").alias("tf")
        ),
    )
    unfold = F.inline_outer if outer else F.inline
    rows = runs.select(*doc, unfold(bag))
    if outer:  # an empty piece may be a text's only row
        return rows.withColumn("term", F.nullif("term", F.lit("")))
    return rows.where("term <> ''")


PACKED = 1 << 18  # words or rows in one row of packed terms
MOST = 255  # a packed count beyond this is listed apart


def _packed_layout(df: DataFrame, doc: Sequence[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    keys = ", ".join(f"`{c}` array<{kinds[c]}>" for c in doc)
    return f"{keys}, begins array<int>, terms array<string>, places binary, counts binary, over array<int>, excess array<bigint>"


def _packed_row(doc: Sequence[str], keys: Sequence[pa.Array], starts: np.ndarray, terms: pa.Array, places: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
    """One row of packed terms; ``starts``: where a document's entries begin."""
    over = np.flatnonzero(tf > MOST)
    lists = [*keys, pa.array(np.append(starts, len(tf)).astype(np.int32)), terms, pa.array(over.astype(np.int32)), pa.array(tf[over].astype(np.int64) - MOST)]
    columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
    columns[-2:-2] = [pa.array([x.tobytes()], pa.binary()) for x in (places.astype("<i4"), np.minimum(tf, MOST).astype("u1"))]
    return pa.RecordBatch.from_arrays(columns, [*doc, "begins", "terms", "places", "counts", "over", "excess"])


def _packed_bags(df: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Packed terms of the arrays ``__words``."""

    def run(batches):
        for batch in batches:
            words = batch.column("__words")
            row, flat = pc.list_parent_indices(words).to_numpy(), words.flatten()
            kept = pc.fill_null(pc.greater(pc.binary_length(flat), 0), False)
            row, flat = row[kept.to_numpy(zero_copy_only=False)], flat.filter(kept)
            at = 0
            while at < len(row):
                end = int(np.searchsorted(row, row[min(len(row), at + PACKED) - 1], "right"))  # whole texts
                coded = flat.slice(at, end - at).dictionary_encode()
                width = len(coded.dictionary)
                place, tf = np.unique(row[at:end].astype(np.int64) * width + coded.indices.to_numpy(), return_counts=True)
                text, place = np.divmod(place, width)
                starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                own = pa.array(text[starts])
                yield _packed_row(doc, [batch.column(c).take(own) for c in doc], starts, coded.dictionary, place, tf)
                at = end

    return df.mapInArrow(run, _packed_layout(df, doc))


def packed_terms(terms: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Rows ``(doc..., term, tf)`` as they come, many in one row, whose terms are listed once.

    ``(doc arrays..., begins, terms, places, counts, over, excess)``: entry i is the term at ``places[i]``, ``counts[i]`` times, and as often
    again as ``excess`` says if ``over`` lists i. ``begins`` are the edges of the runs of one document; it may have several.
    """
    rows = terms.where("term IS NOT NULL").select(*doc, "term", F.col("tf").cast("bigint").alias("tf"))

    def packed(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        *keys, term, tf = (c.combine_chunks() for c in pa.Table.from_batches(waiting).columns)
        other = np.zeros(len(tf) - 1, bool)
        for key in keys:
            other |= pc.fill_null(pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)), True).to_numpy(zero_copy_only=False)
        starts, coded = np.append(0, np.flatnonzero(other) + 1), term.dictionary_encode()
        return _packed_row(doc, [key.take(pa.array(starts)) for key in keys], starts, coded.dictionary, coded.indices.to_numpy(), tf.to_numpy())

    def run(batches):
        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= PACKED:
                yield packed(waiting)
                waiting, n = [], 0
        if n:
            yield packed(waiting)

    return rows.mapInArrow(run, _packed_layout(rows, doc))


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """For every row of packed terms: the row, its terms, the edges of the runs, and place and count of every entry."""
    for i in range(batch.num_rows):
        begins, over, excess = (batch.column(c)[i].values.to_numpy() for c in ("begins", "over", "excess"))
        places, counts = (np.frombuffer(batch.column(c)[i].as_buffer(), kind).astype(np.int64) for c, kind in (("places", "<i4"), ("counts", "u1")))
        counts[over] += excess
        yield batch.slice(i, 1), batch.column("terms")[i].values, begins, places, counts


def word_rows(df: DataFrame, doc: Sequence[str], items: Column) -> DataFrame:
    """``(doc..., term, tf)`` with one row per word (tf = 1), in the form of an outer bag:
    cheaper than counting inside the row where sums follow anyway."""
    rows = df.select(*doc, F.explode_outer(items).alias("term"))
    return rows.select(*doc, F.nullif("term", F.lit("")).alias("term"), F.lit(1).cast("bigint").alias("tf"))


def vocabulary(terms: DataFrame, size: int | None = None, min_df: int = 1) -> DataFrame:
    """``(term, n, df, term_id)`` ranked by count, then term: one order on any partitioning.

    ``size`` is the vocabulary-size parameter of a bag-of-words model.
    """
    counted = terms.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    if size is not None:
        counted = top_k(counted, size, F.desc("n"), F.asc("term"))
    return with_row_index(counted, [F.desc("n"), F.asc("term")], name="term_id")


def vectorizer(terms: DataFrame, input_col: str, output_col: str, size: int, min_df: int = 1) -> CountVectorizerModel:
    """Bag-of-words transformer with the reproducible vocabulary of :func:`vocabulary`.

    The model object holds its ``size`` terms on the driver, as every such model does.
    """
    top = vocabulary(terms, size, min_df).orderBy("term_id").select("term")
    return CountVectorizerModel.from_vocabulary([r["term"] for r in top.collect()], inputCol=input_col, outputCol=output_col)


def label_index(df: DataFrame, column: str, by_frequency: bool = True) -> DataFrame:
    """``(label, n, index)``: labels numbered by falling count then name, or by name."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("label")] if by_frequency else [F.asc("label")]
    return with_row_index(counted, order, name="index")


def register_word_function(spark: SparkSession, name: str = "split_words") -> None:
    """SQL table function that splits a text into rows, for SQL callers."""
    from pyspark.sql.functions import udtf

    class SplitWords:
        def eval(self, text: str):
            for position, word in enumerate((text or "").split()):
                yield position, word

    spark.udtf.register(name, udtf(SplitWords, returnType="position int, word string"))
