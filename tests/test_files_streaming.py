import gzip
import uuid

from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.operators import bayes as B
from sparkmine.operators import text as T
from sparkmine.session import checkpoint_root
from sparkmine.sources import files, schemas, tables
from sparkmine.streaming import scoring, words


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_inference_and_explicit_schema(spark, tmp_path):
    path = write(tmp_path / "u.csv", "userId,foreName,surName,email\n1,Ada,North,a@x.com\n2,Ben,Ostrow,b@x.com\n")
    inferred, declared = files.read_csv(spark, path), files.read_csv(spark, path, schemas.USERS)
    assert inferred.schema == declared.schema and declared.collect() == inferred.collect()
    assert all(f.nullable for f in declared.schema)


def test_csv_separators_quotes_and_line_breaks(spark, tmp_path):
    exam = write(tmp_path / "e.csv", "ImieNazwisko;OcenaC;DataC;OcenaCpp;Egzamin\nA B;3.5;2016-01-14;4;3\nC D;4;2016-01-20;3;\n")
    rows = files.read_csv(spark, exam, schemas.EXAM, sep=";").withColumn("passed", F.expr("if(Egzamin >= 3.0, 1, 0)")).collect()
    assert [(r["OcenaC"], r["passed"], str(r["DataC"])) for r in rows] == [(3.5, 1, "2016-01-14"), (4.0, 0, "2016-01-20")]
    books = write(tmp_path / "b.csv", "author,work,content,content_stemmed\nAn,W,'one, two','x'\n")
    assert files.read_csv(spark, books, schemas.BOOKS, quote="'").first()["content"] == "one, two"
    tweets = write(tmp_path / "t.csv", 'Entity,Sentiment,TweetContent\nNvidia,Positive,"two\nlines ""quoted"""\n')
    assert files.read_csv(spark, tweets, schemas.TWEETS, multi_line=True).first()["TweetContent"] == 'two\nlines "quoted"'


def test_gzip_is_redistributed_and_files_stay_apart(spark, tmp_path):
    for name, n in (("one", 3), ("two", 5)):
        with gzip.open(tmp_path / f"{name}.csv.gz", "wt") as f:
            f.write("X,Y\n" + "".join(f"{i},{2 * i}\n" for i in range(n)))
    paths = [str(tmp_path / f"{n}.csv.gz") for n in ("one", "two")]
    df = files.read_csv(spark, paths, schemas.XY, partitions=6, file_column="file")
    assert df.rdd.getNumPartitions() == 6
    assert {r["file"]: r["count"] for r in df.groupBy("file").count().collect()} == {"one.csv.gz": 3, "two.csv.gz": 5}


def test_csv_and_parquet_sinks_overwrite(spark, tmp_path):
    df = spark.range(10).withColumn("name", F.concat(F.lit("n;"), "id")).repartition(4)
    out = tmp_path / "out"
    for n in (5, 1):
        files.write_csv(df, str(out), sep=";", files=n)
        assert len(list(out.glob("part-*.csv"))) == n
    assert files.read_csv(spark, str(out), sep=";").count() == 10
    files.write_parquet(df, str(tmp_path / "p"))
    files.write_parquet(df.limit(3), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_local_rows_and_iteration(spark):
    names = ["Ada North", "Ben Ostrow", "Cleo Park", "Dan Quill", "Eve Rowan"]
    df = files.from_strings(spark, names)
    assert df.columns == ["value"] and [r["value"] for r in files.iter_rows(df)] == names
    assert [len(b) for b in files.iter_batches(df, 2)] == [2, 2, 1]
    assert list(files.column_values(df, "value")) == names
    assert files.from_rows(spark, [(1.0, 2.0)], schemas.XY).first()["Y"] == 2.0


def test_batches_are_mapped_on_executors(spark):
    sizes = files.map_batches(spark.range(0, 25, 1, 2), lambda pdf: pdf.agg({"id": ["count"]}).rename(columns={"id": "n"}), "n long", 10)
    assert sum(r["n"] for r in sizes.collect()) == 25 and all(r["n"] <= 10 for r in sizes.collect())


def test_pages_and_views(spark, tmp_path):
    write(tmp_path / "a.html", "<p>one\ntwo</p>")
    page = files.read_pages(spark, str(tmp_path / "*.html")).first()
    assert page["html"] == "<p>one\ntwo</p>" and page["url"].endswith("a.html")
    tables.register_views(spark, "/root/testdata/sf0.001", ["region"])
    assert spark.sql("SELECT count(*) AS n FROM region").first()["n"] == 5


def folders(spark):
    base = f"{checkpoint_root(spark)}/test-streams/{uuid.uuid4()}"
    return f"{base}/output", f"{base}/progress"


def test_streamed_counts_equal_batch_counts(spark, tmp_path):
    source = str(tmp_path / "texts")
    texts = [("a b a",), ("b c",), ("a  d",), ("",), ("c c c",)]
    for t in texts:
        spark.createDataFrame([t], "text string").coalesce(1).write.mode("append").parquet(source)
    batch = spark.read.parquet(source)
    output, progress = folders(spark)

    def run():
        stream = words.read_files(spark, source, batch)
        query = words.count_words(stream, X.words("text"), output, progress)
        query.awaitTermination()
        return query

    first = run()
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == len(texts)  # one file per batch
    expected = {r["word"]: r["n"] for r in T.word_counts(batch, X.words("text")).collect()}
    assert {r["word"]: r["n"] for r in words.current_counts(spark, output).collect()} == expected
    assert [tuple(r) for r in words.top_words(spark, output, 2).collect()] == [("c", 4), ("a", 3)]

    spark.createDataFrame([("d e",)], "text string").coalesce(1).write.mode("append").parquet(source)
    run()  # a later run goes on from its checkpoint
    expected = {r["word"]: r["n"] for r in T.word_counts(spark.read.parquet(source), X.words("text")).collect()}
    assert {r["word"]: r["n"] for r in words.current_counts(spark, output).collect()} == expected


def test_streamed_scores_equal_batch_scores(spark, tmp_path):
    train = spark.createDataFrame(
        [("E", "pos", "good nice"), ("E", "neg", "bad awful"), ("F", "pos", "bad but nice"), ("F", "neg", "good grief")],
        "entity string, class string, text string",
    )
    model = B.entity_models(T.doc_terms(train, ["class", "entity"], X.tokens("text"), outer=True), train, "entity", 1.0)

    def classify(rows):
        resolved = B.resolve_entity(rows, model, "entity")
        return B.predict(T.doc_terms(resolved, ["id", "entity"], X.tokens("text"), outer=True), model, ["id", "entity"])

    requests = spark.createDataFrame([(1, "E", "good"), (2, "f", "nice"), (3, "new", "awful")], "id long, entity string, text string")
    source = str(tmp_path / "requests")
    requests.repartition(3).write.parquet(source)
    output, progress = folders(spark)
    stream = words.read_files(spark, source, requests)
    scoring.score_requests(stream, classify, output, progress).awaitTermination()
    streamed = scoring.scored_requests(spark, output, "id long, entity string, predicted string, score double")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, classify(requests).collect()))
    assert {r["id"]: r["entity"] for r in streamed.collect()} == {1: "e", 2: "f", 3: "*"}


def test_table_streams_from_one_file_and_from_a_folder_of_files(spark, tmp_path):
    texts = spark.createDataFrame([("a b a",), ("b c",), ("a d",), (None,)], "text string")
    texts.repartition(3).write.parquet(str(tmp_path / "folder.parquet"))
    texts.coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "file.parquet")
    for name, size, least in (("folder", 1, 3), ("folder", 1 << 20, 1), ("file", 1, 1)):
        output, progress = folders(spark)
        stream = words.read_table(spark, str(tmp_path / f"{name}.parquet"), texts, size)
        query = words.count_words(stream, X.words("text"), output, progress)
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == least
        assert {r["word"]: r["n"] for r in words.current_counts(spark, output).collect()} == {"a": 3, "b": 2, "c": 1, "d": 1}


def test_stream_queries_read_tables_of_many_files(spark, tmp_path):
    from sparkmine.plans.bayes import nb_entity_predict
    from sparkmine.plans.streams import stream_score, stream_word_count
    from sparkmine.plans.text import page_word_count

    for name in ("pages", "documents"):
        tables.table(spark, "/root/testdata/sf0.001", name).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for streamed, batch in ((stream_word_count, page_word_count), (stream_score, nb_entity_predict)):
        assert sorted(map(tuple, streamed(spark, str(tmp_path)).collect())) == sorted(map(tuple, batch(spark, str(tmp_path)).collect()))
