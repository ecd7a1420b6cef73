"""The pipeline's stages on the smallest tables, each against a plain reading of its rule."""

import corpus_pipeline
from sparkmine.llm import decontam, pii

from tests.llm.test_near_copies import _components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        rows = result.collect()
        ids = [r.doc_id for r in rows]
        if name == "near_copies":
            heads = {c for _, _, c in _components([(r.doc_id, r.text) for r in before.values()], 5, 80, 100)}
            assert sorted(ids) == sorted(heads)
        elif name == "quality_rules":
            assert set(ids) <= set(before) and all(len((r.text or "").split()) >= 10 for r in rows)
        elif name == "decontamination":
            found = decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
            assert sorted(ids) == sorted(set(before) - {r.doc_id for r in found}) and found
        elif name == "personal_data":
            assert sorted(ids) == sorted(before) and not any(v for r in rows for v in pii.base_spans(r.text).values())
        else:
            assert set(ids) <= set(before) and result.columns == [*columns, "copy", "position"]
            break
        assert result.columns == columns
        docs = spark.createDataFrame(rows, docs.schema)
        before = {r.doc_id: r for r in rows}


def test_stages_with_columns_of_every_internal_name(spark):
    """A table whose columns bear the names that the stages use inside; all come out as they went in."""
    names = "row doc key node root gone found level host bad order_id number nth before size target tilt rows positions words spans batch __m __host __kept __gone __found __key".split()
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    wide = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, wide, SF)
        assert result.columns[: len(wide.columns)] == wide.columns
        rows = result.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
