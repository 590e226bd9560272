"""Every pipeline stage beside columns with the names it might use itself, and on empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxloom.llm.names import free_name

DATA = "/root/testdata/sf0.001"
NAMES = ["__quality", "quality_score", "__set", "__of", "__n", "__text", "__TEXT_1", "__th", "__gone", "__id", "sid", "component", "row", "copies", "n_tokens", "bucket"]


def test_free_name():
    assert free_name("a", ["b"]) == "a" and free_name("a", ["A", "a_1"]) == "a_2"


@pytest.mark.parametrize("k", range(5))
def test_further_columns_change_nothing(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    more = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in NAMES})
    plain, wide = stage(spark, docs, DATA), stage(spark, more, DATA)
    if k == 4:
        assert sorted((r["doc_id"], r["n_tokens"], r["bucket"]) for r in plain.collect()) == sorted((r["doc_id"], r["n_tokens"], r["bucket"]) for r in wide.collect())
        return
    assert plain.columns == docs.columns and wide.columns == more.columns
    want, got = sorted(map(tuple, plain.collect())), sorted(wide.collect(), key=lambda r: r["doc_id"])
    assert [tuple(r[c] for c in docs.columns) for r in got] == want and 0 < len(want) <= docs.count()
    assert all(r[n] == f"{n} {r['doc_id']}" for r in got for n in NAMES)


@pytest.mark.parametrize("k", range(5))
def test_empty_table(spark, k):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 0")
    assert corpus_pipeline.STAGES[k][1](spark, docs, DATA).count() == 0
