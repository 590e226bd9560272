"""Corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.

Edge cases: null and empty texts have no features, lines, shingles or tokens: the classifier gives them its
intercept's score, the other stages keep them, packing gives them no tokens. Rows that repeat an id with another text
are documents of their own; of rows equal in id and text line dedup keeps one. Ties go to the smaller id, a null id
comes last. An empty table passes through as an empty table; further columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import decontaminate, line_dedup, ngram_join, packing, quality
from voxloom.llm.names import free_name
from voxloom.llm.workspace import Workspace


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects (score below quality.THRESHOLD) go."""
    model = quality.fit(quality.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    score = free_name("quality_score", docs.columns)
    scored = quality.score_documents(docs, model, name=score)
    return scored.where(F.col(score) >= quality.THRESHOLD).drop(score)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of alike lines the first stays; documents left without a line go."""
    return line_dedup.dedup_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of linked documents the one with the least id stays."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, bucket, batch_id, slot) of every document left."""
    return packing.assign_batches(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# trained, hashed and dynamic-programming stages: SQL cannot express them; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Workspace(spark, "pipeline") as ws:
        for k, (name, stage) in enumerate(STAGES):
            out = stage(spark, docs, sf_dir)
            docs = ws.keep(out, name) if k + 1 == len(STAGES) else ws.table(out, name)
        return docs
