"""The shared test tables as the record shapes of the operators.

Each adapter is one projection; ADAPTER_SQL holds its twin for an SQL engine, so that results can be
compared. Times are seconds from the start of an episode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as timed segments: episode, speaker, start, end, duration, text, confidence, ordinal."""
    return segments_of(read(spark, sf_dir, "events"))


def segments_of(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp_ntz")
    start = (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("double")
    return events.select(
        F.date_format(ts, "yyyy-MM-dd").alias("episode"),
        F.concat(F.lit("SPEAKER_"), F.lpad((F.col("user_id") % 20).cast("string"), 2, "0")).alias("speaker"),
        start.alias("start"),
        (start + F.col("value")).alias("end"),
        F.col("value").alias("duration"),
        F.col("event_type").alias("text"),
        (-F.get_json_object("props", "$.k").cast("double") / 100).alias("confidence"),
        F.col("event_id").alias("ordinal"),
    )


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as utterances: episode, speaker, ordinal, text."""
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("episode"), F.col("role").alias("speaker"), F.col("turn").alias("ordinal"), "text")


def voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as voice embeddings: vec_id, speaker, episode, duration, quality, embedding."""
    return read(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("label").cast("string").alias("speaker"),
        (F.col("vec_id") % 20).cast("string").alias("episode"),
        (F.lit(1.0) + F.col("vec_id") % 7).alias("duration"),
        (F.col("vec_id") * 37 % 100 / F.lit(100.0)).alias("quality"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as short sample arrays: clip_id, sample_rate 160, samples."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("clip_id"), F.lit(160).alias("sample_rate"), F.transform("embedding", lambda x: x.cast("double") * 3).alias("samples"))


ADAPTER_SQL = {
    "seg": """seg AS (SELECT strftime(ts, '%Y-%m-%d') AS episode, 'SPEAKER_' || lpad((user_id % 20)::VARCHAR, 2, '0') AS speaker,
        (extract('hour' FROM ts) * 3600 + extract('minute' FROM ts) * 60 + floor(extract('second' FROM ts)))::DOUBLE AS "start",
        (extract('hour' FROM ts) * 3600 + extract('minute' FROM ts) * 60 + floor(extract('second' FROM ts)))::DOUBLE + value AS "end",
        value AS duration, event_type AS text, -(props->>'$.k')::DOUBLE / 100 AS confidence, event_id AS ordinal FROM events)""",
    "utt": "utt AS (SELECT conv_id::VARCHAR AS episode, role AS speaker, turn AS ordinal, text FROM conversations)",
    "vox": "vox AS (SELECT vec_id, label::VARCHAR AS speaker, (vec_id % 20)::VARCHAR AS episode, 1.0::DOUBLE + vec_id % 7 AS duration, vec_id * 37 % 100 / 100.0::DOUBLE AS quality, embedding::DOUBLE[] AS embedding FROM embeddings)",
    "clip": "clip AS (SELECT vec_id AS clip_id, 160 AS sample_rate, list_transform(embedding, lambda x: x::DOUBLE * 3) AS samples FROM embeddings)",
}
