"""Structured Streaming forms: windowed counts, turns as sessions, repeated texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, length: str = "10 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Rows and seconds of each speaker and window; tumbling without a slide."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(w.alias("w"), "speaker").agg(F.count("*").alias("n"), F.sum("duration").alias("seconds")).select(F.col("w.start").alias("window_start"), "speaker", "n", "seconds")


def turns(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Turns: rows of a speaker no further apart than the gap."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.session_window("ts", gap).alias("w"), "speaker").agg(F.count("*").alias("n")).select(F.col("w.start").alias("turn_start"), F.col("w.end").alias("turn_end"), "speaker", "n")


def distinct_texts(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """First of equal (speaker, text) rows within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["speaker", "text"])
