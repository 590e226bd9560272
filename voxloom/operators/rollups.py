"""Roll-ups of timed segments by speaker, episode and label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def speaker_analysis(segments: DataFrame, samples: int = 5) -> DataFrame:
    """Segments, seconds, first texts and episodes of each speaker, longest first.

    First texts are those of the least (episode, ordinal): a ranking bounds what is gathered per speaker.
    """
    totals = segments.groupBy("speaker").agg(F.count("*").alias("total_segments"), F.sum(F.col("end") - F.col("start")).alias("total_duration"), F.count_distinct("episode").alias("episodes"))
    order = Window.partitionBy("speaker").orderBy("episode", "ordinal")
    first = segments.select("speaker", "episode", "ordinal", "text").withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= samples)
    texts = first.groupBy("speaker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "text"))), lambda x: x["text"]), "|").alias("sample_texts"))
    return totals.join(texts, "speaker").orderBy(F.desc("total_duration"), "speaker")
