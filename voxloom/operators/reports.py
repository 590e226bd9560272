"""Roll-ups over clips, files, runs and metric histories. Every report of one group or of all rows is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.ordering import numbered


def _zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def speaker_detail(clips: DataFrame) -> DataFrame:
    """Per speaker: ranges of duration and SNR and mean words over accepted clips (0 without any), and `code:count` of the reasons."""
    ok = F.col("reason").isNull()
    over = lambda f, c: _zero(f(F.when(ok, F.col(c).cast("double"))))
    ranges = clips.groupBy("speaker").agg(over(F.min, "duration").alias("min_duration"), over(F.max, "duration").alias("max_duration"), over(F.min, "snr").alias("min_snr"), over(F.max, "snr").alias("max_snr"), over(F.avg, "word_count").alias("mean_words"))
    counted = clips.where(~ok).groupBy("speaker", "reason").agg(F.count("*").alias("n"))
    histogram = counted.groupBy("speaker").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "reason", F.col("n").cast("string")))), ",").alias("reasons"))
    return ranges.join(histogram, "speaker", "left").withColumn("reasons", F.coalesce("reasons", F.lit("")))


# fixed values: shares beyond which a class of reasons is worth a message, and the bounds of mean acceptance
REASON_LIMITS = {"too_short": 0.3, "low_snr": 0.2, "incomplete_words": 0.2}
FEW, MANY = 0.3, 0.9


def advice(clips: DataFrame) -> DataFrame:
    """One row: rejected clips, mean acceptance over speakers, and the comma-joined codes of what stands out."""
    ok = F.col("reason").isNull()
    named = [F.count_if(F.col("reason") == r).alias(f"__{r}") for r in REASON_LIMITS]
    by = clips.groupBy("speaker").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok"), *named)
    total = by.agg(F.coalesce(F.sum(F.col("n") - F.col("n_ok")), F.lit(0)).alias("n_rejected"), F.avg(F.col("n_ok") / F.col("n")).alias("acceptance"), *[F.sum(f"__{r}").alias(f"__{r}") for r in REASON_LIMITS])
    codes = [F.when(F.try_divide(F.col(f"__{r}"), F.col("n_rejected")) > least, f"many_{r}") for r, least in REASON_LIMITS.items()]
    codes += [F.when(F.col("acceptance") < FEW, "few_accepted").when(F.col("acceptance") > MANY, "nearly_all_accepted")]
    return total.select("n_rejected", _zero(F.col("acceptance")).alias("acceptance"), F.array_join(F.filter(F.array(*codes), lambda x: x.isNotNull()), ",").alias("advice"))


def validation_summary(files: DataFrame) -> DataFrame:
    """One row over (passed, score) of files: counts and mean score, 0 without files."""
    return files.agg(F.count("*").alias("n_files"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"), _zero(F.avg("score")).alias("mean_score"))


def transcript_totals(segments: DataFrame) -> DataFrame:
    """One row: segments, unique speakers, episodes over all files."""
    return segments.agg(F.count("*").alias("segments"), F.count_distinct("speaker").alias("speakers"), F.count_distinct("episode").alias("episodes"))


def media_stats(files: DataFrame) -> DataFrame:
    """One row over (duration in seconds, file_size in bytes): minutes, MiB and mean minutes, 0 without files."""
    return files.agg(F.count("*").alias("n_files"), _zero(F.sum("duration") / 60).alias("minutes"), _zero(F.sum("file_size") / 1048576).alias("megabytes"), _zero(F.avg("duration") / 60).alias("mean_minutes"))


def flag_counts(rows: DataFrame, flags: list[str]) -> DataFrame:
    """One row: how many rows there are and how many have each flag set; a null flag is not set."""
    return rows.agg(F.count("*").alias("n"), *[F.count_if(f).alias(f"n_{f}") for f in flags])


def lines_per_episode(lines: DataFrame) -> DataFrame:
    return lines.groupBy("episode").agg(F.count("*").alias("lines"))


def references_of(refs: DataFrame) -> DataFrame:
    """(label, n, paths): each label's paths in file order."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "path")))
    return refs.groupBy("label").agg(F.count("*").alias("n"), F.transform(ordered, lambda r: r["path"]).alias("paths"))


def latency(rows: DataFrame, seconds: str) -> DataFrame:
    """One row: runs, seconds in all and on average (0 without runs)."""
    return rows.agg(F.count(seconds).alias("runs"), _zero(F.sum(seconds)).alias("total_seconds"), _zero(F.avg(seconds)).alias("mean_seconds"))


def best_metrics(history: DataFrame) -> DataFrame:
    """(name, lowest, lowest_at, highest, highest_at, last) of (name, step, value) rows; of equal values the first step."""
    present = history.where("value is not null and not isnan(value)")
    return present.groupBy("name").agg(
        F.min("value").alias("lowest"),
        F.min_by("step", F.struct("value", "step")).alias("lowest_at"),
        F.max("value").alias("highest"),
        F.min_by("step", F.struct(-F.col("value"), F.col("step"))).alias("highest_at"),
        F.max_by("value", "step").alias("last"),
    )


def run_metrics(log: DataFrame) -> DataFrame:
    """(stage, metrics): a map of each stage's (name, value) rows, the latest step of a name wins."""
    last = log.groupBy("stage", "name").agg(F.max_by("value", "step").alias("value"))
    return last.groupBy("stage").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("metrics"))


def by_duration(stats: DataFrame, cluster: str) -> DataFrame:
    """stats with `place`, clusters of most seconds first, ties by name. The table has a row a cluster."""
    return numbered(stats, [F.desc("total_duration"), F.col(cluster)], "place").withColumn("place", F.col("place").cast("int"))
