"""Transcripts rebuilt for a cluster, speaker to character mapping, reference lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as T


def map_characters(segments: DataFrame, manual: DataFrame, aliases: DataFrame) -> DataFrame:
    """Segments with `character`: a manual mapping, else an alias in any case, else the speaker. Of several mappings of one speaker the least counts."""
    alias = aliases.select(F.lower("alias").alias("key"), F.col("character").alias("by_alias")).groupBy("key").agg(F.min("by_alias").alias("by_alias"))
    hand = _one_each(manual.select("speaker", F.col("character").alias("by_hand")), "speaker", "by_hand")
    return segments.join(hand, "speaker", "left").join(alias, F.lower("speaker") == F.col("key"), "left").withColumn("character", F.coalesce("by_hand", "by_alias", "speaker")).drop("key", "by_hand", "by_alias")


def cluster_lines(utterances: DataFrame, mapping: DataFrame) -> DataFrame:
    """(episode, ordinal, cluster_id, line) of all spoken lines of mapped speakers; episodes lose a `_SPEAKER` mark."""
    m = mapping.select(F.replace("episode", F.lit("_SPEAKER"), F.lit("")).alias("episode"), "speaker", "cluster_id")
    said = utterances.where(T.strip(F.col("text")) != "").join(m, ["episode", "speaker"])
    return said.select("episode", "ordinal", "cluster_id", F.format_string('[%s] %s: "%s"', T.stamp(F.col("ordinal") * 1.0), "speaker", T.strip(F.col("text"))).alias("line"))


def segmentation_summary(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """Per character: segments, episodes, hours and the share of the hours aimed at (0 without an aim)."""
    by_episode = segments.groupBy("episode", "character").agg(F.count("*").alias("n"), F.sum("duration").alias("seconds"))
    total = by_episode.groupBy("character").agg(F.sum("n").alias("segments"), F.count("*").alias("episodes"), (F.sum("seconds") / 3600).alias("hours"))
    return total.join(targets, "character", "left").select("character", "segments", "episodes", "hours", F.when(F.col("target_hours") > 0, F.col("hours") / F.col("target_hours") * 100).otherwise(0.0).alias("completion"))


def parse_references(lines: DataFrame) -> DataFrame:
    """(label, path, ordinal) of `label:path` lines; blank lines, comments and lines without a colon are left out."""
    kept = lines.where((T.strip(F.col("value")) != "") & ~T.strip(F.col("value")).startswith("#") & F.contains("value", F.lit(":")))
    parts = F.split("value", ":", 2)
    return kept.select(T.strip(parts[0]).alias("label"), F.replace(T.strip(parts[1]), F.lit("\\"), F.lit("/")).alias("path"), F.monotonically_increasing_id().alias("ordinal"))


def unique_names(names: DataFrame, column: str, order: str) -> DataFrame:
    """names with `clean` and `unique_name`: in order, each takes its clean form or that with the first free `_n`.

    Only names that differ by such endings can be in each other's way. Where all names of such a group are equal, the
    place among them is the number; the few mixed groups are gone through in order, by row key and name alone.
    """
    clean = names.withColumn("clean", T.clean_filename(F.col(column)))
    root = F.regexp_replace("clean", r"(_[0-9]+)+$", "")
    mixed = clean.groupBy(root.alias("root")).agg(F.min("clean").alias("low"), F.max("clean").alias("high")).where("low <> high").select("root")
    rooted = clean.withColumn("root", root)
    alone = rooted.join(mixed, "root", "left_anti")
    n = F.row_number().over(Window.partitionBy("clean").orderBy(order)) - 1
    plain = alone.withColumn("unique_name", F.when(n > 0, F.concat_ws("_", "clean", n.cast("string"))).otherwise(F.col("clean"))).drop("root")

    def first_free(group):
        group = group.sort_values(order, kind="stable")
        taken, at, out = set(), {}, []
        for name in group["clean"]:
            free, k = name, at.get(name, 0)
            while free in taken:
                k += 1
                free = f"{name}_{k}"
            at[name] = k
            taken.add(free)
            out.append(free)
        return group.assign(unique_name=out)[[order, "unique_name"]]

    keyed = rooted.join(mixed, "root", "left_semi").select("root", order, "clean")
    named = keyed.groupBy("root").applyInPandas(first_free, f"`{order}` {names.schema[order].dataType.simpleString()}, unique_name string")
    rest = clean.join(named, order)
    return plain.unionByName(rest)


def _one_each(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(value).alias(value))
