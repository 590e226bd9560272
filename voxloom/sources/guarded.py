"""Scans that give a row for every file, whatever is in it: a result or an error, never a failed run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.sources.files import TRANSCRIPT

# error codes
EMPTY, BROKEN, SHAPELESS = "empty", "broken", "wrong_shape"


def scan_json(spark: SparkSession, folder: str, schema: str, needed: tuple[str, ...], pattern: str = "*.json") -> DataFrame:
    """(path, stem, size, value, error, detail): one JSON document a file, as `value` of the schema where error is null.

    `empty`: nothing but blanks; `broken`: no JSON, or a value of another type than the schema's; `wrong_shape`: one of
    the `needed` fields is missing or null. detail holds the beginning of a broken text.
    The names come from Spark's own index of the folder, as readers of content skip empty files.
    """
    texts = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder, wholetext=True)
    # both name a file alike but for the slashes after the scheme
    place = lambda c: F.regexp_replace(c, r"^([^:/]+):/+", "$1:/").alias("path")
    listed = spark.createDataFrame([(p,) for p in texts.inputFiles()], "path string").select(place("path"))
    rows = listed.join(texts.select(place("_metadata.file_path"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("text")), "path", "left")
    parsed = F.from_json(F.col("text"), f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"})
    rows = rows.withColumn("parsed", parsed)
    lacks = [F.col(f"parsed.{n}").isNull() for n in needed]
    error = F.when(F.trim(F.coalesce("text", F.lit(""))).rlike(r"^\s*$"), EMPTY).when(F.col("parsed").isNull() | F.col("parsed._broken").isNotNull(), BROKEN)
    for lack in lacks:
        error = error.when(lack, SHAPELESS)
    rows = rows.withColumn("error", error)
    # a plus sign stands for itself in a path
    name = F.url_decode(F.replace(F.regexp_extract("path", r"([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    detail = F.when(F.col("error") == BROKEN, F.substring("text", 1, 80))
    return rows.select("path", stem.alias("stem"), F.coalesce("size", F.lit(0)).alias("size"), F.when(F.col("error").isNull(), F.col("parsed").dropFields("_broken")).alias("value"), "error", detail.alias("detail"))


def scan_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """scan_json of transcript files; `value` has duration and segments."""
    return scan_json(spark, folder, TRANSCRIPT, ("segments",))


def segments_of(scanned: DataFrame) -> DataFrame:
    """Segments of the intact files of scan_transcripts: episode, ordinal, start, end, text, speaker, confidence."""
    rows = scanned.where("error is null").select(F.col("stem").alias("episode"), F.posexplode("value.segments").alias("ordinal", "s"))
    return rows.select("episode", "ordinal", "s.*")


def totals(scanned: DataFrame, error: str = "error") -> DataFrame:
    """(outcome, n): `ok` and every error code with its number of files."""
    outcome: Column = F.coalesce(F.col(error), F.lit("ok"))
    return scanned.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
