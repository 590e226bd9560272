"""Files as tables: listings, transcripts, sidecar metadata, references; and the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: extensions of media files
VIDEO = ("mp4", "avi", "mov", "mkv", "wmv", "flv", "webm", "m4v")
AUDIO = ("wav", "mp3", "flac", "ogg", "aac", "m4a", "wma")
TRANSCRIPT = "duration double, segments array<struct<start:double,end:double,text:string,speaker:string,confidence:double>>"
CLIP = "original_file string, start double, end double, duration double, text string, speaker string, confidence double"


def list_files(spark: SparkSession, folder: str, extensions: tuple[str, ...], bag: bool = False) -> DataFrame:
    """(path, length, name, stem) below folder by extension in any case, each once; bag=True lists top-level files twice."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    rows = rows.where(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin(*extensions))
    if bag:
        top = rows.where(~F.contains(F.regexp_replace("path", rf"^.*?{folder.rstrip('/').split('/')[-1]}/", ""), F.lit("/")))
        rows = rows.unionAll(top)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return rows.select("path", "length", "modificationTime", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"))


def folder_size(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length") / 1048576, F.lit(0.0)).alias("megabytes"))


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of transcript JSON files: episode, ordinal, start, end, text, speaker, confidence."""
    name = F.regexp_replace(F.url_decode(F.col("_metadata.file_name")), r"\.[^.]*$", "")
    rows = spark.read.schema(TRANSCRIPT).option("multiLine", "true").json(folder).select(name.alias("episode"), "segments")
    return rows.select("episode", F.posexplode("segments").alias("ordinal", "s")).select("episode", "ordinal", "s.*")


def read_clip_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Clip metadata by stem, `x.json` before `x.wav.json`."""
    rows = spark.read.schema(CLIP).option("multiLine", "true").option("recursiveFileLookup", "true").json(folder).select("*", F.url_decode(F.col("_metadata.file_name")).alias("file"))
    rows = rows.withColumn("stem", F.regexp_replace("file", r"(\.wav)?\.json$", "")).withColumn("rank", F.col("file").endswith(".wav.json").cast("int"))
    columns = [c for c in rows.columns if c not in ("stem", "rank", "file")]
    return rows.groupBy("stem").agg(F.min_by(F.struct(*columns), "rank").alias("m")).select("stem", "m.*")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(episode, speaker, cluster_id) of a nested JSON map."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,int>>").alias("m"))
    return rows.select(F.explode("m").alias("episode", "inner")).select("episode", F.explode("inner").alias("speaker", "cluster_id"))


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of few rows as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str, by: str, order: list[str]) -> None:
    """Ordered text lines, a folder for each value of `by`."""
    lines.repartition(by).sortWithinPartitions(by, *order).select(by, "line").write.mode("overwrite").partitionBy(by).text(path)
