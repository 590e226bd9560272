"""Transcript and cluster documents as ordered lines: no cluster's lines are ever gathered into one value or task.

A document's rows carry the key they are ordered by: (cluster_id, block, position, episode, kind, ordinal, k). Writing
range-partitions by it, so a long document is several files whose names are in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions.numbers import fixed
from voxloom.scratch import children, hadoop_path

KEY = ["cluster_id", "block", "position", "episode", "kind", "ordinal", "k"]
HEAD, BODY, SUMMARY = 0, 1, 2
# fixed values: rules and wordings of the documents
RULE = "=" * 60
UNNAMED = "unassigned"
NONE = "No dialogue found for this cluster."


def _rows(df: DataFrame, block: int, kind: int, lines: list[Column] | Column, position: str | None = None, episode: str | None = None, ordinal: str | None = None) -> DataFrame:
    """Rows of the key and a line; several lines of one row are numbered by k."""
    array = F.array(*lines) if isinstance(lines, list) else lines
    key = [
        F.col("cluster_id"),
        F.lit(block).alias("block"),
        (F.col(position) if position else F.lit(0)).cast("long").alias("position"),
        (F.col(episode) if episode else F.lit("")).alias("episode"),
        F.lit(kind).alias("kind"),
        (F.col(ordinal) if ordinal else F.lit(0)).cast("double").alias("ordinal"),
    ]
    return df.select(*key, F.posexplode(array).alias("k", "line")).where("line is not null")


def _say(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def transcript_lines(clusters: DataFrame, said: DataFrame) -> DataFrame:
    """(key, line) of the full transcript of every cluster.

    clusters: cluster_id, label, total_duration (seconds), speakers (array), n_episodes; said: cluster_id, episode, position
    (the episode's place), time (seconds), speaker, text. Blank texts are left out; of equal times the lesser (speaker, text)
    comes first. A cluster that says nothing has a note in place of its body.
    """
    spoken = said.withColumn("text", T.strip(F.col("text"))).where("text <> ''")
    counts = spoken.groupBy("cluster_id", "position", "episode").agg(F.count("*").alias("n"))
    totals = counts.groupBy("cluster_id").agg(F.sum("n").alias("total"))
    head = [
        _say("FULL TRANSCRIPT - Cluster ", F.col("cluster_id")),
        _say("Character: ", F.coalesce("label", F.lit(UNNAMED))),
        _say("Total Duration: ", fixed(F.col("total_duration") / 60, 1), " minutes"),
        _say("Original Speakers: ", F.array_join(F.array_sort("speakers"), ", ")),
        _say("Episodes: ", F.col("n_episodes")),
        F.lit(RULE),
        F.lit(""),
    ]
    every = clusters.join(totals, "cluster_id", "left")
    parts = [
        _rows(clusters, HEAD, 0, head),
        _rows(every.where("total is null"), BODY, 0, [F.lit(NONE)]),
        _rows(counts, BODY, 0, [F.lit(""), _say("--- ", F.col("episode"), " ---"), F.lit("")], "position", "episode"),
        _rows(spoken, BODY, 1, [_say("[", T.stamp(F.col("time")), "] ", F.col("speaker"), ': "', F.col("text"), '"')], "position", "episode", "time"),
        _rows(totals, SUMMARY, 0, [F.lit(""), F.lit(RULE), F.lit("SUMMARY:"), _say("Total lines: ", F.col("total")), F.lit("Lines by episode:")]),
        # by name, whatever the order of the body
        _rows(counts.groupBy("cluster_id", "episode").agg(F.sum("n").alias("n")), SUMMARY, 1, [_say("  ", F.col("episode"), ": ", F.col("n"), " lines")], None, "episode"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def info_lines(clusters: DataFrame, first: DataFrame, most: int = 5) -> DataFrame:
    """(key, line) of every cluster's summary. clusters as above with segments and quality; first: (cluster_id, episode, position) of its episodes."""
    head = [
        _say("Cluster ID: ", F.col("cluster_id")),
        _say("Character: ", F.coalesce("label", F.lit(UNNAMED))),
        _say("Duration: ", fixed(F.col("total_duration") / 60, 1), " minutes"),
        _say("Episodes: ", F.col("n_episodes")),
        _say("Segments: ", F.col("segments")),
        _say("Quality Score: ", F.coalesce(F.col("quality").cast("string"), F.lit("N/A"))),
        _say("Original Speakers: ", F.array_join(F.array_sort("speakers"), ", ")),
        F.lit(""),
        F.lit("First few episodes:"),
    ]
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy("position", "episode"))).where(F.col("rank") <= most)
    return _rows(clusters, HEAD, 0, head).unionByName(_rows(ranked, BODY, 0, [_say("  - ", F.col("episode"))], "rank", "episode"))


def sections(lines: DataFrame) -> DataFrame:
    """(cluster_id, block, position, episode, text): a document's lines joined within an episode, the unit that stays in bounds."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", F.col("episode"), "ordinal", "k", "line"))), lambda x: x["line"]), "\n")
    unit = F.when(F.col("block") == BODY, F.col("episode")).otherwise(F.lit(""))
    return lines.groupBy("cluster_id", "block", "position", unit.alias("episode")).agg(text.alias("text"))


def write_documents(lines: DataFrame, path: str, parts: int | None = None) -> None:
    """A folder for each cluster, its lines in order over one or more files."""
    order = [*KEY, "line"]
    ranged = lines.repartitionByRange(parts, *order) if parts else lines.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).select("cluster_id", "line").write.mode("overwrite").partitionBy("cluster_id").text(path)


def document_files(spark: SparkSession, path: str, cluster_id: int) -> list[str]:
    """The files of one document, in the order they are read in."""
    folder = f"{path.rstrip('/')}/cluster_id={cluster_id}"
    return [f"{folder}/{n}" for n in children(spark, folder) if not n.startswith(("_", "."))]


def read_document(spark: SparkSession, path: str, cluster_id: int) -> bytes:
    """One document's bytes, for a look at a short one."""
    out = b""
    for name in document_files(spark, path, cluster_id):
        fs, target = hadoop_path(spark, name)
        stream = fs.open(target)
        try:
            out += bytes(stream.readAllBytes())
        finally:
            stream.close()
    return out
