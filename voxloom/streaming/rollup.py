"""Speaker totals kept up to date as files arrive.

Every batch of the stream leaves one table of partial results, by (speaker, episode): rows, seconds and the first texts. Partial
results merge in any grouping, so the totals are the merge of all tables. Each `every` batches one table of all before
takes their place for readers. Tables are named by batch, and one that is complete (_SUCCESS) is never written again: a batch
that Spark replays after a failure changes nothing.

Layout of the folder: parts/<batch>, merged/<last batch in it>.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxloom.scratch import children, delete, exists

EVERY = 16
PARTIAL = "speaker string, episode string, n long, seconds double, first array<struct<ordinal:bigint,text:string>>"


def partial(segments: DataFrame, samples: int = 5) -> DataFrame:
    """(speaker, episode, n, seconds, first): a ranking bounds what is gathered for each pair."""
    pair = ["speaker", "episode"]
    totals = segments.groupBy(*pair).agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("seconds"))
    place = F.row_number().over(Window.partitionBy(*pair).orderBy("ordinal"))
    first = segments.select(*pair, F.col("ordinal").cast("long").alias("ordinal"), "text").withColumn("place", place).where(F.col("place") <= samples)
    texts = first.groupBy(*pair).agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("first"))
    # a join on equal keys would lose a null speaker
    named = totals.alias("a").join(texts.alias("b"), F.col("a.speaker").eqNullSafe(F.col("b.speaker")) & F.col("a.episode").eqNullSafe(F.col("b.episode")))
    return named.select("a.speaker", "a.episode", "n", "seconds", "first")


def merged(partials: DataFrame, samples: int = 5) -> DataFrame:
    """Partial results of equal (speaker, episode) made one; at most `samples` texts come from each."""
    first = F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, samples)
    return partials.groupBy("speaker", "episode").agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds"), first.alias("first"))


def speaker_totals(partials: DataFrame, samples: int = 5) -> DataFrame:
    """(speaker, total_segments, total_duration, episodes, sample_texts): what `rollups.speaker_analysis` gives over all segments."""
    pairs = merged(partials, samples)
    totals = pairs.groupBy("speaker").agg(F.sum("n").alias("total_segments"), F.sum("seconds").alias("total_duration"), F.count("episode").alias("episodes"))
    rows = pairs.select("speaker", "episode", F.explode("first").alias("f"))
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("speaker").orderBy("episode", "f.ordinal"))).where(F.col("place") <= samples)
    texts = ranked.groupBy("speaker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "f.text"))), lambda x: x["text"]), "|").alias("sample_texts"))
    return totals.join(texts, "speaker").orderBy(F.desc("total_duration"), "speaker")


def _name(batch: int) -> str:
    return f"{batch:012d}"


def _complete(spark: SparkSession, folder: str) -> list[int]:
    return [int(n) for n in children(spark, folder) if exists(spark, f"{folder}/{n}/_SUCCESS")]


def current_partials(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """The last merged table and all partial ones after it; upto: as they stood after that batch."""
    inside = lambda batches, most: [b for b in batches if most is None or b <= most]
    # a merged table of the batch itself may be in the making
    whole = max(inside(_complete(spark, f"{folder}/merged"), None if upto is None else upto - 1), default=-1)
    parts = [b for b in inside(_complete(spark, f"{folder}/parts"), upto) if b > whole]
    paths = [f"{folder}/merged/{_name(whole)}"] * (whole >= 0) + [f"{folder}/parts/{_name(b)}" for b in parts]
    return spark.read.schema(PARTIAL).parquet(*paths) if paths else spark.createDataFrame([], PARTIAL)


def keep_batch(segments: DataFrame, batch: int, folder: str, samples: int = 5, every: int = EVERY) -> None:
    """Store one batch; nothing happens if it is there already."""
    spark = segments.sparkSession
    part = f"{folder}/parts/{_name(batch)}"
    if not exists(spark, f"{part}/_SUCCESS"):
        partial(segments, samples).write.mode("overwrite").parquet(part)
    whole = f"{folder}/merged/{_name(batch)}"
    if (batch + 1) % every == 0 and not exists(spark, f"{whole}/_SUCCESS"):
        merged(current_partials(spark, folder, batch), samples).write.mode("overwrite").parquet(whole)


def follow(segments: DataFrame, folder: str, samples: int = 5, every: int = EVERY, **trigger) -> StreamingQuery:
    """Start keeping the totals of a stream of segments in folder; trigger: as of DataStreamWriter.trigger."""
    writer = segments.writeStream.foreachBatch(lambda rows, batch: keep_batch(rows, batch, folder, samples, every))
    return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def purge(spark: SparkSession, folder: str) -> None:
    """Delete what the last merged table holds. Only while nobody reads older tables."""
    whole = max(_complete(spark, f"{folder}/merged"), default=-1)
    for kind, last in (("parts", whole), ("merged", whole - 1)):
        for batch in _complete(spark, f"{folder}/{kind}"):
            if batch <= last:
                delete(spark, f"{folder}/{kind}/{_name(batch)}")
