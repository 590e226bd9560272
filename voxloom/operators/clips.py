"""Cutting clips out of recordings: bounds, padding, numbering, sample slices, joins with their texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ClipRules:
    min_duration: float = 1.0
    max_duration: float = 15.0
    min_confidence: float = 0.8
    min_snr: float = 15.0
    min_words: int = 3


def character_clips(rules: ClipRules) -> Column:
    """Whether a segment (duration, confidence, quality, text) makes a clip of its character."""
    words = F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != ""))
    return F.col("duration").between(rules.min_duration, rules.max_duration) & (F.col("confidence") >= rules.min_confidence) & (F.col("quality") >= rules.min_snr) & (words >= rules.min_words)


def extended(start: Column, end: Column, total: Column, pad: float, most: float) -> tuple[Column, Column]:
    """Both bounds moved out by the lesser of pad and most, within the recording."""
    by = min(pad, most)
    return F.greatest(F.lit(0.0), start - by), F.least(total, end + by)


def within(start: Column, end: Column, rate: Column, n: Column) -> Column:
    """Whether a clip's samples are all there."""
    return ((start * rate).cast("long") < n) & ((end * rate).cast("long") <= n)


def sample_slice(samples: Column, start: Column, end: Column, rate: Column) -> Column:
    """Samples from int(start * rate) up to int(end * rate)."""
    first = (start * rate).cast("int")
    return F.slice(samples, first + 1, F.greatest(F.lit(0), (end * rate).cast("int") - first))


def embedding_samples(clips: DataFrame, least: float, most: float) -> DataFrame:
    """Clips of at least `least` seconds, cut to `most`: what a voice embedding is made of."""
    long_enough = clips.where(F.size("samples") / F.col("sample_rate") >= least)
    return long_enough.withColumn("samples", F.slice("samples", 1, (F.lit(most) * F.col("sample_rate")).cast("int")))


def extract(kept: DataFrame, recordings: DataFrame) -> DataFrame:
    """(episode, character, number, ordinal, samples) of kept segments; numbers count within (episode, character).

    Numbers are given before clips beyond the recording go, so they can have gaps. recordings: a row an episode.
    """
    number = F.row_number().over(Window.partitionBy("episode", "character").orderBy("start", "ordinal"))
    cut = kept.withColumn("number", number).join(recordings, "episode")
    rate = F.col("sample_rate")
    cut = cut.where(within(F.col("start"), F.col("end"), rate, F.size("samples")))
    return cut.select("episode", "character", "number", "ordinal", sample_slice(F.col("samples"), F.col("start"), F.col("end"), rate).alias("samples"))


def with_transcript(audio: DataFrame, transcripts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audio joined with its transcript by stem, and the audio without one."""
    return audio.join(transcripts, "stem"), audio.join(transcripts, "stem", "left_anti")


def clips_of_mapping(clips: DataFrame, mapping: DataFrame) -> DataFrame:
    """Clips (speaker, name) of every mapping row (episode, speaker, ...) whose name starts with the episode.

    Equal speakers meet, the prefix is tested on them; one clip can belong to several episodes whose names begin alike.
    """
    return clips.where(F.lower("name").endswith(".wav")).join(mapping, "speaker").where(F.startswith("name", F.col("episode")))


def restored_labels(refs: DataFrame, known: DataFrame) -> DataFrame:
    """refs (path, ...) with the label that path had in known, `unknown` without one; of several the least."""
    one = known.groupBy("path").agg(F.min("label").alias("label"))
    return refs.join(one, "path", "left").withColumn("label", F.coalesce("label", F.lit("unknown")))


def existing_references(refs: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """refs whose path is a file, and those whose path is none."""
    return refs.join(files.select("path"), "path", "left_semi"), refs.join(files.select("path"), "path", "left_anti")


def copy_plan(clips: DataFrame, labels: DataFrame, target: str) -> DataFrame:
    """(source, target) of every clip of a labelled cluster: a folder for each label."""
    named = clips.join(labels, "cluster_id")
    return named.select(F.col("path").alias("source"), F.concat_ws("/", F.lit(target.rstrip("/")), "label", F.regexp_extract("path", r"([^/]*)$", 1)).alias("target"))


def numbered_samples(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """rows with `sample_name`: their place among those of `by`, two digits at least, before their name."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("string")
    return rows.withColumn("sample_name", F.concat_ws("_", F.when(F.length(place) < 2, F.concat(F.lit("0"), place)).otherwise(place), F.col(name)))


def positions(parts: DataFrame, by: str, order: list[str], gap: float = 0.3) -> DataFrame:
    """parts (duration) with where each starts and ends when those of `by` follow each other with a gap between."""
    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("duration") + gap).over(before), F.lit(0.0))
    return parts.withColumn("position", start).withColumn("position_end", start + F.col("duration"))


def dialogue(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """lines (episode, ordinal, ...) with `place`: episodes in the order of mapping (episode, position), then by ordinal."""
    order = mapping.groupBy("episode").agg(F.min("position").alias("position"))
    placed = lines.join(order, "episode").withColumn("of_episode", F.row_number().over(Window.partitionBy("episode").orderBy("ordinal")))
    sizes = placed.groupBy("episode", "position").agg(F.count("*").alias("n"))
    # a row an episode: what lies before each
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("position", "episode").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(before.select("episode", "before"), "episode").withColumn("place", F.col("before") + F.col("of_episode")).drop("before", "of_episode", "position")


def vocals_file(files: DataFrame) -> DataFrame:
    """(stem, path): of each recording's files (stem, name, path) the one whose name fits the first pattern that any fits; of several the least path.

    Patterns are fixed values, case counts and a stem stands for itself: `{stem}_(Vocals)*.wav`, `{stem}_Vocals.wav`,
    `*{stem}*Vocals*.wav`, `*Vocals*.wav`.
    """
    name, stem = F.col("name"), F.col("stem")
    wav = name.endswith(".wav")
    # what follows the first place of the stem holds every later one
    after = F.when(F.contains(name, stem), F.substring(name, F.position(stem, name) + F.length(stem), F.length(name)))
    rank = F.when(F.startswith(name, F.concat(stem, F.lit("_(Vocals)"))) & wav, 0).when(name == F.concat(stem, F.lit("_Vocals.wav")), 1)
    rank = rank.when(after.rlike(r"(?s)Vocals.*\.wav$"), 2).when(name.rlike(r"(?s)Vocals.*\.wav$"), 3)
    return files.withColumn("rank", rank).where("rank is not null").groupBy("stem").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def first_file(files: DataFrame, by: str) -> DataFrame:
    return files.groupBy(by).agg(F.min("path").alias("path"))


def dataset_manifest(accepted: DataFrame, texts: DataFrame, val_share: int = 10) -> DataFrame:
    """(clip, speaker, text, duration, split) of accepted clips with a text; one in val_share clips, by hash, validates."""
    digest = F.sha2(F.col("clip").cast("string").cast("binary"), 256)
    split = F.when(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % val_share == 0, "val").otherwise("train")
    said = accepted.join(texts, "clip").withColumn("text", F.trim("text")).where("text <> ''")
    return said.select("clip", "speaker", "text", "duration", split.alias("split"))


def transcript_alignment(segments: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode, n, n_good, share, score): segments with 0 <= start < end <= duration and a text; score out of 10, 0 without segments."""
    good = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("total")) & (F.trim("text") != "")
    counted = segments.join(episodes, "episode").groupBy("episode").agg(F.count("*").alias("n"), F.count_if(good).alias("n_good"))
    every = episodes.select("episode").join(counted, "episode", "left").na.fill(0, ["n", "n_good"])
    share = F.coalesce(F.try_divide(F.col("n_good").cast("double"), F.col("n")), F.lit(0.0))
    return every.withColumn("share", share).withColumn("score", 10 * F.col("share"))


# fixed values: file name endings taken as audio attachments
ATTACHMENTS = ("wav", "mp3", "flac", "ogg")


def is_audio_attachment(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).isin(*ATTACHMENTS)


def shortened(text: Column, most: int = 50) -> Column:
    """The first characters of a quotation, with an ellipsis if more follow."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def rated(rows: DataFrame, value: str) -> DataFrame:
    """rows with `number` and `error`: a value that is no number makes an error row, it ends no run."""
    number = F.col(value).try_cast("double")
    return rows.withColumn("number", number).withColumn("error", F.when(number.isNull() & F.col(value).isNotNull(), F.concat(F.lit("not a number: "), F.col(value))))


def real_time_rate(duration: Column, elapsed: Column) -> Column:
    return F.coalesce(F.try_divide(duration, elapsed), F.lit(0.0))
