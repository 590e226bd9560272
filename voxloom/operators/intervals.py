"""Interval joins within an episode, by time bins: an equi-join on (episode, bin) and no nested loop."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# texts by turns that are compared at once
TILE = 1024


def _binned(df: DataFrame, width: float) -> DataFrame:
    last = F.greatest(F.floor(F.col("end") / width), F.floor(F.col("start") / width))
    return df.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / width), last)))


def _overlap() -> Column:
    return F.least("a.end", "b.end") - F.greatest("a.start", "b.start")


def _spans(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (start, end), the first row of each and, for every row, which one it has."""
    spans = np.column_stack([group.column(c).to_numpy().astype(float) for c in ("start", "end")])
    return np.unique(spans, axis=0, return_index=True, return_inverse=True)


def align_speakers(texts: DataFrame, turns: DataFrame, width: float = 600.0) -> DataFrame:
    """texts plus the speaker whose turn overlaps most (first turn on a tie); null if none does.

    A text and a turn meet only in the bin of their overlap's start, so each pair is seen once. A bin of an episode is a group; only
    the best turn of each of its texts leaves it, as the number of pairs grows with the square of how many speak at a time.
    """
    out = StructType([texts.schema["episode"], texts.schema["ordinal"], StructField("overlap", DoubleType()), StructField("turn", turns.schema["ordinal"].dataType), StructField("who", turns.schema["speaker"].dataType)])

    def best(key: tuple, said: pa.Table, spoken: pa.Table) -> pa.Table:
        # of equal spans the first turn counts
        spoken = spoken.sort_by([("ordinal", "ascending"), ("speaker", "descending")])
        (span, _, whose), (turn, first, _) = _spans(said), _spans(spoken)
        order = np.argsort(first)
        turn, first = turn[order], first[order]
        top, at = np.full(len(span), -np.inf), np.zeros(len(span), np.int64)
        for i in range(0, len(span), TILE):
            s, e = span[i : i + TILE, :1], span[i : i + TILE, 1:]
            for k in range(0, len(turn), TILE):
                start, end = turn[k : k + TILE, 0], turn[k : k + TILE, 1]
                later = np.maximum(s, start)
                meet = (start < e) & (end > s) & (np.floor(later / width) == key[1].as_py())
                overlap = np.where(meet, np.minimum(e, end) - later, -np.inf)
                now = overlap.argmax(axis=1)
                most = overlap[np.arange(len(s)), now]
                more = np.flatnonzero(most > top[i : i + TILE])
                top[i + more], at[i + more] = most[more], first[k + now[more]]
        whose = whose.reshape(-1)
        kept = np.flatnonzero(np.isfinite(top[whose]))
        found, chosen = said.take(pa.array(kept)), spoken.take(pa.array(at[whose[kept]]))
        return pa.table({"episode": found.column("episode"), "ordinal": found.column("ordinal"), "overlap": pa.array(top[whose[kept]]), "turn": chosen.column("ordinal"), "who": chosen.column("speaker")})

    a, b = _binned(texts.select("episode", "ordinal", "start", "end"), width), _binned(turns.select("episode", "ordinal", "start", "end", "speaker"), width)
    met = a.groupBy("episode", "bin").cogroup(b.groupBy("episode", "bin")).applyInArrow(best, out)
    top = met.groupBy("episode", "ordinal").agg(F.max(F.struct("overlap", (-F.col("turn")).alias("order"), "who")).alias("best"))
    return texts.join(top, ["episode", "ordinal"], "left").withColumn("aligned_speaker", F.col("best.who")).withColumn("overlap", F.coalesce("best.overlap", F.lit(0.0))).drop("best")


def self_overlaps(segments: DataFrame, least: float = 0.5, width: float = 600.0) -> DataFrame:
    """Pairs of one speaker's segments that overlap by more than `least` of either."""
    s = segments.select("episode", "speaker", "ordinal", "start", "end")
    a, b = _binned(s, width).alias("a"), _binned(s, width).alias("b")
    met = a.join(b, (F.col("a.episode") == F.col("b.episode")) & (F.col("a.speaker") == F.col("b.speaker")) & (F.col("a.bin") == F.col("b.bin")) & (F.col("a.ordinal") < F.col("b.ordinal")) & (F.col("a.start") < F.col("b.end")) & (F.col("a.end") > F.col("b.start")))
    met = met.where(F.col("a.bin") == F.floor(F.greatest("a.start", "b.start") / width))
    part = lambda x: F.coalesce(F.try_divide(_overlap(), F.col(f"{x}.end") - F.col(f"{x}.start")), F.lit(0.0))
    return met.where((part("a") > least) | (part("b") > least)).select(F.col("a.episode").alias("episode"), F.col("a.speaker").alias("speaker"), F.col("a.ordinal").alias("left_ordinal"), F.col("b.ordinal").alias("right_ordinal"), _overlap().alias("overlap"))


def number_clips(clips: DataFrame, least_seconds: float = 1.0) -> DataFrame:
    """Clips with a speaker, text and enough length, numbered within (episode, speaker) and named."""
    kept = clips.where((F.col("speaker") != "") & (F.trim("text") != "") & (F.col("end") - F.col("start") >= least_seconds))
    n = F.row_number().over(Window.partitionBy("episode", "speaker").orderBy("ordinal"))
    return kept.withColumn("number", n).withColumn("clip_name", F.format_string("%s_%s_%03d.wav", "episode", "speaker", "number"))
