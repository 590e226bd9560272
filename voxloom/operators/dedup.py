"""Order-dependent removal of repeated and overlapping segments."""

from __future__ import annotations

from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_texts(rows: DataFrame, by: str, text: str, order: str) -> DataFrame:
    """The first row of every (by, case-folded text). Repeats go before the exchange, which is by a digest of the text."""
    digest = F.sha2(F.lower(text).cast("binary"), 256)
    key = [F.col(by).alias("__by"), digest.alias("__digest")]
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), order).alias("row"))
    return first.select("row.*")


class Live(NamedTuple):
    """A kept segment that later ones may still reach. text: stripped, case-folded; row: whatever stands for it."""

    start: float
    end: float
    sure: float
    text: str
    row: Any


def admit(live: list[Live], new: Live) -> tuple[bool, Live | None]:
    """Whether a segment is kept beside live ones, and the one it evicts; live, in order of time, is changed accordingly.

    The first one of which either is covered by more than half is its rival: it stays if the new one is shorter or less sure.
    """
    own = new.end - new.start
    for k, old in enumerate(live):
        common, length = min(new.end, old.end) - max(new.start, old.start), old.end - old.start
        if new.start < old.end and new.end > old.start and ((own > 0 and common / own > 0.5) or (length > 0 and common / length > 0.5)):
            if own < length or new.sure < old.sure:
                return False, None
            del live[k]
            live.append(new)
            return True, old
    live.append(new)
    return True, None


def _contested(rows: DataFrame, by: str) -> DataFrame:
    """rows plus `__contested`: whether another row of the (episode, by) group may reach the segment or have its text.

    A row that none reaches and whose text is its own is kept and changes nothing for others. Both windows and the
    grouping that follows share one exchange. Texts are compared without case, signs and the letters i and k (which
    rare signs fold to), so rows equal by any folding are contested; texts without any other ASCII letter all are.
    """
    start, end = F.coalesce("start", F.lit(0.0)), F.coalesce("end", F.lit(0.0))
    group = ["episode", by]
    in_order = Window.partitionBy(*group).orderBy(start, "ordinal")
    reached = F.max(end).over(in_order.rowsBetween(Window.unboundedPreceding, -1)) > start
    reaches = F.lead(start).over(in_order) < end
    rough = F.regexp_replace(F.lower("text"), "[^a-hjl-z0-9]", "")
    keyed = rows.withColumns({"__reach": F.coalesce(reached, F.lit(False)) | F.coalesce(reaches, F.lit(False)), "__rough": F.coalesce(rough, F.lit(""))})
    alike = F.count("*").over(Window.partitionBy(*group, "__rough")) > 1
    return keyed.withColumn("__contested", F.col("__reach") | (F.col("__rough") == "") | alike).drop("__reach", "__rough")


def evict_overlaps(segments: DataFrame, mode: str = "clean", by: str = "speaker", inside: str | None = None) -> DataFrame:
    """Segments in time order; one that overlaps a live one of its speaker by more than half of either is dropped if shorter or less sure, else evicts it.

    A text that a live segment of the group has is dropped too. by: the column whose equal values compete, such as a mapped
    character. The rule is sequential within (episode, by), one speaker's time in one episode, and only for rows that another
    one reaches or resembles; the rest never leave the JVM. Segments that end before the
    present start are left behind, so a step costs as much as what still reaches it.
    mode `reference` keeps evicted rows in the result, `clean` returns live ones; there texts are known by speaker, and an
    evicted text is forgotten only where the speaker's name is the value of `by`. inside: a boolean column that says whether all
    samples of the clip are there (clips.within); a clip without them evicts what it beats and goes itself. Null counts as
    true, null confidence as 1. Segments without a speaker or a text go.
    """
    if mode not in ("clean", "reference"):
        raise ValueError(f"unknown mode {mode!r}")

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(_at=group["start"].fillna(0)).sort_values(["_at", "ordinal"], kind="stable").drop(columns="_at").reset_index(drop=True)
        texts = group["text"].fillna("").str.strip().str.lower().tolist()
        start, end = group["start"].fillna(0.0).tolist(), group["end"].fillna(0.0).tolist()
        sure = group["confidence"].fillna(1.0).tolist()
        there = [x is None or bool(x) for x in group[inside].astype(object).tolist()] if inside else [True] * len(group)
        owner = group["speaker" if mode == "reference" else by].tolist()
        same = group[by].tolist()
        live: list[Live] = []
        seen, kept, evicted = set(), [], set()
        for i, text in enumerate(texts):
            if not text or (owner[i], text) in seen:
                continue
            live = [x for x in live if x.end > start[i]]
            stays, out = admit(live, Live(start[i], end[i], sure[i], text, i))
            if out is not None:
                evicted.add(out.row)
                seen.discard((same[out.row], out.text))
            if stays and not there[i]:
                live.pop()
            elif stays:
                seen.add((owner[i], text))
                kept.append(i)
        return group.iloc[kept if mode == "reference" else [i for i in kept if i not in evicted]]

    columns = list(dict.fromkeys(["episode", "speaker", by, "ordinal", "start", "end", "text", "confidence"]))
    whole = list(dict.fromkeys([*columns, *([inside] if inside else [])]))
    named = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    rows = segments.select(*whole).where(named(by) & named("speaker"))
    marked = _contested(rows, by)
    alone = marked.where(~F.col("__contested"))
    alone = alone.where(F.coalesce(inside, F.lit(True))) if inside else alone
    met = marked.where("__contested").drop("__contested")
    return alone.select(*columns).unionByName(met.groupBy("episode", by).applyInPandas(scan, met.schema).select(*columns))
