"""Labels for clusters from patterns in what is said. Patterns and names are data: (label, ordinal, pattern) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.numbers import fixed
from voxloom.operators.ordering import numbered
from voxloom.scratch import shared_folder, stored


def theme_ratio(utterances: DataFrame, patterns: list[str], by: str = "speaker") -> DataFrame:
    """Per cluster: rows, rows that match a theme pattern, their share."""
    hit = F.col("text").rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))
    return utterances.groupBy(by).agg(F.count("*").alias("segments"), F.count_if(hit).alias("theme")).withColumn("theme_ratio", F.col("theme") / F.col("segments"))


def pattern_scores(utterances: DataFrame, patterns: list[tuple[str, int, str]], themes: DataFrame, by: str = "speaker") -> DataFrame:
    """(cluster, label, hits, score): pattern hits per row, damped by the theme share.

    Hits are counted row by row and summed, so no cluster's text is ever joined into one value; a match can't span rows.
    """
    labels = dict.fromkeys(label for label, _, _ in patterns)
    # every pattern is a literal, compiled once, and all are counted in one aggregation
    count = {label: sum((F.regexp_count("text", F.lit(f"(?i){p}")) for name, _, p in patterns if name == label), F.lit(0)) for label in labels}
    sums = utterances.groupBy(by).agg(*[F.sum(x).cast("long").alias(f"__{k}") for k, x in enumerate(count.values())])
    hits = sums.select(by, F.explode(F.array(*[F.struct(F.lit(label).alias("label"), F.col(f"__{k}").alias("hits")) for k, label in enumerate(labels)])).alias("p")).select(by, "p.*")
    return hits.join(themes, by).withColumn("score", F.col("hits") / F.col("segments") * F.greatest(F.lit(0.0), 1 - 2 * F.col("theme_ratio"))).select(by, "label", "hits", "score")


# fixed values: a label is strong above the first score, wins alone above the second, among others above the third
STRONG, ALONE, AMONG = 0.03, 0.1, 0.05
THEME, LONG_SECONDS, MANY_EPISODES = 0.7, 60, 3
# a main voice has full weight from so many seconds and episodes on
MAIN_SECONDS, MAIN_EPISODES = 120.0, 4.0


def assign_labels(scores: DataFrame, stats: DataFrame, names: list[str], by: str = "speaker", main: tuple[str, ...] = ()) -> DataFrame:
    """(cluster, label, note) of every cluster of stats, in four passes, longest cluster first, ties by name.

    1 clusters of at most one strong label: the first whose best label is a name and clear takes it; 2 clusters of several
    strong labels: the best one left if it dominates, else a mixed cluster; 3 the names left go to the next clusters of
    mostly dialogue in turn; 4 the longest theme cluster narrates, the rest is told apart by theme. Scores of `main` voices
    weigh less in short clusters of few episodes, after strength is decided. Of equal scores the
    label that comes first by name counts. The table of clusters is written once; winners, one a name, reach the driver and
    go back as a table. note: why, in words.
    """
    spark = stats.sparkSession
    placed = numbered(stats, [F.desc("total_duration"), F.col(by)], "place").withColumn("open", F.col("dialogue") > F.col("segments") / 2)
    weight = 0.5 + 0.5 * F.least(F.lit(1.0), F.col("total_duration") / MAIN_SECONDS) * F.least(F.lit(1.0), F.col("episodes") / MAIN_EPISODES)
    weighed = scores.join(stats.select(by, "total_duration", "episodes"), by)
    weighed = weighed.select(by, "label", (F.col("score") > STRONG).alias("strong"), F.when(F.col("label").isin(list(main)), F.col("score") * weight).otherwise(F.col("score")).alias("score"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "label", "strong")))
    table = placed.join(weighed.groupBy(by).agg(ranked.alias("ranked")), by, "left")
    none = F.array().cast("array<struct<minus:double,label:string,strong:boolean>>")
    table = table.withColumn("ranked", F.coalesce("ranked", none)).withColumn("strong", F.filter("ranked", lambda x: x["strong"]))
    table = stored(table, shared_folder(spark, "labels"))
    best = F.get("ranked", F.lit(0))
    clear = table.where(F.col("open") & (F.size("strong") <= 1) & (best["minus"] < -ALONE) & best["label"].isin(names))
    taken = {r["label"]: r[by] for r in clear.groupBy(best["label"].alias("label")).agg(F.min_by(by, "place").alias(by)).collect()}
    several = table.where(F.col("open") & (F.size("strong") > 1) & ~F.col(by).isin(list(taken.values())))
    led, after = {}, 0
    while True:
        left = F.filter("strong", lambda x: ~x["label"].isin([*taken, *led]))
        first, second = F.get(left, F.lit(0)), F.get(left, F.lit(1))
        leads = (first["minus"] < -AMONG) & (second.isNull() | (first["minus"] < 2 * second["minus"]))
        nxt = several.where((F.col("place") > after) & leads).select("place", by, first["label"].alias("label")).orderBy("place").limit(1).collect()
        if not nxt:
            break
        led[nxt[0]["label"]], after = nxt[0][by], nxt[0]["place"]
    won = taken | led
    rest = [n for n in names if n not in won]
    waiting = table.where(F.col("open") & (F.size("strong") <= 1) & ~F.col(by).isin(list(won.values())))
    fit = (F.col("total_duration") > LONG_SECONDS) & (F.col("episodes") > MANY_EPISODES)
    turns = [(r[by], rest[k] if r["fit"] else f"major_character_unknown_{r[by]}", "turn" if r["fit"] else "unfit") for k, r in enumerate(waiting.orderBy("place").limit(len(rest)).select(by, fit.alias("fit")).collect())]
    narrator = table.where(~F.col("open") | (F.size("strong") <= 1)).where((F.col("theme_ratio") > THEME) & ~F.col(by).isin([*won.values(), *(c for c, _, _ in turns)])).orderBy("place").limit(1).select(by).collect()
    given = [(c, label, "clear") for label, c in taken.items()] + [(c, label, "leads") for label, c in led.items()] + turns + [(r[by], "narrator", "narrator") for r in narrator]
    # at most one row a name, one a turn and the narrator
    fixed_ones = F.broadcast(spark.createDataFrame(given, f"`{by}` {stats.schema[by].dataType.simpleString()}, given string, way string"))
    labelled = table.join(fixed_ones, by, "left")
    theme, many = F.col("theme_ratio") > THEME, F.col("open") & (F.size("strong") > 1)
    way = F.coalesce("way", F.when(many, "mixed").when(theme, "theme").otherwise("minor"))
    name = F.col(by).cast("string")
    label = F.coalesce("given", F.when(many, F.concat(F.lit("mixed_cluster_"), name)).when(theme, F.concat(F.lit("theme_song_"), name)).otherwise(F.concat(F.lit("minor_character_"), name)))
    return labelled.withColumns({"label": label, "way": way}).select(by, "label", _note(by).alias("note"))


def _note(by: str) -> Column:
    """Why a cluster has its label. Wordings are fixed values."""
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    said, minutes = F.col("dialogue"), fixed(F.col("total_duration") / 60, 1)
    strong = F.array_join(F.array_sort(F.transform("strong", lambda x: x["label"])), ", ")
    score = fixed(-F.get(F.filter("ranked", lambda x: x["label"] == F.col("label")), F.lit(0))["minus"], 2)
    share = say(fixed(F.col("theme_ratio") * 100, 0), "% theme")
    reach = say(minutes, "min across ", F.col("episodes"), " episodes")
    words = {
        "clear": say("content score ", score, ", ", said, " dialogue segments, ", reach),
        "leads": say("DOMINANT in MIXED CLUSTER (others: ", strong, "), score ", score, ", ", said, " segments"),
        "mixed": say("MIXED CLUSTER detected: ", strong, ". Manual review required."),
        "turn": say("Fallback assignment (high quality), ", said, " segments, ", reach),
        "unfit": F.lit("Unassigned major cluster. Quality too low for fallback assignment."),
        "narrator": say("Likely theme song cluster (", share, "), ", minutes, "min"),
        "theme": say("additional theme cluster (", share, "), ", minutes, "min"),
        "minor": say(said, " dialogue segments, manual review needed"),
    }
    shown = F.when(F.col("way") == "theme", "theme song").when(F.col("way") == "minor", "minor character").otherwise(F.col("label"))
    return F.concat(F.lit("Cluster "), F.col(by).cast("string"), F.lit(" → "), shown, F.lit(": "), F.coalesce(*[F.when(F.col("way") == w, text) for w, text in words.items()]))


def best_labels(scores: DataFrame, by: str = "speaker") -> DataFrame:
    """Best and second label of each cluster and whether the best dominates (over twice the second)."""
    rn = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "label"))
    top = scores.withColumn("rn", rn).where("rn <= 2")
    return top.groupBy(by).agg(F.max(F.when(F.col("rn") == 1, F.col("label"))).alias("best"), F.max(F.when(F.col("rn") == 1, F.col("score"))).alias("best_score"), F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("score"))), F.lit(0.0)).alias("second_score")).withColumn("dominates", F.col("best_score") > 2 * F.col("second_score"))
