"""What queries and steps must keep doing in whole, and with data that doesn't grow faster than their input."""

import numpy as np
from pyspark.sql import functions as F

from voxloom.functions import spectral
from voxloom.operators import blocks, cluster, intervals, settings, ward
from voxloom.plans import registry
from voxloom.scratch import children, shared_folder

DATA = "/root/testdata/sf0.001"


def test_name_parts_has_the_archive_name(spark):
    rows = registry.queries()["name_parts"](spark, DATA).select("vec_id", "archive").collect()
    assert rows and all(r["archive"] == f"A_b-{r['vec_id']}" for r in rows)


def test_vectors_travel_to_few_groups(spark):
    # before: one for every 1,024 or 2,048 vectors, 601 for this table
    assert [blocks.block_count(n, 64) for n in (1, 500, 10_256, 102_564, 615_384)] == [1, 1, 8, 8, 10]
    assert blocks.block_count(0, 1) == 1 and blocks.block_count(70, 5, 9) == 8
    # longer vectors, smaller blocks
    assert blocks.block_count(615_384, 1024) == 151
    rows = spark.range(20_000).selectExpr("id", "array(1D) AS v")
    assert blocks.block_pairs(rows, blocks.block_count(20_000, 1)).count() == 8 * 20_000


def _clustered(n):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(n, 6)) * 0.35 + 4 * rng.normal(size=(12, 6))[rng.integers(0, 12, n)]
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _density(m, eps, least):
    close = 1 - m @ m.T <= eps
    core = close.sum(axis=1) >= least
    label = np.where(core, np.arange(len(m)), len(m))
    while True:
        new = np.where(core, np.where(close & core[None, :], label[None, :], len(m)).min(axis=1), len(m))
        if (new == label).all():
            break
        label = new
    number = {x: k for k, x in enumerate(sorted(set(label[core])))} | {len(m): -1}
    outer = np.where(close & core[None, :], label[None, :], len(m)).min(axis=1)
    return [number[x] for x in np.where(core, label, outer)], close


def test_density_and_pairs_over_blocks_and_tiles(spark):
    m = _clustered(8_500)
    assert blocks.block_count(len(m), 6) == 8 and len(m) / 8 > blocks.TILE
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(len(m), None)], "vec_id long, embedding array<double>")
    want, close = _density(m, 0.002, 9)
    got = dict(cluster.dbscan(table, 0.002, 9).collect())
    assert [got[i] for i in range(len(m))] == want and got[len(m)] == -1
    assert len(set(want)) > 3 and -1 in want
    pairs = cluster.neighbours(table, 0.0005).toPandas()
    assert set(zip(pairs["a"], pairs["b"], strict=True)) == set(zip(*np.nonzero(1 - m @ m.T <= 0.0005), strict=True)) and not pairs.duplicated().any()


def test_copies_merge_at_once(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(120)]
    folder = shared_folder(spark, "ward")
    merges = ward.ward_merges(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), folder, last=0)
    # before: a round for each copy
    assert merges.count() == 119 and len([x for x in children(spark, folder) if x.startswith("merges")]) <= 3
    got = {}
    for r in ward.cut(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), merges, 3, f"{folder}/cut").collect():
        got.setdefault(r["cluster_id"], set()).add(r["vec_id"] % 3)
    assert got == {0: {0}, 1: {1}, 2: {2}}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_few_profiles_are_not_shuffled(spark):
    layers = settings.resolved(spark.createDataFrame([("a", 0, "quality_thresholds.min_duration", "4")], settings.LAYERS), settings.ACCEPT)
    rows = spark.range(30).withColumn("profile", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b"))
    joined = settings.with_settings(rows, layers, settings.ACCEPT)
    assert "BroadcastHashJoin [profile" in _plan(joined)
    assert {(r["id"] % 3, r["quality_thresholds__min_duration"]) for r in joined.collect()} == {(0, 4.0), (1, 2.0), (2, 2.0)}


def test_measures_share_a_python_worker(spark):
    x = spark.createDataFrame([(1, [0.1] * 64), (2, None), (3, [])], "k int, samples array<double>")
    s, rate = F.col("samples"), F.lit(160)
    m = x.select("k", spectral.has_fry(s, rate).alias("f"), spectral.less_fry(s, rate).alias("l"), spectral.more_speech(s, rate).alias("m"), spectral.trim_silence(s, rate).alias("t"))
    # before: four, one inside the other
    assert _plan(m).count("ArrowEvalPython") == 1
    assert {r["k"]: len(r["l"]) for r in m.collect()} == {1: 64, 2: 0, 3: 0}
    # before: a view into the sum of all frames
    short = spectral.scaled_band(np.ones(64), 160, 0, 10, 0.5)
    assert len(short) == 64 and short.base is None


def test_alignment_in_groups_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(7)

    def some(n, at):
        # many at a time, spans that repeat, empty and backward ones, over several bins
        start = rng.integers(0, 900, n) / 2.0
        return [(f"e{i % 2}", at + i, float(s), float(s + d), f"s{i % 5}") for i, (s, d) in enumerate(zip(start, rng.integers(-2, 60, n), strict=True))]

    schema = "episode string, ordinal long, start double, end double, speaker string"
    texts, turns = some(1500, 0), some(2600, 5000)
    got = intervals.align_speakers(spark.createDataFrame(texts, schema), spark.createDataFrame(turns, schema), 100.0)
    # before: a join of texts with turns, a row a pair
    assert "FlatMapCoGroupsInArrow" in _plan(got)
    want = {}
    for e, o, s, t, _ in texts:
        met = [(min(t, b) - max(s, a), -k, w) for f, k, a, b, w in turns if f == e and a < t and b > s]
        want[o] = (max(met)[2], max(met)[0]) if met else (None, 0.0)
    assert {r["ordinal"]: (r["aligned_speaker"], r["overlap"]) for r in got.collect()} == want
