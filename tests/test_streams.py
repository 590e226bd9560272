"""Real file streams: overlap removal with state and timers, totals that survive replays."""

import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from voxloom.operators import dedup, rollups
from voxloom.streaming import evict, rollup

ROWS = "episode string, speaker string, ordinal long, start double, end double, text string, confidence double"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(key, before)


def some_rows(seed=4, n=60):
    draw, out = random.Random(seed), []
    for e in "pq":
        for s in ("m", "n", ""):
            for i in range(n):
                t = round(draw.uniform(0, 60), 2)
                out.append((e, s, i, t, t + draw.choice([0.0, 1.0, 5.0, 12.0]), draw.choice(["a", "b ", "C", "d", "e", "f", "", None, f"x{i}"]), draw.choice([0.2, 0.9, None])))
    return out


def timed(rows):
    """Event times: episode q follows p by an hour."""
    base = F.when(F.col("episode") == "p", 0).when(F.col("episode") == "q", 3600).otherwise(F.col("start") * 0)
    return rows.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + base + F.col("start")))


def run_stream(spark, files, mode, late="10 seconds", idle=36000):
    folder = tempfile.mkdtemp(prefix="spark-stream-")
    for k, rows in enumerate(files):
        timed(spark.createDataFrame(rows, ROWS)).coalesce(1).write.parquet(f"{folder}/in/{k}")
        # the file source takes the oldest first
        for f in glob.glob(f"{folder}/in/{k}/*.parquet"):
            os.utime(f, (1_700_000_000 + 60 * k,) * 2)
    stream = spark.readStream.schema(timed(spark.createDataFrame([], ROWS)).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    out = evict.evict_overlaps_stream(stream, "ts", late, idle, mode)
    name = f"evicted_{mode}_{abs(hash(folder))}"
    query = out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    progress = query.recentProgress
    return sorted(map(tuple, spark.table(name).collect()), key=repr), progress


@pytest.mark.parametrize("mode", ["clean", "reference"])
def test_evict_stream_equals_batch(rocks, mode):
    spark, rows = rocks, some_rows()
    draw = random.Random(1)
    # shuffled within ten seconds of event time, dealt over files in order
    order = lambda r: (r[0], r[3] + draw.uniform(0, 8))
    ordered = sorted(rows, key=order)
    files = [ordered[k : k + 90] for k in range(0, len(ordered), 90)]
    end = [("z", "closing", 1, 20000.0, 20001.0, "end", 1.0)]
    closing = [(e, s, o, 90000.0, 90001.0, t, c) for e, s, o, _, _, t, c in end]
    got, _ = run_stream(spark, [*files, closing], mode)
    want = sorted(map(tuple, dedup.evict_overlaps(spark.createDataFrame(rows, ROWS), mode).collect()), key=repr)
    assert [r for r in got if r[0] != "z"] == want and len(want) > 30


def test_late_rows_and_expiry(rocks):
    spark = rocks
    early = [("p", "m", 1, 10.0, 14.0, "one", 1.0), ("p", "m", 2, 40.0, 41.0, "two", 1.0)]
    onward = [("p", "m", 3, 400.0, 404.0, "three", 1.0)]
    # behind the watermark: the row at 12 would have been a rival of `one`
    late = [("p", "m", 4, 12.0, 30.0, "late", 1.0), ("p", "m", 5, 405.0, 406.0, "one", 1.0)]
    closing = [("z", "x", 1, 90000.0, 90001.0, "end", 1.0)]
    got, progress = run_stream(spark, [early, onward, late, closing], "clean")
    assert [(r[2], r[4]) for r in got if r[0] == "p"] == [(1, 14.0), (2, 41.0), (3, 404.0)]
    assert sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"]) == 1
    # texts are forgotten a while after the key's last segment: `one` is news again
    again = [("p", "m", 6, 2000.0, 2001.0, "one", 1.0)]
    middle = [("y", "x", 1, 1500.0, 1501.0, "clock", 1.0)]
    later = [("y", "x", 2, 1600.0, 1601.0, "tick", 1.0)]
    forgotten, _ = run_stream(spark, [early, middle, later, again, closing], "clean", idle=100)
    remembered, _ = run_stream(spark, [early, middle, later, again, closing], "clean", idle=36000)
    assert [r[2] for r in forgotten if r[0] == "p"] == [1, 2, 6] and [r[2] for r in remembered if r[0] == "p"] == [1, 2]


def test_arrivals_into_speaker_totals(spark):
    rows = [r for r in some_rows(9, 80) if r[1]] + [("r", "n", 1, 0.0, 2.5, "alone", None)]
    folder = tempfile.mkdtemp(prefix="spark-stream-")
    for k in range(7):
        spark.createDataFrame(rows[k::7], ROWS).coalesce(1).write.parquet(f"{folder}/in/{k}")
    schema = spark.createDataFrame([], ROWS).schema
    arrivals = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    totals = lambda: [(r["speaker"], r["total_segments"], round(r["total_duration"], 6), r["episodes"], r["sample_texts"]) for r in rollup.speaker_totals(rollup.current_partials(spark, f"{folder}/out")).collect()]
    rollup.follow(arrivals(), f"{folder}/out", every=3).awaitTermination()
    want = [(r["speaker"], r["total_segments"], round(r["total_duration"], 6), r["episodes"], r["sample_texts"]) for r in rollups.speaker_analysis(spark.createDataFrame(rows, ROWS)).collect()]
    assert totals() == want
    assert rollup.children(spark, f"{folder}/out/merged") == ["000000000002", "000000000005"]
    # a batch that comes again changes nothing, whatever it holds
    for batch in (0, 2, 5):
        rollup.keep_batch(spark.createDataFrame(rows[:9], ROWS), batch, f"{folder}/out", every=3)
    assert totals() == want
    # a merged table cut off before its mark is made anew from the one before
    rollup.delete(spark, f"{folder}/out/merged/000000000005/_SUCCESS")
    assert totals() == want
    rollup.keep_batch(spark.createDataFrame(rows[:9], ROWS), 5, f"{folder}/out", every=3)
    assert totals() == want
    rollup.purge(spark, f"{folder}/out")
    assert totals() == want and rollup.children(spark, f"{folder}/out/parts") == ["000000000006"]
    # files that come later join in
    spark.createDataFrame([("t", "new", 1, 0.0, 1.0, "hello", 1.0)], ROWS).write.parquet(f"{folder}/in/8")
    rollup.follow(arrivals(), f"{folder}/out", every=3).awaitTermination()
    assert {r[0] for r in totals()} == {r[0] for r in want} | {"new"}


def test_no_arrivals(spark):
    folder = tempfile.mkdtemp(prefix="spark-stream-")
    assert rollup.speaker_totals(rollup.current_partials(spark, folder)).count() == 0
    rollup.keep_batch(spark.createDataFrame([], ROWS), 0, folder, every=1)
    assert rollup.speaker_totals(rollup.current_partials(spark, folder)).count() == 0
