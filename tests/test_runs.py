"""Files that fail, rows that fail, chains, records as files, and staged runs that are started again."""

import json
import os

import pytest
from pyspark.sql import functions as F

from voxloom.operators import attempts
from voxloom.plans import runner
from voxloom.sources import guarded, records


def test_scan_gives_a_row_for_every_file(spark, tmp_path):
    whole = {"duration": 2.0, "segments": [{"start": 0, "end": 1.5, "text": "hé", "speaker": "a"}, {"start": 1.5, "end": 2, "text": "b\n", "speaker": None}]}
    contents = {
        "a b.json": json.dumps(whole, indent=2),
        "ü+%41.json": json.dumps(whole),
        "none.json": json.dumps({"duration": 1, "segments": []}),
        "cut.json": json.dumps(whole)[:40],
        "text.json": "no json at all",
        "type.json": json.dumps({"duration": "long", "segments": []}),
        "empty.json": "",
        "blank.json": " \n\t ",
        "shape.json": json.dumps({"duration": 1.0}),
        "null.json": "null",
        "other.txt": "not looked at",
    }
    for name, text in contents.items():
        (tmp_path / name).write_text(text)
    scanned = guarded.scan_transcripts(spark, str(tmp_path))
    got = {r["stem"]: (r["error"], r["size"]) for r in scanned.collect()}
    size = lambda n: len(contents[n].encode())
    assert {k: v[0] for k, v in got.items()} == {"a b": None, "ü+%41": None, "none": None, "cut": "broken", "text": "broken", "type": "broken", "empty": "empty", "blank": "empty", "shape": "wrong_shape", "null": "broken"}
    assert all(got[n.removesuffix(".json")][1] == size(n) for n in contents if n.endswith(".json"))
    assert [(r["episode"], r["ordinal"], r["text"]) for r in guarded.segments_of(scanned).orderBy("episode", "ordinal").collect()] == [("a b", 0, "hé"), ("a b", 1, "b\n"), ("ü+%41", 0, "hé"), ("ü+%41", 1, "b\n")]
    totals = {r["outcome"]: r["n"] for r in guarded.totals(scanned).collect()}
    assert sum(totals.values()) == 10 and totals["ok"] == 3


def test_record_files(spark, tmp_path):
    rows = [(f"r{i}.json", json.dumps({"i": i, "t": "é"})) for i in range(40)]
    folder = f"{tmp_path}/out"
    table = spark.createDataFrame(rows, "name string, content string").repartition(6)
    records.write_records(table, folder, pretty=True)
    assert sorted(n for n in os.listdir(folder) if n.endswith(".json")) == sorted(n for n, _ in rows)
    assert not [n for n in os.listdir(folder) if n.startswith(records.UNDER_WAY)]
    assert open(f"{folder}/r7.json", encoding="utf-8").read() == json.dumps({"i": 7, "t": "é"}, indent=2, ensure_ascii=False)
    assert open(f"{folder}/_SUCCESS").read() == "40"
    read = spark.read.schema("i int, t string").option("multiLine", "true").json(folder)
    assert sorted(r["i"] for r in read.collect()) == list(range(40))


def test_a_retried_task_leaves_one_file_a_record(tmp_path):
    writer = records.RecordWriter({"path": str(tmp_path)}, False)

    def dies():
        yield ("a", "one")
        yield ("b", "two")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    done = writer.write(iter([("a", "one"), ("b", "two"), ("c", None)]))
    writer.commit([done])
    assert sorted(os.listdir(tmp_path)) == ["_SUCCESS", "a", "b", "c"]
    os.mkdir(tmp_path / f"{records.UNDER_WAY}gone")
    writer.abort([done, None])
    assert not [n for n in os.listdir(tmp_path) if n.startswith(".")]
    for bad in ("", "x/y", "_hidden", None):
        with pytest.raises(ValueError):
            writer.write(iter([(bad, "x")]))


def test_a_failed_job_raises_and_leaves_no_mark(spark, tmp_path):
    table = spark.createDataFrame([("a", "{}"), ("b", "broken")], "name string, content string").coalesce(1)
    with pytest.raises(Exception):
        records.write_records(table, str(tmp_path), pretty=True)
    assert not os.path.exists(tmp_path / "_SUCCESS") and not [n for n in os.listdir(tmp_path) if n.startswith(records.UNDER_WAY)]


# a lambda, as tasks can't import this module
ratio = lambda row: {"ratio": 12 / row["x"], "words": ["a"] * row["x"]}


def test_attempt_each(spark):
    table = spark.createDataFrame([(0,), (3,), (None,), (-1,)], "x int")
    out = attempts.attempt_each(table, ratio, "ratio double, words array<string>")
    got = {r["x"]: (r["ratio"], r["words"], r["error"]) for r in out.collect()}
    assert got[3] == (4.0, ["a"] * 3, None) and got[-1] == (-12.0, [], None)
    assert got[0][:2] == (None, None) and got[0][2].startswith("ZeroDivisionError") and got[None][2].startswith("TypeError")
    wrong = attempts.attempt_each(table, lambda row: {"ratio": "text"}, "ratio double").collect()
    assert all(r["ratio"] is None and r["error"] for r in wrong)
    assert attempts.attempt_each(table.where("false"), ratio, "ratio double, words array<string>").count() == 0
    with pytest.raises(ValueError):
        attempts.attempt_each(table.withColumn("Error", F.lit(1)), ratio, "ratio double, words array<string>")


def test_first_success(spark, tmp_path):
    seen = {}

    def step(name, works):
        def run(rows):
            seen[name] = sorted(r["x"] for r in rows.collect())
            return rows.withColumn("y", F.when(works(F.col("x")), F.lit(name))).withColumn("error", F.when(~works(F.col("x")), F.concat(F.lit(f"{name} can't "), F.col("x").cast("string"))))

        return name, run

    steps = [step("even", lambda x: x % 2 == 0), step("three", lambda x: x % 3 == 0), step("five", lambda x: x % 5 == 0)]
    table = spark.range(12).select(F.col("id").alias("x"), F.lit("kept").alias("further"))
    out = attempts.first_success(table, steps, f"{tmp_path}/steps")
    got = {r["x"]: (r["method"], r["y"], [tuple(f) for f in r["failures"]], r["further"]) for r in out.collect()}
    # each step sees only what all before failed on
    assert seen == {"even": list(range(12)), "three": [1, 3, 5, 7, 9, 11], "five": [1, 5, 7, 11]}
    assert got[4] == ("even", "even", [], "kept") and got[9] == ("three", "three", [("even", "even can't 9")], "kept")
    assert got[5][0] == "five" and got[7] == (None, None, [(n, f"{n} can't 7") for n in ("even", "three", "five")], "kept") and len(got) == 12
    report = {r["method"]: (r["seen"], r["worked"]) for r in attempts.chain_report(out, ["even", "three", "five"]).collect()}
    assert report == {"even": (12, 6), "three": (6, 2), "five": (4, 1), "none": (3, 0)}
    assert attempts.first_success(table.where("false"), steps, f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError):
        attempts.first_success(table, [steps[0], steps[0]], f"{tmp_path}/twice")


def test_a_stage_under_the_gate_runs_again(spark, tmp_path):
    ran, score = [], {"two": 5.0}

    def stage(name, run):
        return runner.Stage(name, lambda s, df: (ran.append(name), run(s, df))[1], lambda df: score.get(name, 9.0))

    stages = [stage("one", lambda s, _: s.range(6)), stage("two", lambda s, df: df.where("id > 0")), stage("three", lambda s, df: df.where("id > 1"))]
    first = runner.run_stages(spark, stages, str(tmp_path))
    assert first.done == ["one"] and first.error.startswith("two: score 5.00 under") and ran == ["one", "two"]
    again = runner.run_stages(spark, stages, str(tmp_path))
    # nothing downstream of a failed gate runs, and the stage itself is tried again
    assert again.skipped == ["one"] and again.done == [] and again.error and ran == ["one", "two", "two"]
    score["two"] = 8.0
    better = runner.run_stages(spark, stages, str(tmp_path))
    assert better.skipped == ["one"] and better.done == ["two", "three"] and better.error is None and better.progress(3) == 100.0
    assert runner.run_stages(spark, stages, str(tmp_path)).skipped == ["one", "two", "three"]
    score["two"] = float("nan")
    runner.delete(spark, f"{tmp_path}/_passed/two")
    assert runner.run_stages(spark, stages, str(tmp_path)).error.startswith("two")


def test_a_score_that_raises_passes_and_a_stage_that_raises_ends_the_run(spark, tmp_path):
    def bad(*_):
        raise RuntimeError("no model")

    stages = [runner.Stage("one", lambda s, _: s.range(3), bad), runner.Stage("two", bad), runner.Stage("three", lambda s, df: df)]
    log = runner.run_stages(spark, stages, str(tmp_path))
    assert log.done == ["one"] and log.unscored == {"one": "no model"} and log.error == "two: no model"
    assert runner.run_stages(spark, stages[:1], str(tmp_path)).skipped == ["one"]


def test_failed_rows_go_to_a_table_of_their_own(spark, tmp_path):
    work = runner.Stage("work", lambda s, _: attempts.attempt_each(s.range(4).select(F.col("id").cast("int").alias("x")), ratio, "ratio double, words array<string>"), lambda df: 10.0, errors="error")
    log = runner.run_stages(spark, [work, runner.Stage("next", lambda s, df: df.select("x"))], str(tmp_path))
    assert log.done == ["work", "next"] and log.failed_rows == {"work": 1}
    assert sorted(r["x"] for r in spark.read.parquet(f"{tmp_path}/next").collect()) == [1, 2, 3]
    assert [r["x"] for r in spark.read.parquet(f"{tmp_path}/work-errors").collect()] == [0]
