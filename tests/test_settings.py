"""Layers, kinds, ranges, missing and broken files."""

import pytest

from voxloom.operators import settings
from voxloom.operators.settings import ACCEPT, CHECK, Setting


def layers(spark, *rows):
    return spark.createDataFrame(list(rows), settings.LAYERS)


MIXED = [Setting("a", "long", 3, 0, 10), Setting("b.c", "double", 0.5, 0, 1), Setting("on", "boolean", True), Setting("mode", "string", "clean")]


def test_the_highest_usable_layer_counts(spark):
    table = layers(
        spark,
        ("p", 0, "a", "4"), ("p", 1, "a", "5"), ("p", 2, "a", "six"), ("p", 3, "a", "11"), ("p", 4, "a", None),
        ("p", 0, "b.c", " 0.25 "), ("p", 1, "b.c", "nan"), ("p", 0, "on", "False"), ("p", 1, "on", "0"), ("p", 1, "mode", "reference"),
        ("q", 0, "zzz", "1"), ("q", 0, "a", "3.0"), ("r", 0, "a", None),
    )
    got = {r["profile"]: (r["a"], r["b__c"], r["on"], r["mode"]) for r in settings.resolved(table, MIXED).collect()}
    assert got == {"p": (5, 0.25, False, "reference"), "q": (3, 0.5, True, "clean"), "r": (3, 0.5, True, "clean")}
    errors = {(r["profile"], r["layer"], r["name"]): r["error"] for r in settings.setting_errors(table, MIXED).collect()}
    assert errors == {("p", 2, "a"): "wrong_kind", ("p", 3, "a"): "out_of_range", ("p", 1, "b.c"): "wrong_kind", ("p", 1, "on"): "wrong_kind", ("q", 0, "zzz"): "unknown_name", ("q", 0, "a"): "wrong_kind"}
    assert settings.resolved(table.where("false"), MIXED).count() == 0
    with pytest.raises(ValueError):
        Setting("x", "date", 1)


def test_rows_without_a_profile_have_defaults(spark):
    rows = spark.createDataFrame([(1, "p"), (2, "other"), (3, None)], "i int, profile string")
    table = settings.resolved(layers(spark, ("p", 0, "a", "9")), MIXED)
    got = {r["i"]: (r["a"], r["mode"]) for r in settings.with_settings(rows, table, MIXED).collect()}
    assert got == {1: (9, "clean"), 2: (3, "clean"), 3: (3, "clean")}


def test_files(spark, tmp_path):
    (tmp_path / "base.yaml").write_text("quality_thresholds:\n  min_duration: 3\n  max_duration: long\npreprocessing:\n  quality_check: {snr_threshold: 17.5, min_duration: null}\nlist: [1, 2]\n")
    (tmp_path / "own.json").write_text('{"quality_thresholds": {"min_word_count": 5}}')
    (tmp_path / "broken.yaml").write_text("a: [1, 2\nb: }")
    (tmp_path / "list.yaml").write_text("- 1\n- 2\n")
    (tmp_path / "empty.yaml").write_text("")
    files = [(p, k, f"{tmp_path}/{n}") for p, k, n in (("x", 0, "base.yaml"), ("x", 1, "own.json"), ("y", 0, "broken.yaml"), ("z", 0, "none.yaml"), ("z", 1, "list.yaml"), ("w", 0, "empty.yaml"))]
    table, errors = settings.read_layers(spark, files)
    got = {r["profile"]: r for r in settings.resolved(table, ACCEPT + CHECK).collect()}
    assert (got["x"]["quality_thresholds__min_duration"], got["x"]["quality_thresholds__max_duration"], got["x"]["quality_thresholds__min_word_count"]) == (3.0, 15.0, 5)
    assert (got["x"]["preprocessing__quality_check__snr_threshold"], got["x"]["preprocessing__quality_check__min_duration"]) == (17.5, 1.0)
    assert {(r["profile"], r["layer"]): r["error"].split(":")[0].split("Error")[0] for r in errors.collect()}.keys() == {("y", 0), ("z", 0), ("z", 1)}
    assert {r["profile"]: r["error"] for r in errors.collect() if r["layer"] == 0}["z"] == "missing"
    assert {(r["name"], r["error"]) for r in settings.setting_errors(table, ACCEPT + CHECK).collect()} == {("quality_thresholds.max_duration", "wrong_kind")}
    empty, none = settings.read_layers(spark, [])
    assert empty.count() == 0 and none.count() == 0
