"""Rules that SQL twins don't reach: sequential removal, labels, names, spectra, real streams, files."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import signal as S
from voxloom.functions import spectral
from voxloom.operators import clips, dedup, labeling, ordering, reports, transcripts
from voxloom.plans import runner
from voxloom.sources import files
from voxloom.streaming import turns


def brute_evict(rows, mode):
    """One pass in time order over plain tuples (start, end, confidence, text, ordinal)."""
    live, seen, out = [], set(), []
    for r in sorted(rows, key=lambda r: (r[0], r[4])):
        if not r[3].strip() or r[3].strip().lower() in seen:
            continue
        own, rival = r[1] - r[0], None
        for o in live:
            common, old = min(r[1], o[1]) - max(r[0], o[0]), o[1] - o[0]
            if common > 0 and ((own > 0 and common / own > 0.5) or (old > 0 and common / old > 0.5)):
                rival = o
                break
        if rival and (own < rival[1] - rival[0] or r[2] < rival[2]):
            continue
        if rival:
            live.remove(rival)
            seen.discard(rival[3].strip().lower())
        live.append(r)
        seen.add(r[3].strip().lower())
        out.append(r)
    return sorted(r[4] for r in (out if mode == "reference" else live))


@pytest.mark.parametrize("mode", ["clean", "reference"])
def test_evict_overlaps(spark, mode):
    draw = random.Random(4)
    groups = {(e, s): [(t := draw.uniform(0, 60), t + draw.choice([0.0, 1.0, 5.0, 12.0]), draw.choice([0.2, 0.9, 1.0]), draw.choice(["a", "b ", "C", "d", "e", "f", "", f"x{i}"]), i) for i in range(60)] for e in "pq" for s in "mn"}
    rows = [(e, s, i, a, b, t, None if c == 1.0 else c) for (e, s), g in groups.items() for a, b, c, t, i in g]
    df = spark.createDataFrame(rows, "episode string, speaker string, ordinal long, start double, end double, text string, confidence double")
    got = {}
    for r in dedup.evict_overlaps(df, mode).collect():
        got.setdefault((r["episode"], r["speaker"]), []).append(r["ordinal"])
    assert {k: sorted(v) for k, v in got.items()} == {k: brute_evict(g, mode) for k, g in groups.items()}
    with pytest.raises(ValueError):
        dedup.evict_overlaps(df, "other")


def brute_by_character(rows):
    """One list of kept segments over all speakers, searched whole at every step: rows (start, end, confidence, text, ordinal, speaker, character, there)."""
    processed, seen, out = [], set(), []
    for r in sorted(rows, key=lambda r: (r[0], r[4])):
        text = r[3].strip().lower()
        if not r[5] or not text or (r[5], text) in seen:
            continue
        own, lost = r[1] - r[0], False
        for o in processed:
            if o[6] == r[6] and o[0] < r[1] and o[1] > r[0]:
                common, old = min(r[1], o[1]) - max(r[0], o[0]), o[1] - o[0]
                if (own > 0 and common / own > 0.5) or (old > 0 and common / old > 0.5):
                    lost = own < old or r[2] < o[2]
                    if not lost:
                        processed.remove(o)
                        seen.discard((o[6], o[3].strip().lower()))
                    break
        if lost or not r[7]:
            continue
        processed.append(r)
        seen.add((r[5], text))
        out.append(r[4])
    return sorted(out)


def test_evict_overlaps_of_characters_within_recordings(spark):
    draw = random.Random(9)
    cast = {"anna": "anna", "s1": "anna", "s2": "ben", "": "anna"}
    rows = []
    for i in range(400):
        t, speaker = draw.uniform(0, 700), draw.choice(list(cast))
        text = draw.choice(["Yes", "no ", "\u00a0", "K", "\u212a", "\u0130", "i\u0307", "\u0434\u0430", f"line {i}", f"line {i}", f"line {i}"])
        rows.append((t, t + draw.choice([0.0, 0.5, 1.5, 4.0]), draw.choice([0.2, 0.9]), text, i, speaker, cast[speaker], draw.random() > 0.2))
    df = spark.createDataFrame([("e", *r) for r in rows], "episode string, start double, end double, confidence double, text string, ordinal long, speaker string, character string, there boolean")
    got = dedup.evict_overlaps(df, "reference", "character", "there")
    assert got.columns == ["episode", "speaker", "character", "ordinal", "start", "end", "text", "confidence"]
    want = brute_by_character(rows)
    assert sorted(r["ordinal"] for r in got.collect()) == want
    # part of the rows is settled without a Python step, and part is not
    settled = dedup._contested(df.where("speaker <> ''"), "character").where("not __contested").count()
    assert 20 < settled < len(want)
    assert "FlatMapGroupsInPandas" in got._jdf.queryExecution().toString()


def test_evict_overlaps_of_no_rows_and_nulls(spark):
    schema = "episode string, speaker string, ordinal long, start double, end double, text string, confidence double"
    assert dedup.evict_overlaps(spark.createDataFrame([], schema)).count() == 0
    rows = [("e", "a", 1, None, None, "one", None), ("e", "a", 2, 5.0, 6.0, "one", None), ("e", None, 3, 0.0, 1.0, "x", 1.0), (None, "a", 4, 0.0, 1.0, "two", None), (None, "a", 5, 0.1, 1.0, "three", None), ("e", "a", 6, 9.0, 9.5, None, 1.0)]
    assert sorted(r["ordinal"] for r in dedup.evict_overlaps(spark.createDataFrame(rows, schema)).collect()) == [1, 4]


def test_assign_labels_passes(spark):
    stats = [("c1", 900.0, 5, 90, 100, 0.0), ("c2", 800.0, 5, 90, 100, 0.0), ("c3", 700.0, 5, 90, 100, 0.0), ("c4", 600.0, 5, 90, 100, 0.0), ("c5", 50.0, 5, 90, 100, 0.0), ("c6", 40.0, 5, 1, 100, 0.9), ("c7", 30.0, 5, 1, 100, 0.9), ("c8", 20.0, 5, 1, 100, 0.1)]
    scores = [("c1", "anna", 0.2), ("c1", "ben", 0.01), ("c2", "anna", 0.3), ("c3", "ben", 0.2), ("c3", "cara", 0.04), ("c4", "cara", 0.05), ("c4", "dan", 0.045)]
    s = spark.createDataFrame(stats, "speaker string, total_duration double, episodes int, dialogue int, segments int, theme_ratio double")
    got = {r["speaker"]: r["label"] for r in labeling.assign_labels(spark.createDataFrame(scores, "speaker string, label string, score double"), s, ["anna", "ben", "cara", "dan"]).collect()}
    # c1 wins anna (1); c3 dominates with ben, c4 doesn't (2); c2 takes the next name, c5 is too short for its own (3); 4 for the rest
    assert got == {"c1": "anna", "c2": "cara", "c3": "ben", "c4": "mixed_cluster_c4", "c5": "major_character_unknown_c5", "c6": "narrator", "c7": "theme_song_c7", "c8": "minor_character_c8"}
    notes = {r["speaker"]: r["note"] for r in labeling.assign_labels(spark.createDataFrame(scores, "speaker string, label string, score double"), s, ["anna", "ben", "cara", "dan"]).collect()}
    assert notes["c1"] == "Cluster c1 → anna: content score 0.20, 90 dialogue segments, 15.0min across 5 episodes"
    assert notes["c3"] == "Cluster c3 → ben: DOMINANT in MIXED CLUSTER (others: ben, cara), score 0.20, 90 segments"
    assert notes["c4"] == "Cluster c4 → mixed_cluster_c4: MIXED CLUSTER detected: cara, dan. Manual review required."
    assert notes["c2"] == "Cluster c2 → cara: Fallback assignment (high quality), 90 segments, 13.3min across 5 episodes"
    assert notes["c5"] == "Cluster c5 → major_character_unknown_c5: Unassigned major cluster. Quality too low for fallback assignment."
    assert notes["c6"] == "Cluster c6 → narrator: Likely theme song cluster (90% theme), 0.7min" and notes["c7"] == "Cluster c7 → theme song: additional theme cluster (90% theme), 0.5min"
    assert notes["c8"] == "Cluster c8 → minor character: 1 dialogue segments, manual review needed"
    empty = labeling.assign_labels(spark.createDataFrame([], "speaker string, label string, score double"), s.limit(0), ["anna"])
    assert empty.collect() == []


def test_unique_names_take_the_first_free(spark):
    names = ["a", "a", "a_1", "b_1", "b", "b", "c", "c", "c"]
    df = spark.createDataFrame(list(enumerate(names)), "k long, name string")
    got = [r["unique_name"] for r in transcripts.unique_names(df, "name", "k").orderBy("k").collect()]
    assert got == ["a", "a_1", "a_1_1", "b_1", "b", "b_2", "c", "c_1", "c_2"]


def test_frames_ends(spark):
    row = spark.range(1).selectExpr("array(1D, 2D, 3D, 4D, 5D) AS x").select(S.frames("x", 2, 1).alias("all"), S.frames("x", 2, 1, end_exclusive=True).alias("less"), S.frames("x", 6, 1).alias("none")).first()
    assert row["all"] == [[1, 2], [2, 3], [3, 4], [4, 5]] and row["less"] == [[1, 2], [2, 3], [3, 4]] and row["none"] == []


def test_spectral(spark):
    rate, t = 16000, np.arange(16000) / 16000
    low, high = np.sin(2 * np.pi * 200 * t), np.sin(2 * np.pi * 6000 * t)
    wave = np.where((t * 8).astype(int) % 2 == 0, low, 0.02 * low)
    assert spectral.has_fry_of(wave, rate) and not spectral.has_fry_of(np.tile(low, 4), rate)
    less = spectral.scaled_band(low + high, rate, 0, 1000, 0.5)
    inner = slice(2048, -2048)
    assert np.allclose(less[inner], (0.5 * low + high)[inner], atol=0.02)
    same = spectral.scaled_band(low + high, rate, 0, 1000, 1.0)
    assert np.allclose(same, low + high, atol=1e-6)
    quiet = np.concatenate([np.zeros(8000), low, np.zeros(8000)])
    cut = spectral.trimmed(quiet, rate)
    assert 16000 <= len(cut) <= 16000 + 3 * spectral.WIDTH
    df = spark.createDataFrame([(1, quiet.tolist()), (2, []), (3, None), (4, [0.0] * 100)], "k int, samples array<double>")
    got = {r["k"]: r["t"] for r in df.selectExpr("k", "samples", "16000D AS rate").select("k", spectral.trim_silence(F.col("samples"), F.col("rate")).alias("t")).collect()}
    assert got[1] == cut.tolist() and got[2] == got[3] == got[4] == []


def test_reports_of_nothing(spark):
    none = spark.createDataFrame([], "speaker string, reason string, duration double, snr double, word_count int")
    assert reports.speaker_detail(none).collect() == []
    assert reports.advice(none).first().asDict() == {"n_rejected": 0, "acceptance": 0.0, "advice": ""}
    files_ = spark.createDataFrame([], "passed boolean, score double")
    assert reports.validation_summary(files_).first().asDict() == {"n_files": 0, "n_passed": 0, "n_failed": 0, "mean_score": 0.0}
    history = spark.createDataFrame([("loss", 1, 2.0), ("loss", 2, 1.0), ("loss", 3, 1.0), ("loss", 4, None)], "name string, step int, value double")
    assert reports.best_metrics(history).first().asDict() == {"name": "loss", "lowest": 1.0, "lowest_at": 2, "highest": 2.0, "highest_at": 1, "last": 1.0}


def test_prefix_join_repeats_for_nested_names(spark):
    c = spark.createDataFrame([("s", "ep1_a.wav"), ("s", "ep10_a.wav"), ("s", "ep10_a.mp3")], "speaker string, name string")
    m = spark.createDataFrame([("s", "ep1"), ("s", "ep10"), ("other", "ep1")], "speaker string, episode string")
    assert sorted(tuple(r) for r in clips.clips_of_mapping(c, m).select("episode", "name").collect()) == [("ep1", "ep10_a.wav"), ("ep1", "ep1_a.wav"), ("ep10", "ep10_a.wav")]


SCHEMA = "ts timestamp, speaker string, text string, duration double"


def _streamed(spark, tmp_path, rows, make, mode):
    folder = tmp_path / "in"
    for k, part in enumerate(rows):
        spark.createDataFrame(part, "ts string, speaker string, text string, duration double").selectExpr("cast(ts as timestamp) AS ts", "speaker", "text", "duration").coalesce(1).write.mode("append").json(str(folder))
        if k == 0:
            stream = make(spark.readStream.schema(SCHEMA).json(str(folder)))
    name = f"out_{abs(hash(str(tmp_path)))}"
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    return [r.asDict() for r in spark.table(name).collect()]


def test_streams(spark, tmp_path):
    day = "2024-01-01 "
    rows = [[(day + "10:01:00", "a", "x", 2.0), (day + "10:05:00", "a", "x", 3.0), (day + "10:11:00", "a", "y", 1.0), (day + "10:50:00", "b", "x", 1.0)], [(day + "23:00:00", "z", "end", 0.0)]]
    for k in ("w", "t", "d"):
        (tmp_path / k).mkdir()
    counts = _streamed(spark, tmp_path / "w", rows, turns.window_counts, "append")
    assert {(r["speaker"], r["window_start"].hour * 60 + r["window_start"].minute, r["n"], r["seconds"]) for r in counts} == {("a", 600, 2, 5.0), ("a", 610, 1, 1.0), ("b", 650, 1, 1.0)}
    sessions = _streamed(spark, tmp_path / "t", rows, turns.turns, "append")
    assert {(r["speaker"], r["n"]) for r in sessions} == {("a", 3), ("b", 1)}
    distinct = _streamed(spark, tmp_path / "d", rows, turns.distinct_texts, "append")
    assert sorted((r["speaker"], r["text"]) for r in distinct) == [("a", "x"), ("a", "y"), ("b", "x"), ("z", "end")]


def test_files(spark, tmp_path):
    (tmp_path / "media" / "sub").mkdir(parents=True)
    for name in ("one.MP4", "two.mkv", "sub/three.mp4", "notes.txt"):
        (tmp_path / "media" / name).write_bytes(b"x" * 10)
    found = files.list_files(spark, str(tmp_path / "media"), files.VIDEO)
    assert sorted(r["name"] for r in found.collect()) == ["one.MP4", "three.mp4", "two.mkv"]
    assert files.folder_size(found).first()["files"] == 3
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "ep 1.json").write_text(json.dumps({"duration": 3.0, "segments": [{"start": 0.0, "end": 1.0, "text": "hi", "speaker": None, "confidence": 0.5}, {"start": 1.0, "end": 2.0, "text": "ho"}]}, indent=1))
    rows = files.read_transcripts(spark, str(tmp_path / "t")).orderBy("ordinal").collect()
    assert [(r["episode"], r["text"], r["confidence"]) for r in rows] == [("ep 1", "hi", 0.5), ("ep 1", "ho", None)]
    (tmp_path / "c").mkdir()
    for name, text in (("x.wav.json", "raw"), ("x.json", "done"), ("y.wav.json", "only")):
        (tmp_path / "c" / name).write_text(json.dumps({"text": text}))
    assert {r["stem"]: r["text"] for r in files.read_clip_metadata(spark, str(tmp_path / "c")).collect()} == {"x": "done", "y": "only"}
    (tmp_path / "m.json").write_text(json.dumps({"ep1": {"A": 1, "B": 2}}))
    assert sorted(tuple(r) for r in files.read_mapping(spark, str(tmp_path / "m.json")).collect()) == [("ep1", "A", 1), ("ep1", "B", 2)]
    lines = spark.createDataFrame([("a:x\\y.wav",), ("# no",), ("",), ("none",), ("b: c:d ",)], "value string")
    assert sorted((r["label"], r["path"]) for r in transcripts.parse_references(lines).collect()) == [("a", "x/y.wav"), ("b", "c:d")]
    files.write_lines(spark.createDataFrame([(1, "k", "second"), (0, "k", "first")], "n int, by string, line string"), str(tmp_path / "lines"), "by", ["n"])
    assert [r["value"] for r in spark.read.text(str(tmp_path / "lines" / "by=k")).collect()] == ["first", "second"]


def test_stages(spark, tmp_path):
    one = runner.Stage("one", lambda s, _: s.range(3).selectExpr("id"), lambda df: 8.0)
    two = runner.Stage("two", lambda s, df: df.where("id > 0"), lambda df: 5.0)
    log = runner.run_stages(spark, [one, two], str(tmp_path))
    assert log.done[:1] == ["one"] and log.scores["two"] == 5.0
    again = runner.run_stages(spark, [one], str(tmp_path))
    assert again.skipped == ["one"]


def test_vocals_file_by_pattern(spark):
    names = {"a": ["a_Vocals.wav", "a_(Vocals)_model.wav", "zz Vocals.wav"], "b": ["x b y Vocals.wav", "b_Vocals.wav"], "c": ["Vocals c.wav", "_c_Vocals_.wav"], "d": ["Vocals d.wav", "d.wav"], "e": ["e_vocals.wav", "e_(Vocals).mp3"], "f[1]": ["f[1]_(Vocals).wav", "f1_(Vocals).wav"]}
    rows = [(s, n, f"{s}/{n}") for s, some in names.items() for n in some]
    got = {r["stem"]: r["path"].split("/", 1)[1] for r in clips.vocals_file(spark.createDataFrame(rows, "stem string, name string, path string")).collect()}
    assert got == {"a": "a_(Vocals)_model.wav", "b": "b_Vocals.wav", "c": "_c_Vocals_.wav", "d": "Vocals d.wav", "f[1]": "f[1]_(Vocals).wav"}


def test_main_voices_weigh_less_in_short_clusters(spark):
    stats = [("a", 60.0, 2, 90, 100, 0.0), ("b", 50.0, 8, 90, 100, 0.0), ("c", 40.0, 4, 90, 100, 0.0)]
    scores = [("a", "anna", 0.15), ("b", "ben", 0.15), ("c", "anna", 0.15), ("c", "ben", 0.1)]
    s = spark.createDataFrame(stats, "speaker string, total_duration double, episodes int, dialogue int, segments int, theme_ratio double")
    t = spark.createDataFrame(scores, "speaker string, label string, score double")
    label = lambda main: {r["speaker"]: r["label"] for r in labeling.assign_labels(t, s, ["anna", "ben"], main=main).collect()}
    assert label(()) == {"a": "anna", "b": "ben", "c": "mixed_cluster_c"}
    # a: 0.15 * (0.5 + 0.5 * 0.5 * 0.5) is under 0.1, and no name is left for its turn; in c anna still leads
    assert label(("anna",)) == {"a": "minor_character_a", "b": "ben", "c": "anna"}


def test_numbers_over_a_whole_table(spark):
    rows = [(k * 7919 % 1000, f"s{k % 3}") for k in range(1000)]
    df = spark.createDataFrame(rows, "k int, s string").repartition(13)
    got = ordering.numbered(df, [F.col("s"), F.desc("k")], "place").orderBy("place").collect()
    assert [(r["s"], r["k"]) for r in got] == sorted(((s, k) for k, s in rows), key=lambda x: (x[0], -x[1])) and [r["place"] for r in got] == list(range(1, 1001))
    assert ordering.numbered(df.where("false"), ["k"], "place").count() == 0


def test_first_texts(spark):
    rows = [(1, "x", "A"), (2, "x", "a"), (3, "y", "a"), (4, None, "a"), (5, None, "A"), (6, "x", None), (7, "x", None)]
    got = dedup.first_texts(spark.createDataFrame(rows, "i int, g string, t string"), "g", "t", "i")
    assert got.columns == ["i", "g", "t"] and sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [rows[k] for k in (0, 2, 3, 5)]
