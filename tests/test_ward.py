"""Ward's tree in rounds against the textbook form, one smallest merge at a time."""

import itertools

import numpy as np
import pytest

from voxloom.operators import cluster, ward
from voxloom.scratch import shared_folder

SCHEMA = "vec_id long, speaker string, embedding array<double>"


def textbook(points):
    """(members, members, height) of each merge in order."""
    live = {i: ([i], np.array(p, float)) for i, p in points.items()}
    out = []
    while len(live) > 1:
        h, a, b = min((np.sqrt(2 * len(x) * len(y) / (len(x) + len(y)) * ((u - v) ** 2).sum()), i, j) for (i, (x, u)), (j, (y, v)) in itertools.combinations(sorted(live.items()), 2))
        (x, u), (y, v) = live[a], live.pop(b)
        out.append((sorted(x), sorted(y), h))
        live[a] = (x + y, (u * len(x) + v * len(y)) / (len(x) + len(y)))
    return out


def parts(merges, ids, k):
    groups = {i: frozenset([i]) for i in ids}
    for x, y, _ in merges[: len(ids) - k]:
        whole = frozenset(x) | frozenset(y)
        groups |= {i: whole for i in whole}
    return {*groups.values()}


@pytest.mark.parametrize("block, last", [(9, 0), (1024, 30), (1024, 256)])
def test_same_tree_and_cuts(spark, block, last):
    rng = np.random.default_rng(3)
    points = {int(i) * 3 + 1: (rng.normal(size=5) + 4 * (i % 4)).tolist() for i in rng.permutation(70)}
    table = spark.createDataFrame([(i, f"s{i % 9}", p) for i, p in points.items()], SCHEMA)
    folder = shared_folder(spark, "ward")
    merges = ward.ward_merges(table, folder, block, last)
    want = textbook(points)
    assert np.allclose(sorted(r["height"] for r in merges.collect()), [h for _, _, h in want])
    # far fewer rounds than merges
    assert merges.agg({"round": "max"}).first()[0] < 20
    for k in (1, 4, 70, 90) if last else (2, 9):
        got = {}
        for r in ward.cut(table, merges, k, f"{folder}/cut-{k}").collect():
            got.setdefault(r["cluster_id"], set()).add(r["vec_id"])
        assert {frozenset(x) for x in got.values()} == parts(want, list(points), min(k, 70)) and sorted(got) == list(range(min(k, 70)))
        assert [min(got[c]) for c in sorted(got)] == sorted(min(x) for x in got.values())


def test_equal_vectors_and_small_tables(spark):
    rows = [(i, "s", [float(i // 5), 0.0]) for i in range(20)] + [(None, "s", [1.0, 1.0]), (99, "s", None)]
    got = {}
    for r in ward.ward(spark.createDataFrame(rows, SCHEMA), 4).collect():
        got.setdefault(r["cluster_id"], set()).add(r["vec_id"])
    assert list(map(sorted, (got[k] for k in sorted(got)))) == [list(range(k, k + 5)) for k in (0, 5, 10, 15)]
    assert ward.ward(spark.createDataFrame([], SCHEMA), 3).count() == 0
    assert [tuple(r) for r in ward.ward(spark.createDataFrame([(5, "s", [1.0])], SCHEMA), 3).collect()] == [(5, 0)]
    with pytest.raises(ValueError):
        ward.ward(spark.createDataFrame(rows, SCHEMA), 0)


def test_algorithms(spark):
    table = spark.createDataFrame([(i, f"s{i}", [float(i % 6 * 10), float(i // 6)]) for i in range(30)], SCHEMA)
    assert cluster.cluster_voices(table, "hierarchical", expected=8).select("cluster_id").distinct().count() == cluster.estimated_clusters(30, 8) == 10
    assert cluster.cluster_voices(table, "hierarchical", clusters=6).select("cluster_id").distinct().count() == 6
    assert [cluster.estimated_clusters(s, e) for s, e in ((0, 0), (100, 7), (12, 7), (100, 20))] == [4, 10, 5, 18]
    with pytest.raises(ValueError, match="kmeans"):
        cluster.cluster_voices(table, "kmeans")


def test_searches_only_who_lost_its_neighbour(spark, monkeypatch):
    """Rounds after the first search for new clusters and for those whose neighbour merged, with the textbook's tree, ties included."""
    rng = np.random.default_rng(8)
    points = {i: rng.normal(size=6).tolist() for i in range(80)} | {100 + i: [20.0 * (i == k) for k in range(6)] for i in range(6)}
    table = spark.createDataFrame([(i, "s", p) for i, p in points.items()], SCHEMA)
    searched, before = [], ward._nearest
    monkeypatch.setattr(ward, "_nearest", lambda now, blocks: searched.append((now.count(), now.where("near is null").count())) or before(now, blocks))
    folder = shared_folder(spark, "ward")
    merges = ward.ward_merges(table, folder, 40, 8)
    want = textbook(points)
    assert np.allclose(sorted(r["height"] for r in merges.collect()), [h for _, _, h in want])
    assert searched[0] == (86, 86) and all(n > s > 0 for n, s in searched[2:])
    # before: every cluster in every round
    assert sum(s for _, s in searched) < 0.8 * sum(n for n, _ in searched)
    got = {}
    for r in ward.cut(table, merges, 6, f"{folder}/cut").collect():
        got.setdefault(r["cluster_id"], set()).add(r["vec_id"])
    assert {frozenset(x) for x in got.values()} == parts(want, list(points), 6)
