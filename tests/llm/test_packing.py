"""Packing: exact boundaries over very many lengths, batches that follow from the rows alone, very many copies."""

from collections import Counter

import numpy as np

from voxloom.llm import packing


def padding(lengths, counts, ends):
    at = np.searchsorted(ends, lengths)
    return int((np.asarray(ends)[at] * counts - lengths * counts).sum())


def test_boundaries_over_more_lengths_than_any_grid():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.choice(np.arange(1, 3_000_000), 300_000, False))
    counts = rng.integers(1, 1_000, len(lengths)) * (1 + 10_000_000 // lengths)
    ends = packing.optimal_boundaries(lengths, counts, 4)
    best = padding(lengths, counts, ends)
    place = np.searchsorted(lengths, ends)
    for k in range(3):
        for step in (-1000, -1, 1, 1000):
            moved = place.copy()
            moved[k] += step
            assert padding(lengths, counts, lengths[moved]) >= best
    # a boundary on a grid, as an approximation would have it, costs no less
    for unit in (12, 100):
        grid = -(-lengths // unit) * unit
        values, where = np.unique(grid, return_inverse=True)
        rounded = packing.optimal_boundaries(values, np.bincount(where, counts).astype(np.int64), 4)
        assert padding(lengths, counts, rounded) >= best


def test_boundaries_against_every_choice():
    """Four buckets over 30 lengths by a plain table of all splits."""
    rng = np.random.default_rng(6)
    for _ in range(20):
        lengths, counts = np.sort(rng.choice(np.arange(1, 500), 30, False)), rng.integers(1, 50, 30)
        waste = lambda a, b: int(((lengths[b - 1] - lengths[a:b]) * counts[a:b]).sum())  # noqa: B023, E731
        least = {0: 0}
        for _ in range(4):
            least = {b: min(least[a] + waste(a, b) for a in least if a < b) for b in range(1, 31) if any(a < b for a in least)} | {0: 0}
        assert padding(lengths, counts, packing.optimal_boundaries(lengths, counts, 4)) == least[30]


def test_batches_do_not_follow_the_partitioning(spark):
    rows = [(k % 150, "w " * (k % 40)) for k in range(300)] + [(None, None), (None, ""), (7, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(map(tuple, packing.assign_batches(df, 4, 200).collect()))
    assert Counter(map(tuple, packing.assign_batches(df.repartition(7), 4, 200).collect())) == want
    assert sum(want.values()) == len(rows)


def test_copies_beyond_a_piece_fill_batches(spark):
    n = 2 * packing.COPIES + 5
    copies = spark.range(n).selectExpr("1L as doc_id", "'a b c' as text", "id as rank")
    rest = spark.range(500).selectExpr("id + 10 as doc_id", "repeat('v ', cast(id % 3 as int)) as text", "id as rank")
    got = packing.assign_batches(copies.unionByName(rest), 2, 40).collect()
    assert len(got) == n + 500 and sum(r["doc_id"] == 1 for r in got) == n
    assert len({(r["batch_id"], r["slot"]) for r in got}) == len(got)
    sizes = Counter((r["batch_id"], r["bucket"]) for r in got)
    assert all(m * b <= 40 for (_, b), m in sizes.items())
    short = Counter(b for (_, b), m in sizes.items() if m < 40 // b)
    assert max(short.values(), default=0) <= 1
