"""The bounds of the vector search: never under a true score, and near enough to leave most vectors unread."""

import numpy as np

from voxloom.llm import vafile


def scanned(vecs, queries, k=10):
    lo, hi = vecs.min(0), vecs.max(0)
    step = np.where(hi > lo, (hi - lo) / vafile.LEVELS, 1.0)
    cells = np.minimum(vafile.LEVELS - 1, np.floor((vecs - lo) / step)).astype(np.uint8)
    best = vafile._Best(np.arange(len(queries)) + 10**9, queries, k)
    ids = np.arange(len(vecs))
    for at in range(0, len(vecs), 500):
        best.scan(ids[at : at + 500], cells[at : at + 500], vecs[at : at + 500], lo, step)
    return best


def test_search_is_exact_and_reads_few():
    rng = np.random.default_rng(3)
    # products of the largest scale still sum to less than 2^63
    for scale, d in ((1024, 48), (2**26, 5), (1, 16)):
        vecs = np.floor(rng.normal(size=(4000, d)) * scale)
        vecs[:, 0] = np.floor(scale * 0.5)
        vecs[100:160] = vecs[7]
        queries = vecs[::200].copy()
        best = scanned(vecs, queries)
        exact = vecs.astype(np.int64).astype(object) @ queries.T.astype(np.int64).astype(object)
        for q in range(len(queries)):
            order = sorted(range(len(vecs)), key=lambda i: (-exact[i, q], i))[:10]
            assert best.found[q].tolist() == order and best.scores[q].tolist() == [exact[i, q] for i in order]
        if scale == 1024:
            assert best.read < 0.1 * len(vecs) * len(queries)
