"""Exact top-k by inner product with vector-approximation files.

Every vector is also held as 8-bit cells of a per-dimension grid (bounds fitted over all vectors,
never on a sample). Queries go out in blocks of bounded size; a task scans the cells of its
vectors for bounds on each score and reads exact vectors in order of their bounds until no unread
one can reach the kth score found so far. Tasks return k rows a query; a grouped ranking
merges them.

Edge cases: vectors that are null, empty or hold a null or non-finite component take no part;
vectors of different lengths never meet; of rows repeating a query id one is the query (the least
vector) and none with that id is a candidate; equal scores go to the smaller id, and rows that
repeat a candidate id each keep a place; an empty table gives an empty result; more columns are ignored. Scores are summed as
64-bit integers, exact while components stay within 2^53 and their products' sum within 2^63, the range of the result's type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.workspace import Workspace

LEVELS = 255
QUERY_BLOCK = 2048
CHUNK_ROWS = 4096
NONE = -np.iinfo(np.int64).max


def integer_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, dim, vec array<double>): floor(scale * component), only for vectors that take part."""
    x = F.transform(F.col("embedding"), lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad")).where("vec_id is not null and x is not null and size(x) > 0 and not bad")
    return kept.select("vec_id", F.size("x").alias("dim"), F.transform("x", lambda e: F.floor(e * scale).cast("double")).alias("vec"))


def grid_bounds(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and greatest value of each dimension, by vector length, over all vectors: rows in proportion to dimensions only."""
    rows = vectors.select("dim", F.posexplode("vec").alias("pos", "x")).groupBy("dim", "pos").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("dim", "pos").collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["dim"], []).append((r["lo"], r["hi"]))
    return {d: tuple(np.array(b, float).T) for d, b in out.items()}


def with_cells(vectors: DataFrame, bounds: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """vectors plus `cells`, a byte a dimension: the approximation file."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs, cells = batch.column("dim").to_pylist(), batch.column("vec"), []
            for i, d in enumerate(dims):
                lo, hi = bounds[d]
                step = np.where(hi > lo, (hi - lo) / LEVELS, 1.0)
                cells.append(np.minimum(LEVELS - 1, np.floor((np.asarray(vecs[i].values) - lo) / step)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], [*batch.schema.names, "cells"])

    return vectors.mapInArrow(encode, "vec_id long, dim int, vec array<double>, cells binary")


class _Best:
    """The k best (score, -id) of every query so far, over all batches of a task."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray, k: int):
        self.ids, self.exact, self.k = ids, exact, k
        # exact scores are integers; bounds may round, by less than their slack
        self.whole = exact.astype(np.int64)
        self.scores = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.read = 0

    def scan(self, ids: np.ndarray, cells: np.ndarray, vecs: np.ndarray, lo: np.ndarray, step: np.ndarray) -> None:
        # a component of cell c lies in lo + [c, c + 1] * step, with a thousandth for the rounding of cell borders:
        # one product for all cells, and a width and a margin for sums in floating point that are the query's alone
        scaled = self.exact * step
        width = 1.001 * np.maximum(scaled, 0).sum(1) - 0.001 * np.minimum(scaled, 0).sum(1)
        margin = 1e-12 * (np.abs(self.exact) @ np.abs(lo) + 2 * LEVELS * np.abs(scaled).sum(1))
        top = scaled @ cells.astype(float).T + (self.exact @ lo + width + margin)[:, None]
        for q in range(len(self.ids)):
            order = np.flatnonzero(top[q] >= self.scores[q, -1])
            order = order[np.argsort(-top[q, order], kind="stable")]
            at, size = 0, 4 * self.k
            while at < len(order) and top[q, order[at]] >= self.scores[q, -1]:
                part = order[at : at + size]
                part = part[ids[part] != self.ids[q]]
                self.read += len(part)
                s = np.concatenate([self.scores[q], vecs[part].astype(np.int64) @ self.whole[q]])
                n = np.concatenate([self.found[q], ids[part]])
                best = np.lexsort((n, -s))[: self.k]
                self.scores[q], self.found[q] = s[best], n[best]
                at, size = at + size, size * 2


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose id is divisible by `every`."""
    with Workspace(embeddings.sparkSession, "vafile") as ws:
        vectors = ws.table(integer_vectors(embeddings, scale), "vectors")
        bounds = grid_bounds(vectors)
        approx = ws.table(with_cells(vectors, bounds), "cells")
        queries = approx.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("vec", "dim")).alias("q")).select("vec_id", "q.*")
        queries = ws.table(queries.withColumn("part", F.lit(0)), "queries")
        total = queries.count()
        blocks = max(1, -(-total // block))
        queries = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        found = None
        for b in range(blocks):
            rows = queries.where(F.col("part") == b).select("vec_id", "dim", "vec").collect()
            if rows:
                local = _scan_block(approx, rows, bounds, k)
                found = local if found is None else found.unionAll(local)
        if found is None:
            found = embeddings.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ws.keep(ranked.select("query_id", "rank", "vec_id", "score"))


def _scan_block(approx: DataFrame, rows: list, bounds: dict, k: int) -> DataFrame:
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(r["dim"], []).append((r["vec_id"], r["vec"]))
    asked = {d: (np.array([i for i, _ in v], np.int64), np.array([x for _, x in v], float)) for d, v in by_dim.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: _Best(*q, k) for d, q in asked.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in set(dims.tolist()) & best.keys():
                lo, hi = bounds[d]
                step = np.where(hi > lo, (hi - lo) / LEVELS, 1.0)
                own = np.flatnonzero(dims == d)
                for at in range(0, len(own), CHUNK_ROWS):
                    part = batch.take(pa.array(own[at : at + CHUNK_ROWS]))
                    vecs = np.asarray(part.column("vec").flatten()).reshape(-1, d)
                    cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, d)
                    best[d].scan(part.column("vec_id").to_numpy(), cells, vecs, lo, step)
        for d, x in best.items():
            real = x.scores != NONE
            which = np.nonzero(real)[0]
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[which]), pa.array(x.found[real]), pa.array(x.scores[real])], ["query_id", "vec_id", "score"])

    return approx.mapInArrow(scan, "query_id long, vec_id long, score long")
