"""Clusters of voice embeddings and their roll-ups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.blocks import block_count, block_pairs, matrix, tiles
from voxloom.operators.ordering import numbered
from voxloom.operators.ward import ward
from voxloom.scratch import delete, shared_folder, stored


def _vectors(vectors: DataFrame, block: int | None = None) -> tuple[DataFrame, int]:
    """(id, v) of vectors that are there, and the number of blocks they go to."""
    rows = vectors.where("embedding is not null").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    return rows, block_count(count, width, block)


def _close(m: np.ndarray, rows: np.ndarray, columns: np.ndarray, eps: float) -> np.ndarray:
    return 1 - m[rows] @ m[columns].T <= eps


def _group(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches)


def neighbours(vectors: DataFrame, eps: float, block: int | None = None) -> DataFrame:
    """(a, b) with 1 - dot <= eps, both directions and itself: exact, by blocks of vectors against blocks, a tile's pairs at a time."""
    rows, blocks = _vectors(vectors, block)

    def near(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _group(batches)
        side, ids, m = np.asarray(group.column("block")), np.asarray(group.column("id")), matrix(group.column("v"))
        for left, right in tiles(key, side):
            a, b = np.nonzero(_close(m, left, right, eps))
            x, y = ids[left][a], ids[right][b]
            if left[0] != right[0]:
                x, y = np.concatenate([x, y]), np.concatenate([y, x])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return block_pairs(rows, blocks).groupBy("i", "j").applyInArrow(near, "a long, b long")


def _degrees(rows: DataFrame, blocks: int, eps: float) -> DataFrame:
    """(id, n): the number of neighbours, itself included."""

    def count(key: tuple, group: pa.Table) -> pa.Table:
        side, m = np.asarray(group.column("block")), matrix(group.column("v"))
        n = np.zeros(len(side), np.int64)
        for left, right in tiles(key, side):
            close = _close(m, left, right, eps)
            n[left] += close.sum(axis=1)
            if left[0] != right[0]:
                n[right] += close.sum(axis=0)
        return pa.table({"id": group.column("id"), "n": pa.array(n)}).filter(pa.array(n > 0))

    return block_pairs(rows, blocks).groupBy("i", "j").applyInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots of all places once those of a and b are linked; parent holds roots, each the least of its set."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def _links(rows: DataFrame, blocks: int, eps: float) -> DataFrame:
    """(a, b): in every group each row and the least one that neighbours lead to there, so no more rows than vectors that travel."""

    def joined(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(group.column("id")), kind="stable")
        side, ids, m = np.asarray(group.column("block"))[order], np.asarray(group.column("id"))[order], matrix(group.column("v"))[order]
        parent = np.arange(len(ids))
        for left, right in tiles(key, side):
            a, b = np.nonzero(_close(m, left, right, eps))
            parent = _joined(parent, left[a], right[b])
        moved = parent != np.arange(len(ids))
        return pa.table({"a": pa.array(ids[moved], pa.int64()), "b": pa.array(ids[parent[moved]], pa.int64())})

    return block_pairs(rows, blocks).groupBy("i", "j").applyInArrow(joined, "a long, b long")


def _bordering(rows: DataFrame, blocks: int, eps: float) -> DataFrame:
    """(id, cluster) of rows (id, v, cluster) without a cluster: the least one of their neighbours."""

    def least(key: tuple, group: pa.Table) -> pa.Table:
        side, m = np.asarray(group.column("block")), matrix(group.column("v"))
        inner = group.column("cluster").is_valid().to_numpy(zero_copy_only=False).astype(bool)
        none = np.iinfo(np.int32).max
        cluster = group.column("cluster").fill_null(none).to_numpy().astype(np.int32)
        best = np.full(len(side), none, np.int32)
        for left, right in tiles(key, side):
            for outer, core in ((left, right), (right, left))[: 1 if left[0] == right[0] else 2]:
                outer, core = outer[~inner[outer]], core[inner[core]]
                if len(outer) and len(core):
                    best[outer] = np.minimum(best[outer], np.where(_close(m, outer, core, eps), cluster[core][None, :], none).min(axis=1))
        return pa.table({"id": group.column("id"), "cluster": pa.array(best, pa.int32())}).filter(pa.array(best < none))

    return block_pairs(rows, blocks).groupBy("i", "j").applyInArrow(least, "id long, cluster int").groupBy("id").agg(F.min("cluster").alias("cluster"))


def dbscan(vectors: DataFrame, eps: float = 0.25, min_samples: int = 5) -> DataFrame:
    """(vec_id, cluster_id) by density: clusters numbered by their least core id, border points to the least cluster, noise -1.

    Pairs of neighbours are counted, linked and looked up inside the groups that find them, in three passes; none is kept.
    """
    spark = vectors.sparkSession
    folder = shared_folder(spark, "density")
    rows, blocks = _vectors(vectors)
    degrees = stored(_degrees(rows, blocks, eps), f"{folder}/degrees")
    core = degrees.where(F.col("n") >= min_samples).select("id")
    found = _links(rows.join(core, "id", "left_semi"), blocks, eps).distinct()
    own = core.select(F.col("id").alias("a"), F.col("id").alias("b"))
    links = stored(found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionAll(own), f"{folder}/links")
    labels, step = core.select("id", F.col("id").alias("label")), 0
    while True:
        # least label of the linked, then a jump to that label's own label: rounds grow with the log of the diameter
        near = links.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("label"))
        jumped = near.join(near.select(F.col("id").alias("label"), F.col("label").alias("next")), "label", "left").select("id", F.least("label", F.coalesce("next", "label")).alias("label"))
        new = stored(jumped, f"{folder}/labels-{step}")
        changed = new.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old").limit(1).count()
        delete(spark, f"{folder}/labels-{step - 1}")
        labels, step = new, step + 1
        if not changed:
            break
    # a row for each cluster
    in_order = numbered(labels.select("label").distinct(), ["label"], "cluster").withColumn("cluster", (F.col("cluster") - 1).cast("int"))
    inner = labels.join(in_order, "label").select("id", "cluster")
    # what has no neighbour takes no part
    inner = stored(inner, f"{folder}/inner")
    met = rows.join(degrees.select("id"), "id", "left_semi").join(inner, "id", "left")
    border = _bordering(met, blocks, eps)
    return vectors.select(F.col("vec_id").alias("id")).join(inner.unionAll(border), "id", "left").select(F.col("id").alias("vec_id"), F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster_id"))


def cluster_stats(rows: DataFrame, by: str = "cluster_id") -> DataFrame:
    """Per cluster: size, seconds, distinct episodes and speakers, mean quality; noise left out."""
    return rows.where(F.col(by).cast("string") != "-1").groupBy(by).agg(F.count("*").alias("segments"), F.sum("duration").alias("total_duration"), F.count_distinct("episode").alias("episodes"), F.count_distinct("speaker").alias("speakers"), F.avg("quality").alias("quality"))


def centroids(rows: DataFrame, by: str = "cluster_id") -> DataFrame:
    """(cluster, pos, x): mean of every component, by partial aggregation."""
    return rows.select(by, F.posexplode("embedding").alias("pos", "x")).groupBy(by, "pos").agg(F.avg("x").alias("x"))


def cluster_quality(stats: DataFrame, seconds: float = 30.0, episodes: int = 3, segments: int = 10) -> DataFrame:
    """One row: clusters, hours, mean size, good clusters and their rate."""
    good = (F.col("total_duration") >= seconds) & (F.col("episodes") >= episodes) & (F.col("segments") >= segments)
    return stats.agg(F.count("*").alias("clusters"), (F.sum("total_duration") / 3600).alias("hours"), F.avg("segments").alias("mean_size"), F.count_if(good).alias("good"), F.coalesce(F.try_divide(F.count_if(good).cast("double"), F.count("*")), F.lit(0.0)).alias("good_rate"))


def representatives(rows: DataFrame, by: str = "cluster_id", most: int = 5) -> DataFrame:
    """Up to `most` samples by quality: the two best, then only ones of an episode not seen yet."""
    order = [F.desc("quality"), F.asc("vec_id")]
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))).withColumn("ep_rn", F.row_number().over(Window.partitionBy(by, "episode").orderBy(*order)))
    kept = ranked.where("rn <= 2 or ep_rn = 1").withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy("rn")))
    return kept.where(F.col("place") <= most).select(by, "place", "vec_id", "episode", "quality")


def last_mapping(rows: DataFrame) -> DataFrame:
    """(episode, speaker, cluster_id): the last row of each pair wins; noise left out."""
    return rows.where("cluster_id <> -1").groupBy("episode", "speaker").agg(F.max_by("cluster_id", "vec_id").alias("cluster_id"))


def apply_labels(mapping: DataFrame, labels: DataFrame) -> DataFrame:
    """Mapping with the label of each cluster, `cluster_<id>` where there is none."""
    return mapping.join(labels, "cluster_id", "left").withColumn("label", F.coalesce("label", F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string"))))


def estimated_clusters(speakers: int, expected: int) -> int:
    """Number of clusters to cut a tree into, from the distinct speakers and the number of voices aimed at."""
    return max(4, expected - 2, min(speakers // 3, expected + 3, 12))


def cluster_voices(vectors: DataFrame, algorithm: str = "dbscan", eps: float = 0.25, min_samples: int = 5, clusters: int | None = None, expected: int = 0) -> DataFrame:
    """(vec_id, cluster_id) by density or by Ward's tree; without a number of clusters that is estimated. Another algorithm is an error."""
    if algorithm == "dbscan":
        return dbscan(vectors, eps, min_samples)
    if algorithm == "hierarchical":
        return ward(vectors, clusters or estimated_clusters(vectors.select("speaker").distinct().count(), expected))
    raise ValueError(f"unsupported clustering algorithm: {algorithm}")
