"""Connected components by alternating large-star and small-star steps on DataFrames.

The published two-step scheme: each step links every node to the least node of its neighbourhood;
edges shrink to stars after few rounds. Least nodes come from partial aggregates; the join that
moves a node's neighbours is dealt out by SPREAD parts of every node, so a node with a third of all
edges is met in several tasks. Each round is written to the shared folder, so lineage stays flat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.workspace import Workspace

SPREAD = 8


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v. large: each node's greater neighbours move to its least one."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        # a node that is its own least keeps its neighbours: such edges, hot centres among them, need no join
        moved = both.where("v > u").withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SPREAD)))
        spread = least.where("m < u").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
        moved = moved.join(spread, ["u", "part"], "left").select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v"))
    else:
        moved = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def connected_components(ws: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of edges (a, b); component is the least node it reaches."""
    now = ws.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), f"{name}-0")
    state = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))))
    before, step = now.select(state).first()[0], 0
    while before[0]:
        step += 1
        after = ws.table(_starred(_starred(now, True), False), f"{name}-{step}")
        mark = after.select(state).first()[0]
        ws.drop(f"{name}-{step - 1}")
        now = after
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
