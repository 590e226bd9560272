"""Packing of documents into batches by optimal length buckets.

A global histogram of lengths (words plus one end token) is counted on Spark; dynamic programming
over it picks the bucket boundaries with the least padding when every document is padded to its
bucket's boundary. Inside a bucket, documents are ranked and cut into batches of at most
`budget` padded tokens. Ranks come from bounded groups plus their offsets, so no bucket, however
large, meets in one task; rows equal in id and text are one counted row until their ranks are known.

The program is exact whatever the lengths. The driver holds the histogram alone: d distinct lengths need
d (d + 1) / 2 tokens in all, so a corpus of t tokens has at most sqrt(2 t) of them, 6.4 million for 20 trillion
tokens, in arrays of some 60 bytes and BUCKETS choices of 4 bytes each.

Edge cases: null and empty texts have the end token only (length 1); a document longer than the
budget has a batch to itself; repeated rows are packed each; the order inside a
bucket is a shuffle by the hash of id and text, the same however the table is partitioned;
an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.workspace import Workspace

BUDGET = 65_536
BUCKETS = 16
GROUP_ROWS = 20_000
# copies of one row dealt out together
COPIES = 10_000


def token_count(text: str = "text"):
    """Words [^\\x20\\x09-\\x0D]+ plus the end token."""
    trimmed = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"^[\x20\x09-\x0D]+", "")
    return (F.size(F.split(trimmed, r"[\x20\x09-\x0D]+", -1)) + F.when(trimmed.rlike(r"[\x20\x09-\x0D]$") | (trimmed == ""), 0).otherwise(1)).cast("long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most `buckets` buckets over sorted distinct lengths with the least total padding.

    Padding of (i, j] is L_j (C_j - C_i) - (S_j - S_i), so a layer is a lower envelope of lines
    queried at growing L_j: exact, in time proportional to buckets x lengths.
    """
    n = len(lengths)
    if not n:
        return []
    # 8 bytes each; read as integers of any size, so that products are exact
    length, number, tokens = (array("q", np.concatenate([[0], x]).astype(np.int64).tobytes()) for x in (lengths, np.cumsum(counts), np.cumsum(np.multiply(lengths, counts, dtype=np.int64))))
    infinite = float("inf")
    cost, choices = [0] + [infinite] * n, []
    for _ in range(min(buckets, n)):
        new, chosen, hull, head = [infinite] * (n + 1), array("i", bytes(4 * (n + 1))), [], 0
        new[0] = 0
        for j in range(1, n + 1):
            i = j - 1
            if cost[i] < infinite:
                m, b = -number[i], cost[i] + tokens[i]
                while len(hull) - head >= 2:
                    (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                    if (b - b1) * (m1 - m2) <= (b2 - b1) * (m1 - m):
                        hull.pop()
                    else:
                        break
                hull.append((m, b, i))
            x = length[j]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                head += 1
            if len(hull) > head:
                m, b, i = hull[head]
                new[j], chosen[j] = m * x + b + x * number[j] - tokens[j], i
        choices.append(chosen)
        cost = new
        if cost[n] == 0:
            break
    ends, j = [], n
    for chosen in reversed(choices):
        if j == 0:
            break
        ends.append(length[j])
        j = chosen[j]
    return ends[::-1]


def histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n_tokens, sorted, and how many documents have each."""
    counted = lengths.groupBy("n_tokens").agg(F.sum("copies").alias("n")).toArrow()
    values, counts = (counted.column(c).to_numpy() for c in ("n_tokens", "n"))
    order = np.argsort(values)
    return values[order].astype(np.int64), counts[order].astype(np.int64)


def assign_batches(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, n_tokens, bucket, batch_id, slot) for every row of docs.

    bucket: padded length; batch_id: `<bucket>-<number>`; slot: place within the batch, from 0.
    """
    with Workspace(docs.sparkSession, "packing") as ws:
        shuffled = F.xxhash64("doc_id", F.xxhash64(F.col("text").cast("string")), F.lit(9))
        lengths = docs.select("doc_id", token_count().alias("n_tokens"), shuffled.alias("shuffled"))
        lengths = ws.table(lengths.groupBy("doc_id", "n_tokens", "shuffled").agg(F.count("*").alias("copies")), "lengths")
        values, counts = histogram(lengths)
        ends = optimal_boundaries(values, counts, buckets)
        held = {e: int(counts[(values <= e) & (values > b)].sum()) for b, e in zip([0, *ends], ends, strict=False)}
        bucket, groups, room = F.lit(None).cast("long"), F.lit(1), F.lit(1)
        for e in reversed(ends):
            inside = F.col("n_tokens") <= e
            bucket = F.when(inside, F.lit(e).cast("long")).otherwise(bucket)
            groups = F.when(inside, F.lit(max(1, -(-held[e] // GROUP_ROWS)))).otherwise(groups)
            room = F.when(inside, F.lit(max(1, budget // e))).otherwise(room)
        placed = lengths.select("doc_id", "n_tokens", "copies", bucket.alias("bucket"), room.cast("long").alias("room"), F.pmod(F.col("shuffled"), groups.cast("long")).alias("grp"), "shuffled")
        before = Window.partitionBy("bucket", "grp").orderBy("shuffled", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
        ranked = placed.withColumn("place", F.coalesce(F.sum("copies").over(before), F.lit(0)))
        sizes = placed.groupBy("bucket", "grp").agg(F.sum("copies").alias("n"))
        offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
        first = ranked.join(offsets, ["bucket", "grp"]).select("doc_id", "n_tokens", "bucket", "room", "shuffled", "copies", (F.col("before") + F.col("place")).alias("first"))
        # copies become rows again: pieces of COPIES of them are dealt over the tasks before they do
        pieces = first.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))).alias("piece")).repartition("shuffled", "piece")
        copy = F.explode(F.sequence(F.col("piece") * COPIES, F.least(F.col("copies"), (F.col("piece") + 1) * COPIES) - 1))
        rows = pieces.select("doc_id", "n_tokens", "bucket", "room", "first", copy.alias("copy")).withColumn("rank", F.col("first") + F.col("copy"))
        return ws.keep(
            rows.select(
                "doc_id",
                "n_tokens",
                "bucket",
                F.concat_ws("-", F.col("bucket").cast("string"), F.floor(F.col("rank") / F.col("room")).cast("string")).alias("batch_id"),
                F.pmod(F.col("rank"), F.col("room")).cast("int").alias("slot"),
            )
        )
