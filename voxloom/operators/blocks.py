"""All pairs of vectors by pairs of blocks, a group each.

A vector travels to as many groups as there are blocks. So blocks are few and large: PARTS share the work of a table until a block
would hold over VALUES components, which bounds the memory of a group. Inside a group, tiles of TILE rows by TILE rows are
compared, so no table of all its pairs exists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 8
# 32 MB of doubles
VALUES = 1 << 22
TILE = 1024


def block_count(rows: int, width: int, block: int | None = None) -> int:
    """Number of blocks of so many vectors of so many components; `block` sets the rows of one."""
    if block:
        return max(1, -(-rows // block))
    return max(1, min(PARTS, -(-rows // TILE)), -(-rows * width // VALUES))


def block_pairs(rows: DataFrame, blocks: int) -> DataFrame:
    """rows (id, v, ...) with (i, j, block): one copy for every pair of blocks that its own belongs to."""
    own = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    each = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return each.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A row a vector."""
    flat = pa.concat_arrays([x.flatten() for x in column.chunks]) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column.flatten() if isinstance(column, pa.Array) else pa.array([], pa.float64())
    values = flat.to_numpy(zero_copy_only=False)
    if len(column) and len(values) % len(column):
        raise ValueError("vectors differ in length")
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def tiles(key: tuple, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows and of columns of each tile in order. Within one block these are the tiles on and above the diagonal; the former have the same rows and columns."""
    left, right = (np.flatnonzero(side == k.as_py()) for k in key)
    same = key[0].as_py() == key[1].as_py()
    for r in range(0, len(left), TILE):
        for k in range(r if same else 0, len(right), TILE):
            yield left[r : r + TILE], right[k : k + TILE]
