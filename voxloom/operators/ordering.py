"""Row numbers over a whole table without one task that sorts it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.scratch import shared_folder, stored


def numbered(rows: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """rows with `name`: their place from 1 on by order, which must tell all rows apart.

    Rows are range-partitioned and sorted; a row's place is that in its partition after the sizes of those before,
    and only the sizes reach the driver. The sorted rows are written once, so both are of one partitioning.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    kept = stored(ranged, shared_folder(rows.sparkSession, "numbered"))
    # the id's upper bits are the partition, its lower 33 the place in it
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    before, sizes = 0, []
    for r in sorted(kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        sizes.append((r["part"], before))
        before += r["n"]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(sizes, "__part long, __before long"))
    joined = kept.withColumn("__part", part.cast("long")).join(offsets, "__part")
    return joined.withColumn(name, F.col("__before") + place + 1).drop("__part", "__before", "__at")
