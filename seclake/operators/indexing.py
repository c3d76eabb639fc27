"""Exact, distributed dense index of a sorted set of values.

``sorted(distinct(values))`` → 0..n-1 without a single-partition window:
range-partition the distinct values, number rows inside each partition
with ``monotonically_increasing_id`` (partition id in the high bits, local
position in the low bits), and add the count of all earlier partitions.
The per-partition count table has one row per partition, so it is
broadcast with a fixed size bound. The numbered values are written once
to the checkpoint folder so counts and offsets describe the same split
(range bounds are sampled, so a second evaluation could split differently).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, partitions_for


def dense_index(df: DataFrame, col: str, out: str, partitions: int | None = None) -> DataFrame:
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    n_parts = partitions_for(values, partitions)
    ranged = (values.repartitionByRange(n_parts, col).sortWithinPartitions(col)
              .select(col, F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    local = materialize(ranged.select(col, "_pid", (F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
                                      .alias("_local")), "dense-index")
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", (F.sum("_n").over(w) - F.col("_n")).alias("_offset"))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(col, (F.col("_offset") + F.col("_local")).cast("int").alias(out)))


def row_numbers(df: DataFrame, order: list, out: str, partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order (``order`` must break all ties),
    distributed the same way as ``dense_index``: range partitions, local
    numbering, per-partition offsets."""
    n_parts = partitions_for(df, partitions)
    ranged = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    cols = df.columns
    local = materialize(ranged.select(*cols, F.spark_partition_id().alias("_pid"),
                                      (F.monotonically_increasing_id()
                                       - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)).alias("_local")),
                        "row-numbers")
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", (F.sum("_n").over(w) - F.col("_n")).alias("_offset"))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(*cols, (F.col("_offset") + F.col("_local") + 1).alias(out)))
