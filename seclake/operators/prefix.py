"""Exact running sum over a global order without a single-partition window.

Rows are range-partitioned on the order key, sorted inside each
partition, summed with a partition-local running total (``mapInPandas``
keeps a carry across Arrow batches) and shifted by the total of all
earlier partitions (a table of one row per partition, broadcast).
Range partitioning splits a hot time span across tasks like any other,
so a burst of events cannot pile into one task.

The partition-local result is written once to the checkpoint folder:
range bounds come from sampling, so two evaluations of the same plan may
split the rows differently, and the per-partition totals must describe
exactly the partitions the running totals were computed on.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, partitions_for


def running_sum(df: DataFrame, order_cols: list[str], value_col: str, out: str,
                partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n_parts = partitions_for(df, partitions)
    ranged = (df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local", T.LongType())])

    def local_cumsum(batches):
        carry = 0
        for pdf in batches:
            vals = pdf[value_col].fillna(0).astype("int64")
            cs = vals.cumsum() + carry
            if len(cs):
                carry = int(cs.iloc[-1])
            yield pdf.assign(_local=cs.astype("int64"))

    local = materialize(ranged.mapInPandas(local_cumsum, schema), "running-sum")
    totals = local.groupBy("_pid").agg(F.sum(value_col).cast("bigint").alias("_tot"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select("_pid", (F.sum("_tot").over(w) - F.col("_tot")).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid", "left")
            .withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local"))
            .drop("_pid", "_local", "_off"))
