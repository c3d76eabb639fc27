"""Readers for the input tables (one parquet dataset per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base: str, name: str, balance: bool = False) -> DataFrame:
    """Read one table. ``balance``: a scan with fewer splits than the
    cluster's default parallelism (a file of one large row group) is spread
    with one round-robin repartition, so heavy per-row Python work runs on
    every core. A table with enough splits is read as is. Off by default:
    for built-in expressions the extra shuffle costs more than it saves."""
    path = os.path.join(base, f"{name}.parquet")
    if not os.path.exists(path) and os.path.exists(os.path.join(base, name)):
        path = os.path.join(base, name)
    df = spark.read.parquet(path)
    if balance:
        target = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < target:
            df = df.repartition(target)
    return df
