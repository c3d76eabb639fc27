"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seclake.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``. A null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(n))


def unit_hash(*cols, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the column values alone, so that a
    row is drawn alike in every run, partitioning and retried task."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column has that name (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` of the given tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def local_components(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges ``a``-``b``,
    going on from ``label`` (a result of this function over earlier edges)."""
    label = np.arange(n) if label is None else label
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up
    return label


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges(a, b)`` of long ids, as
    ``(node, root)`` with the smallest id reached for every node but the roots.

    Alternates the large-star and the small-star step until the edges no
    longer change. Each round is written to the checkpoint folder, which cuts
    the lineage. No node's neighbours are gathered: the steps are a grouped
    minimum and a join on the node, whose hot keys partial aggregation and
    skew splitting take care of.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x and y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(down.select("u", F.col("m").alias("v"))).distinct())
        now = materialize(small, "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
