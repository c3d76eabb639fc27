"""Nearest neighbours through a hash-bucket index (V4 for large corpora).

``retrieval.knn`` compares every query with every row and stays the default. Here a row is compared only with
the queries that look into one of its buckets:

* A table's bucket number has one bit per random direction: on which side of the sample's median the vector lies. Tables have
  directions of their own. Medians come from a sample of about ``SAMPLE_ROWS`` rows drawn by a hash of the row; every row is indexed.
* The number of tables, up to ``MAX_TABLES``, is the smallest with which ``TUNING_QUERIES`` rows of the sample find the share ``TARGET`` of their nearest rows in
  the sample. Neighbours in a sample are farther than those among all rows, so the whole table's recall is rather higher.
* A query looks into its own bucket of each table and into those next to it: the ones whose differing bits have the smallest margins.
* What the buckets hold is verified by its exact distance; ties go to the smaller id.

Equal vectors are indexed once, with their ``k`` smallest ids, so a vector that a third of all rows share is one
entry. A search deals vectors to parts of ``CELL_ROWS`` and queries to groups of ``CELL_QUERIES``; no task holds more than one part and one
group at a time, and the buckets meet inside it. So a vector travels once for each group, not once for each table, and a query once for each part, not once for each probe.
Where there are more groups than tables or more parts than probes, ``by_bucket`` sends both to their buckets in place of that, large buckets dealt to parts of ``PART_ROWS`` and
groups of ``QUERY_GROUP``: what travels for a row is bounded by the tables and probes, whatever the number of rows. Null vectors take no part; vectors have one length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize
from .retrieval import TOP_K, _sq_l2

SAMPLE_ROWS = 20_000
MAX_TABLES = 64
PROBES = 16
TARGET = 0.95
TUNING_QUERIES = 200
BUCKET_ROWS = 1024
PART_ROWS = 4096
QUERY_GROUP = 512
#: Vectors and queries in a cell of ``by_part``. Smaller tables have ``PARTS`` parts, so that there is work for many tasks, unless a part would get fewer rows than ``LEAST_ROWS``.
CELL_ROWS = 32_768
CELL_QUERIES = 8192
PARTS = 24
LEAST_ROWS = 1024
#: Rows, and queries, that a cell works on at a time.
BATCH = 128
MAX_BITS = 24
#: Of the bits with the smallest margins, so many take part in the choice of neighbouring buckets.
NEAR_BITS = 8


@dataclass
class Index:
    directions: np.ndarray  # tables x bits x dimensions
    medians: np.ndarray     # tables x bits
    probes: int = PROBES

    def _sides(self, x: np.ndarray) -> np.ndarray:
        """Rows x tables x bits: how far on the upper side of each median."""
        return np.einsum("nd,tbd->ntb", x, self.directions) - self.medians

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Rows x tables: the table's number above the bits of the bucket."""
        tables, bits = self.medians.shape
        return ((self._sides(x) > 0) @ (1 << np.arange(bits, dtype=np.int64))) + (np.arange(tables, dtype=np.int64) << 32)

    def looks(self, x: np.ndarray) -> np.ndarray:
        """Rows x (tables * probes): the buckets a query looks into, its own first."""
        sides = self._sides(x)
        tables, bits = self.medians.shape
        near = min(bits, NEAR_BITS)
        order = np.argsort(np.abs(sides), axis=2)[:, :, :near]
        margins = np.take_along_axis(np.abs(sides), order, axis=2)
        flips = [c for size in range(0, 4) for c in combinations(range(near), size)]
        cost = np.stack([margins[:, :, list(c)].sum(axis=2) if c else np.full(margins.shape[:2], -1.0) for c in flips], axis=2)
        masks = np.stack([(np.int64(1) << order[:, :, list(c)].astype(np.int64)).sum(axis=2) if c else np.zeros(order.shape[:2], dtype=np.int64) for c in flips], axis=2)
        best = np.argsort(cost, axis=2, kind="stable")[:, :, :self.probes]
        return (self.buckets(x)[:, :, None] ^ np.take_along_axis(masks, best, axis=2)).reshape(len(x), -1)

    def column(self, vector: Column, spark, looks: bool = False) -> Column:
        shared = spark.sparkContext.broadcast(self)  # tables x bits x dimensions numbers

        def run(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            x = np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])
            return pd.Series(list(shared.value.looks(x) if looks else shared.value.buckets(x)))
        return F.pandas_udf(run, T.ArrayType(T.LongType()))(vector)


def fit(corpus: DataFrame, vec_col: str = "embedding", tables: int | None = None, probes: int = PROBES, bucket_rows: int = BUCKET_ROWS, sample_rows: int = SAMPLE_ROWS,
        k: int = 10, target: float = TARGET, seed: int = 42) -> Index:
    """An index for ``corpus``: as many bits as bring a bucket to about ``bucket_rows`` rows, as many tables as the sample asks for (or ``tables``)."""
    rows = corpus.select(F.col(vec_col).alias("v")).where("v is not null")
    n = rows.count()
    bits = min(MAX_BITS, max(1, math.ceil(math.log2(max(n, 2) / bucket_rows))))
    drawn = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "v", F.monotonically_increasing_id()), 11) / F.lit(float(1 << 53))).where(F.col("h") < min(1.0, sample_rows / max(n, 1)))
    sample = [np.asarray(r["v"], dtype=np.float64) for r in drawn.orderBy("h").select("v").collect()]  # about sample_rows
    if not sample:
        return Index(np.zeros((1, bits, 1)), np.zeros((1, bits)), probes)
    x = np.vstack(sample)
    directions = np.random.default_rng(seed).standard_normal((tables or MAX_TABLES, bits, x.shape[1]))
    medians = np.stack([np.median(x @ d.T, axis=0) for d in directions])
    return Index(directions, medians, probes) if tables else tuned(x, directions, medians, probes, k, target)


def tuned(x: np.ndarray, directions: np.ndarray, medians: np.ndarray, probes: int, k: int, target: float) -> Index:
    """The first tables, as many as find the share ``target`` of the ``k`` nearest rows of some of ``x``."""
    asked = x[:TUNING_QUERIES]
    apart = _sq_l2(x, asked)
    nearest = np.argsort(apart, axis=0, kind="stable")[:k].T
    seen = np.zeros(nearest.shape, dtype=bool)
    for t in range(len(directions)):
        one = Index(directions[t:t + 1], medians[t:t + 1], probes)
        bucket, looks = one.buckets(x)[:, 0], one.looks(asked)
        seen |= (bucket[nearest][:, :, None] == looks[:, None, :]).any(axis=2)
        if seen.mean() >= target:
            break
    return Index(directions[:t + 1], medians[:t + 1], probes)


def entries(corpus: DataFrame, index: Index, k: int = TOP_K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The index table ``bucket, v, ids``: each distinct vector in its bucket of each table, with its ``k`` smallest ids."""
    rows = corpus.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("v is not null")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k)
    distinct = first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return distinct.select(F.explode(index.column(F.col("v"), corpus.sparkSession)).alias("bucket"), "v", "ids")


def save(corpus: DataFrame, index: Index, path: str, k: int = TOP_K, **cols) -> None:
    """Writes the index table, sorted by bucket within files so that a probe's filter skips row groups."""
    entries(corpus, index, k, **cols).repartition("bucket").sortWithinPartitions("bucket").write.mode("overwrite").parquet(path)


def _found(asked: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("q", asked.schema["q"].dataType), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("distance", T.DoubleType())])


def _spread(name: str, n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1)).alias(name)


def _by_first_id(near: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors by rising first id, so that ties go to the smaller one."""
    order = np.argsort(np.array([x[0] for x in near["ids"]]), kind="stable")
    return near["ids"].to_numpy()[order], np.vstack([np.asarray(v, dtype=np.float64) for v in near["v"]])[order]


def by_part(rows: DataFrame, asked: DataFrame, index: Index, k: int, parts: int, groups: int) -> DataFrame:
    """``q, ids, distance``: for each query the ``k`` nearest vectors of each part, among those in the buckets it looks into. Every part meets every group in one cell, which works out their buckets anew."""
    shared = asked.sparkSession.sparkContext.broadcast(index)
    left = asked.select("q", "qv", F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int").alias("g"), _spread("p", F.lit(parts)))
    right = rows.select("v", "ids", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int").alias("p"), _spread("g", F.lit(groups)))

    def best(some: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(near):
            return pd.DataFrame({"q": [], "ids": pd.Series([], dtype=object), "distance": []})
        ids, x = _by_first_id(near)
        held = np.concatenate([shared.value.buckets(x[i:i + BATCH]) for i in range(0, len(x), BATCH)])
        order = [np.argsort(column, kind="stable") for column in held.T]
        held = [column[o] for column, o in zip(held.T, order)]
        columns = np.ascontiguousarray(x.T)
        out = []
        for i in range(0, len(some), BATCH):
            asking = np.vstack([np.asarray(v, dtype=np.float64) for v in some["qv"][i:i + BATCH]])
            looks = shared.value.looks(asking).reshape(len(asking), len(held), -1)
            seen = np.zeros((len(asking), len(x)), dtype=bool)
            for t, (column, o) in enumerate(zip(held, order)):
                first, last = (np.searchsorted(column, looks[:, t].ravel(), side) for side in ("left", "right"))
                size = last - first
                at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
                seen[np.repeat(np.arange(len(asking)).repeat(looks.shape[2]), size), o[at]] = True
            for j, row in enumerate(seen):
                row = np.flatnonzero(row)
                apart = np.zeros(len(row))
                for column, c in zip(columns, asking[j]):  # in dimension order, as the exact path does
                    diff = column[row] - c
                    apart += diff * diff
                apart = np.round(apart, 6)
                at = np.argsort(apart, kind="stable")[:k]
                out.append((some["q"].iloc[i + j], row[at], apart[at]))
        return pd.DataFrame({"q": [q for q, row, _ in out for _ in row], "ids": list(ids[np.concatenate([row for _, row, _ in out])]), "distance": np.concatenate([d for _, _, d in out])})

    return left.groupBy("p", "g").cogroup(right.groupBy("p", "g")).applyInPandas(best, _found(asked))


def by_bucket(table: DataFrame, asked: DataFrame, index: Index, k: int) -> DataFrame:
    """As ``by_part``, with every vector and query sent to each of its buckets."""
    looks = materialize(asked.select("q", "qv", F.explode(index.column(F.col("qv"), asked.sparkSession, looks=True)).alias("bucket")), "looks")
    probed = looks.groupBy("bucket").agg(F.ceil(F.count("*") / QUERY_GROUP).cast("int").alias("groups"))
    rows = materialize(table.join(probed, "bucket"), "probed")
    parts = rows.groupBy("bucket").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))

    # Every part of a bucket meets every group of its queries in one cell.
    left = (looks.join(parts, "bucket").join(probed, "bucket")
            .withColumn("g", F.pmod(F.xxhash64("q"), F.col("groups")).cast("int")).select("bucket", "g", "q", "qv", _spread("p", F.col("parts"))))
    right = rows.join(parts, "bucket").withColumn("p", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).select("bucket", "p", "v", "ids", _spread("g", F.col("groups")))

    def best(some: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(near):
            return pd.DataFrame({"q": [], "ids": pd.Series([], dtype=object), "distance": []})
        ids, x = _by_first_id(near)
        apart = np.round(_sq_l2(x, np.vstack([np.asarray(v, dtype=np.float64) for v in some["qv"]])), 6).T
        out = [(q, at, d[at]) for q, d in zip(some["q"], apart) for at in [np.argsort(d, kind="stable")[:k]]]
        at = np.concatenate([a for _, a, _ in out])
        return pd.DataFrame({"q": [q for q, a, _ in out for _ in a], "ids": list(ids[at]), "distance": np.concatenate([d for _, _, d in out])})

    return left.groupBy("bucket", "p", "g").cogroup(right.groupBy("bucket", "p", "g")).applyInPandas(best, _found(asked))


def search(table: DataFrame, queries: DataFrame, index: Index, k: int = TOP_K, id_col: str = "vec_id", qid_col: str = "query_id", qvec_col: str = "query_vec") -> DataFrame:
    """``(query_id, id, distance, rank)`` as ``retrieval.knn`` gives, among the rows in the buckets probed. ``table``: from ``entries`` or ``save``."""
    asked = queries.select(F.col(qid_col).alias("q"), F.col(qvec_col).alias("qv")).where("qv is not null")
    # Every vector is in one bucket of the first table.
    rows = materialize(table.where(F.col("bucket") < F.lit(1 << 32)).select("v", "ids"), "vectors")
    n = rows.count()
    parts, groups = max(1, -(-n // CELL_ROWS), min(PARTS, n // LEAST_ROWS)), max(1, -(-asked.count() // CELL_QUERIES))
    tables = len(index.medians)
    found = by_bucket(table, asked, index, k) if groups > tables or parts > max(PARTS, tables * index.probes) else by_part(rows, asked, index, k, parts, groups)
    # The same row may be found in several tables. Equal distances of different vectors keep all their ids until here.
    hits = found.select("q", "distance", F.explode("ids").alias("id")).distinct()
    w = Window.partitionBy("q").orderBy("distance", "id")
    ranked = hits.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(qid_col), F.col("id").alias(id_col), "distance", "rank")


def recall(found: DataFrame, exact: DataFrame, id_col: str = "vec_id", qid_col: str = "query_id") -> float:
    """The share of the exact neighbours that were found; a row as near as the last exact one counts, whichever id it has."""
    last = exact.groupBy(qid_col).agg(F.max("distance").alias("reach"), F.count("*").alias("wanted"))
    got = found.join(last, qid_col).where(F.col("distance") <= F.col("reach")).groupBy(qid_col).agg(F.count("*").alias("got"))
    both = last.join(got, qid_col, "left").agg(F.sum(F.least(F.coalesce("got", F.lit(0)), "wanted")), F.sum("wanted")).first()
    return both[0] / both[1] if both[1] else 1.0
