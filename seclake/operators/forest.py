"""Isolation forest on Spark (M1–M6), after Liu, Ting & Zhou (2008).

* Sampling (M2): each tree draws its own rows from all rows. A row enters a
  tree's draw if the hash of ``(seed, tree, log_id)`` falls below about
  ``DRAW × ψ / rows``, and the tree keeps the ψ smallest hashes. That is a
  narrow filter and never depends on the partition layout, so the fit is
  the same at any partitioning.
* Building (M2): ``groupBy(tree_id).applyInPandas`` — one task per tree,
  ψ rows each; numpy random splits (random feature, uniform threshold,
  height limit ⌈log2 ψ⌉; constant features are skipped).
* Scoring (M3): the node table (≤ trees × (2^(h+1) − 1) rows, a fixed
  bound) is collected once and shipped with the function; a vectorised
  ``mapInPandas`` walks all trees level by level over Arrow batches.
  score = −2^(−E[h(x)] / c(ψ)), lower = more abnormal.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, MODEL_FEATURES, DetectionConfig

DRAW = 2.0  # rows that a tree draws, in multiples of ψ; fewer than ψ would take a 16σ miss
WALK_ROWS = 512
EULER_GAMMA = 0.5772156649015329
_U53 = float(1 << 53)

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()),
])


def avg_path_length(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def feature_vector(cols=MODEL_FEATURES):
    """M1: the model features as one array<double> column."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def _unit_hash(*cols):
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(_U53))


def build_tree(rows: np.ndarray, rng: np.random.Generator, height_limit: int):
    """One isolation tree over ``rows`` (n × d) → node arrays."""
    feature, threshold, left, right, size = [], [], [], [], []

    def new_node(n):
        feature.append(-1); threshold.append(0.0); left.append(-1); right.append(-1); size.append(n)
        return len(size) - 1

    root = new_node(len(rows))
    stack = [(root, np.arange(len(rows)), 0)]
    while stack:
        node, idx, depth = stack.pop()
        if depth >= height_limit or len(idx) <= 1:
            continue
        sub = rows[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(hi > lo)
        if candidates.size == 0:
            continue
        f = int(candidates[rng.integers(candidates.size)])
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        l_idx, r_idx = idx[go_left], idx[~go_left]
        if l_idx.size == 0 or r_idx.size == 0:
            continue
        ln, rn = new_node(l_idx.size), new_node(r_idx.size)
        feature[node], threshold[node], left[node], right[node] = f, thr, ln, rn
        stack.append((rn, r_idx, depth + 1))
        stack.append((ln, l_idx, depth + 1))
    return feature, threshold, left, right, size


@dataclass
class Forest:
    """All trees as flat arrays over global node ids (tree × width + node).

    Leaves point to themselves with threshold +inf, so a walk needs no
    branch on leafness; ``leaf_value`` holds depth + c(size) of each leaf.
    """
    feature: np.ndarray    # int64 per node (0 at leaves)
    threshold: np.ndarray  # float64 per node (+inf at leaves)
    child: np.ndarray      # int64, 2 per node: [left, right]
    leaf_value: np.ndarray
    roots: np.ndarray
    max_samples: int
    height: int
    features: tuple = MODEL_FEATURES

    @classmethod
    def from_nodes(cls, nodes: pd.DataFrame, max_samples: int, features=MODEL_FEATURES) -> "Forest":
        trees = int(nodes["tree_id"].max()) + 1
        width = int(nodes["node_id"].max()) + 1
        total = trees * width
        t = nodes["tree_id"].to_numpy(dtype=np.int64)
        n = nodes["node_id"].to_numpy(dtype=np.int64)
        gid = t * width + n
        feat = np.zeros(total, dtype=np.int64)
        thr = np.full(total, np.inf)
        child = np.repeat(np.arange(total, dtype=np.int64), 2)
        left = nodes["left"].to_numpy(dtype=np.int64)
        right = nodes["right"].to_numpy(dtype=np.int64)
        inner = left >= 0
        feat[gid[inner]] = nodes["feature"].to_numpy(dtype=np.int64)[inner]
        thr[gid[inner]] = nodes["threshold"].to_numpy()[inner]
        child[2 * gid[inner]] = t[inner] * width + left[inner]
        child[2 * gid[inner] + 1] = t[inner] * width + right[inner]
        # depth of every node: parents come before children in node order
        depth = np.zeros(total)
        order = np.argsort(gid, kind="stable")
        for g, l_, r_ in zip(gid[order], left[order], right[order]):
            if l_ >= 0:
                base = (g // width) * width
                depth[base + l_] = depth[g] + 1
                depth[base + r_] = depth[g] + 1
        size = np.zeros(total)
        size[gid] = nodes["size"].to_numpy(dtype=np.float64)
        leaf_value = depth + avg_path_length(size)
        height = max(1, math.ceil(math.log2(max(max_samples, 2))))
        return cls(feat, thr, child, leaf_value, np.arange(trees, dtype=np.int64) * width, max_samples, height,
                   tuple(features))

    def score_samples(self, x: np.ndarray) -> np.ndarray:
        """Vectorised over rows and trees: −2^(−mean path / c(ψ)). About ``WALK_ROWS`` rows at a time, so that what a level touches stays in the processor's cache."""
        return np.concatenate([self._walk(part) for part in np.array_split(x, max(1, -(-len(x) // WALK_ROWS)))])

    def _walk(self, x: np.ndarray) -> np.ndarray:
        b, d = x.shape
        flat = np.ascontiguousarray(x, dtype=np.float64).ravel()
        row_base = (np.arange(b, dtype=np.int64) * d)[None, :]
        node = np.broadcast_to(self.roots[:, None], (self.roots.size, b)).copy()
        for _ in range(self.height):
            val = flat[row_base + self.feature[node]]
            node = self.child[2 * node + (val > self.threshold[node])]
        mean = self.leaf_value[node].mean(axis=0)
        return -np.power(2.0, -mean / avg_path_length([self.max_samples])[0])


def sample_for_trees(feats: DataFrame, cfg: DetectionConfig = DEFAULT, key: str = "log_id",
                     rows: int | None = None) -> tuple[DataFrame, int]:
    """M2 sampling → rows ``(tree_id, h, x)`` with at most ψ rows per tree."""
    n = feats.count() if rows is None else rows
    psi = int(min(cfg.max_samples, max(n, 1)))
    below = min(1.0, DRAW * psi / max(n, 1))
    # Every row meets every tree in generated code; the features are put together for drawn rows alone.
    per_tree = (feats.select(F.col(key).alias("_key"), *MODEL_FEATURES, F.explode(F.lit(list(range(cfg.trees)))).alias("tree_id"))
                .withColumn("h", _unit_hash(F.lit(cfg.seed), F.col("tree_id"), F.col("_key"))).where(F.col("h") < F.lit(below))
                .select("_key", feature_vector().alias("x"), "tree_id", "h"))
    w = Window.partitionBy("tree_id").orderBy("h", "_key")
    chosen = per_tree.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= psi)
    return chosen.select("tree_id", "h", "_key", "x"), psi


def fit_nodes(feats: DataFrame, cfg: DetectionConfig = DEFAULT, rows: int | None = None) -> tuple[DataFrame, int]:
    """M2: node table DataFrame (lazy) and ψ."""
    chosen, psi = sample_for_trees(feats, cfg, rows=rows)
    height = max(1, math.ceil(math.log2(max(psi, 2))))
    seed = cfg.seed

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "_key"], kind="mergesort")
        tree_id = int(pdf["tree_id"].iloc[0])
        rows = np.vstack(pdf["x"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 1))
        rng = np.random.default_rng([seed, tree_id])
        feat, thr, left, right, size = build_tree(rows, rng, height)
        return pd.DataFrame({"tree_id": tree_id, "node_id": np.arange(len(size), dtype=np.int32),
                             "feature": np.asarray(feat, dtype=np.int32), "threshold": np.asarray(thr),
                             "left": np.asarray(left, dtype=np.int32), "right": np.asarray(right, dtype=np.int32),
                             "size": np.asarray(size, dtype=np.int64)})

    return chosen.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA), psi


def fit(feats: DataFrame, cfg: DetectionConfig = DEFAULT, rows: int | None = None) -> Forest:
    """M2/M6: fit on these rows. The node table has a fixed size bound
    (trees × 511 rows), so collecting it to ship with the scorer is safe."""
    nodes, psi = fit_nodes(feats, cfg, rows=rows)
    return Forest.from_nodes(nodes.toPandas(), psi)


@dataclass
class SavedModel:
    """M6: what scoring new rows needs: the trees, ψ, the features in order, and the offset."""
    forest: Forest
    offset: float | None


def save(nodes: DataFrame, psi: int, offset: float | None, path: str, features: tuple = MODEL_FEATURES) -> None:
    """The node table and one row with ψ, the features and the offset."""
    spark = nodes.sparkSession
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(psi, list(features), offset)], "max_samples int, features array<string>, offset double") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load(spark, path: str) -> SavedModel:
    model = spark.read.parquet(f"{path}/model").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()  # at most trees × (2^(h+1) − 1) rows
    return SavedModel(Forest.from_nodes(nodes, model["max_samples"], tuple(model["features"])), model["offset"])


def score(feats: DataFrame, forest: Forest, out: str = "anomaly_score") -> DataFrame:
    """M3: append the score column. A scalar pandas UDF: only the feature
    columns travel to Python (Arrow batches); the rest of the row stays in
    the JVM projection."""
    cols = list(forest.features)

    @F.pandas_udf(T.DoubleType())
    def iso_score(*series: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(dtype=np.float64, na_value=0.0) for s in series])
        return pd.Series(forest.score_samples(x) if len(x) else np.zeros(0))

    return feats.withColumn(out, iso_score(*[F.col(c).cast("double") for c in cols]))


def walk(feats: DataFrame, nodes: DataFrame, psi: int, features: tuple = MODEL_FEATURES, key: str = "log_id") -> DataFrame:
    """The score by its definition, on the node table alone: ``key, walked, leaves`` (the number of trees that the row reached a leaf of). Each row stands at every tree's
    root and moves down by one join a level. For checks and for explaining single scores; ``score`` is the fast path."""
    def c(size):  # average path length of ``size`` rows
        harmonic = F.log(size - 1.0) + F.lit(float(np.euler_gamma))
        return F.when(size <= 1, 0.0).when(size == 2, 1.0).otherwise(2.0 * harmonic - 2.0 * (size - 1.0) / size)

    at = F.broadcast(nodes.select("tree_id", F.col("node_id").alias("at"), "feature", "threshold", "left", "right", "size"))  # at most trees x (2^(h+1) - 1) rows
    trees = nodes.select("tree_id").distinct()
    rows = feats.select(key, F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]).alias("x"))
    ids = F.array(*[F.lit(r["tree_id"]) for r in trees.orderBy("tree_id").collect()])
    here = rows.select(key, "x", F.explode(ids).alias("tree_id"), F.lit(0).alias("at"), F.lit(0).alias("depth"))
    for _ in range(max(1, math.ceil(math.log2(max(psi, 2))))):
        stood = here.join(at, ["tree_id", "at"])
        inner = F.col("left") >= 0
        below = F.when(F.element_at("x", F.greatest(F.col("feature"), F.lit(0)) + 1) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        here = stood.select(key, "x", "tree_id", F.when(inner, below).otherwise(F.col("at")).alias("at"), (F.col("depth") + inner.cast("int")).alias("depth"))
    ends = here.join(at, ["tree_id", "at"]).where("left < 0").groupBy(key).agg(F.avg(F.col("depth") + c(F.col("size").cast("double"))).alias("mean"), F.count("*").alias("leaves"))
    return ends.select(key, (-F.pow(F.lit(2.0), -F.col("mean") / c(F.lit(float(psi))))).alias("walked"), "leaves")
