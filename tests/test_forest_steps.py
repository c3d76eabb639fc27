"""M2, M3: what the forest does for every row, at size."""

import numpy as np
from pyspark.sql import functions as F

from seclake.config import DEFAULT, MODEL_FEATURES
from seclake.operators import forest


def frame(spark, n=3000):
    return spark.range(n).select(F.col("id").alias("log_id"), *[F.pmod(F.xxhash64("id", F.lit(c)), F.lit(17)).cast("int").alias(c) for c in MODEL_FEATURES])


def test_draw_by_its_definition(spark):
    """Each tree has the rows with the smallest hashes of (seed, tree, row); no lambda runs over the trees row by row."""
    feats = frame(spark)
    chosen, psi = forest.sample_for_trees(feats)
    assert psi == DEFAULT.max_samples and "lambda" not in chosen._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.tree_id, r["_key"]): (r.h, list(r.x)) for r in chosen.collect()}
    assert len(got) == DEFAULT.trees * psi
    x = {r.log_id: [float(r[c]) for c in MODEL_FEATURES] for r in feats.collect()}
    for tree in (0, 7, DEFAULT.trees - 1):
        h = feats.select("log_id", forest._unit_hash(F.lit(DEFAULT.seed), F.lit(tree), F.col("log_id")).alias("h")).orderBy("h", "log_id").limit(psi).collect()
        assert {k: v for (t, k), v in got.items() if t == tree} == {r.log_id: (r.h, x[r.log_id]) for r in h}


def test_rows_are_walked_in_blocks(monkeypatch):
    draw = np.random.default_rng(2)
    import pandas as pd
    nodes = []
    for t in range(20):
        parts = forest.build_tree(draw.normal(size=(64, 4)), draw, 6)
        nodes.append(pd.DataFrame(dict(zip(("feature", "threshold", "left", "right", "size"), parts))).assign(tree_id=t).assign(node_id=lambda d: range(len(d))))
    model = forest.Forest.from_nodes(pd.concat(nodes), 64)
    x = draw.normal(size=(1025, 4))
    whole, seen, walk = model._walk(x), [], forest.Forest._walk
    monkeypatch.setattr(forest.Forest, "_walk", lambda self, part: (seen.append(len(part)), walk(self, part))[1])
    assert (model.score_samples(x) == whole).all()
    assert sum(seen) == 1025 and max(seen) <= forest.WALK_ROWS and min(seen) > 1
    assert model.score_samples(x[:1]).shape == (1,) and (model.score_samples(x[:2]) == whole[:2]).all()
