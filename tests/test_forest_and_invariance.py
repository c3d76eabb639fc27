
import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake.config import MODEL_FEATURES
from seclake.operators import forest
from seclake.plans import detection
from seclake.sources import fixtures


def test_planted_outliers_rank_lowest(spark):
    rng = np.random.default_rng(0)
    normal = rng.normal(0, 1, size=(2000, len(MODEL_FEATURES)))
    outliers = rng.normal(0, 1, size=(10, len(MODEL_FEATURES))) + 12
    data = np.vstack([normal, outliers])
    rows = [(i, *map(float, x)) for i, x in enumerate(data)]
    df = spark.createDataFrame(rows, "log_id long, " + ", ".join(f"{c} double" for c in MODEL_FEATURES))
    fitted = forest.fit(df)
    scored = forest.score(df, fitted, "s").orderBy("s").limit(10).select("log_id").collect()
    assert {r.log_id for r in scored} == set(range(2000, 2010))


def test_contamination_flags_three_percent(spark):
    an = detection.analyze(fixtures.raw_logs(spark, SF_SMALL), model="forest")
    n, a = an.agg(F.count("*"), F.sum("is_anomaly")).first()
    assert n == 1000 and 25 <= a <= 35


def _run(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    raw = fixtures.raw_logs(spark, SF_SMALL).repartition(parts)
    an = detection.analyze(raw, model="forest")
    return sorted((r.log_id, r.failed_last_10min, r.ip_subnet_enc, round(r.anomaly_score_raw, 9), r.total_threat_score)
                  for r in an.collect())


def test_same_answer_at_1_and_8_partitions(spark):
    try:
        assert _run(spark, 1) == _run(spark, 8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_vectorised_walk_equals_naive_traversal():
    import math

    import pandas as pd
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 4))
    frames = []
    for t in range(7):
        feat, thr, left, right, size = forest.build_tree(data[rng.choice(300, 64, replace=False)],
                                                         np.random.default_rng(t), 6)
        frames.append(pd.DataFrame({"tree_id": t, "node_id": range(len(size)), "feature": feat, "threshold": thr,
                                    "left": left, "right": right, "size": size}))
    nodes = pd.concat(frames)
    f = forest.Forest.from_nodes(nodes, 64, features=("a", "b", "c", "d"))
    x = rng.normal(size=(50, 4))
    fast = f.score_samples(x)
    c = forest.avg_path_length([64])[0]
    for i, row in enumerate(x):
        total = 0.0
        for t, tree in nodes.groupby("tree_id"):
            tree = tree.set_index("node_id")
            node, depth = 0, 0
            while tree.loc[node, "left"] >= 0:
                node = tree.loc[node, "left"] if row[tree.loc[node, "feature"]] <= tree.loc[node, "threshold"] \
                    else tree.loc[node, "right"]
                depth += 1
            total += depth + forest.avg_path_length([tree.loc[node, "size"]])[0]
        assert math.isclose(fast[i], -2 ** (-(total / 7) / c), rel_tol=1e-12)


def test_saved_model_scores_like_fit_and_score(spark, scratch):
    from seclake.operators import anomaly
    from seclake.session import materialize
    raw = fixtures.raw_logs(spark, SF_SMALL)
    feats = materialize(detection.features_of(raw), "saved-model-features")
    nodes, psi = forest.fit_nodes(feats)
    nodes = materialize(nodes, "saved-model-nodes")
    scored = forest.score(feats, forest.Forest.from_nodes(nodes.toPandas(), psi), "s")
    forest.save(nodes, psi, anomaly.score_offset(scored, "s"), scratch + "/model")
    cols = ["log_id", "anomaly_score_raw", "is_anomaly", "total_threat_score", "final_risk_level"]
    saved = detection.analyze(raw, model="saved", saved=forest.load(spark, scratch + "/model")).select(*cols)
    fitted = detection.analyze(raw, model="forest").select(*cols)
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, fitted.collect()))
