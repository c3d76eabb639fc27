"""The detection run: raw_logs → analyzed_logs.

``analyze`` chains the lazy operators; only the model needs actions (the
forest fit collects a bounded node table, the offset is a one-row
aggregate). With ``model="forest"`` the feature rows are written once to
the checkpoint folder so fit, offset and scoring read the same rows
instead of recomputing the feature plan three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, DetectionConfig
from ..operators import anomaly, features, normalize, rules, scoring
from ..session import materialize


def features_of(raw: DataFrame, cfg: DetectionConfig = DEFAULT, scope: tuple = ()) -> DataFrame:
    rows = normalize.with_flags(normalize.normalize(raw), cfg)
    return features.with_features(rows, cfg, scope)


def newest(raw: DataFrame, max_rows: int | None = None, cutoff=None) -> DataFrame:
    """S7 + R19: rows after the view cutoff, optionally only the newest N."""
    df = raw
    if cutoff is not None:
        from ..functions.timecols import ntz_lit
        df = df.where(F.col("timestamp") > ntz_lit(cutoff))
    if max_rows is not None:
        df = df.orderBy(F.col("timestamp").desc_nulls_last(), F.col("log_id").desc()).limit(max_rows)
    return df


def analyze(raw: DataFrame, cfg: DetectionConfig = DEFAULT, model: str = "forest",
            score_col: str | None = None, scope: tuple = (), persist_features: bool = True, saved=None) -> DataFrame:
    """Full detection. ``model``:

    * ``"forest"`` – fit the isolation forest on these rows and score them (M1–M6);
    * ``"saved"`` – score with ``saved`` (``forest.load``) and its offset;
    * ``"score"`` – ``score_col`` already holds a model score (lower = abnormal);
    * ``"none"`` – rules only, ``is_anomaly`` = 0.
    """
    feats = features_of(raw, cfg, scope)
    if model == "forest":
        from ..operators import forest
        if persist_features:
            feats = materialize(feats, "features")
        n_rows = feats.count()
        fitted = forest.fit(feats, cfg, rows=n_rows)
        # Written once with its score, so that the offset reads one column and no row is scored twice.
        scored = forest.score(feats, fitted, out="_forest_score")
        if persist_features:
            scored = materialize(scored, "scored")
        offset = anomaly.score_offset(scored, "_forest_score", cfg, rows=n_rows)
        feats = anomaly.with_anomaly(scored, "_forest_score", offset).drop("_forest_score")
    elif model == "saved":
        from ..operators import forest
        scored = forest.score(feats, saved.forest, out="_forest_score")
        feats = anomaly.with_anomaly(scored, "_forest_score", saved.offset).drop("_forest_score")
    elif model == "score":
        # Features keep every input row once, so the offset is taken on the
        # (column-pruned) input instead of the feature plan.
        offset = anomaly.score_offset(raw, score_col, cfg)
        feats = anomaly.with_anomaly(feats, score_col, offset)
    else:
        feats = feats.withColumns({"anomaly_score_raw": F.lit(None).cast("double"), "is_anomaly": F.lit(0)})
    return scoring.with_scores(rules.with_rules(feats, cfg), cfg)


def analyze_saved(raw: DataFrame, cfg: DetectionConfig = DEFAULT, **kw) -> DataFrame:
    """``analyze`` written once to the checkpoint folder (the saved
    ``analyzed_logs`` every reader aggregates) and read back."""
    return materialize(analyze(raw, cfg, **kw), "analyzed")
