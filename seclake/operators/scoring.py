"""MITRE mapping and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, RISK_DEFAULT, RISK_LEVELS, DetectionConfig


def _flag(name: str) -> Column:
    if name == "after_hours_privileged":
        return (F.col("after_hours_flag") == 1) & (F.col("is_privileged") == 1)
    return F.col(name) == 1


def techniques_array(cfg: DetectionConfig = DEFAULT) -> Column:
    """Array form: labels of the rules that fired, in mapping order."""
    return F.filter(F.array(*[F.when(_flag(f), F.lit(label)) for f, label in cfg.technique_labels]),
                    lambda x: x.isNotNull())


def techniques_text(cfg: DetectionConfig = DEFAULT) -> Column:
    """``", "``-joined labels (``concat_ws`` skips the nulls); none → ''."""
    return F.concat_ws(", ", *[F.when(_flag(f), F.lit(label)) for f, label in cfg.technique_labels])


def risk_level(score: Column) -> Column:
    """X5."""
    out = F.lit(RISK_DEFAULT)
    for threshold, level in reversed(RISK_LEVELS):
        out = F.when(score >= threshold, F.lit(level)).otherwise(out)
    return out


def with_scores(df: DataFrame, cfg: DetectionConfig = DEFAULT) -> DataFrame:
    """X1–X5. Needs rule flags and ``is_anomaly`` (0 when no model ran)."""
    if "is_anomaly" not in df.columns:
        df = df.withColumn("is_anomaly", F.lit(0))
    rule = sum((F.col(f) * w for f, w in cfg.rule_weights), F.lit(0))
    return (df.withColumns({
        "mitre_techniques": techniques_text(cfg),
        "rule_score": rule.cast("int"),
        "ml_score": F.when(F.col("is_anomaly") == 1, F.lit(cfg.ml_weight)).otherwise(F.lit(0)),
    }).withColumn("total_threat_score", F.col("rule_score") + F.col("ml_score"))
      .withColumn("final_risk_level", risk_level(F.col("total_threat_score"))))


def run_summary(analyzed: DataFrame) -> DataFrame:
    """Totals of one detection run (one row)."""
    lvl = F.col("final_risk_level")
    return analyzed.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count(F.when(lvl == "CRITICAL", 1)).alias("critical_events"),
        F.count(F.when(lvl == "HIGH", 1)).alias("high_events"))
