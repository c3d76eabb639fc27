"""Reports over analyzed rows.

Every report is an aggregate or a top-k: global aggregates use partial
aggregation, top-k uses ``orderBy().limit()`` (a per-partition heap then a
merge of k rows per partition), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RISK_ORDER, VERDICT_LOW, VERDICT_MODERATE, VERDICT_STRONG

HIGH_LEVELS = ("CRITICAL", "HIGH")
INCIDENT_COLUMNS = ("log_id", "timestamp", "username", "source_ip", "machine", "final_risk_level",
                    "total_threat_score", "mitre_techniques")


def _high() -> Column:
    return F.col("final_risk_level").isin(*HIGH_LEVELS)


def after_cutoff(df: DataFrame, cutoff: DataFrame | None, ts_col: str = "timestamp",
                 date_col: str | None = None) -> DataFrame:
    """Keep rows strictly after the view cutoff (a 0/1-row frame).

    The cutoff is read once on the driver (one row) and becomes a literal,
    so the predicate reaches the parquet scan; with a ``date_col``
    partition column the derived ``date >= to_date(cutoff)`` prunes
    partitions too. No cutoff row → all rows.
    """
    if cutoff is None:
        return df
    row = cutoff.select(F.max("watermark_ts").alias("c")).first()
    if row is None or row["c"] is None:
        return df
    from ..functions.timecols import ntz_lit
    c = ntz_lit(row["c"])
    out = df.where(F.col(ts_col) > c)
    if date_col and date_col in df.columns:
        out = out.where(F.col(date_col) >= F.to_date(c))
    return out


def kpi_aggregates() -> list[Column]:
    """The sums that R1 and R4–R8 follow from."""
    score = F.col("total_threat_score").try_cast("double")
    return [
        F.count(F.lit(1)).alias("total_events"),
        F.count(F.when(F.col("is_anomaly") == 1, 1)).alias("total_anomalies"),
        F.avg(score).alias("_avg"),
        F.count(F.when(score >= 7, 1)).alias("high_confidence_cases"),
        F.count(F.when(score.between(4, 6), 1)).alias("medium_confidence_cases"),
        F.count(F.when(score <= 3, 1)).alias("low_confidence_cases"),
        F.countDistinct(F.when(_high(), F.col("username"))).alias("unique_high_users"),
        F.countDistinct(F.when(_high(), F.col("source_ip"))).alias("unique_high_ips"),
        F.countDistinct(F.when(_high(), F.col("mitre_techniques"))).alias("unique_mitre_techniques"),
    ]


def kpi_columns() -> list:
    """R1, R4–R8 from ``kpi_aggregates``."""
    total = F.col("total_events")
    hi, med = F.col("high_confidence_cases"), F.col("medium_confidence_cases")
    users, ips, mitre = F.col("unique_high_users"), F.col("unique_high_ips"), F.col("unique_mitre_techniques")
    return [
        "total_events", "total_anomalies",
        F.when(total > 0, F.round(F.col("total_anomalies") * 100.0 / total, 2)).otherwise(F.lit(0.0))
        .alias("anomaly_rate"),
        F.when(total > 0, F.round(F.col("_avg"), 2)).otherwise(F.lit(0.0)).alias("avg_threat_score"),
        "high_confidence_cases", "medium_confidence_cases", "low_confidence_cases",
        "unique_high_users", "unique_high_ips", "unique_mitre_techniques",
        (users > 1).alias("multi_user_flag"), (ips > 1).alias("multi_ip_flag"),
        (mitre > 1).alias("multi_technique_flag"),
        F.when((hi > 5) & (users > 1) & (ips > 1) & (mitre > 1), F.lit(VERDICT_STRONG))
        .when(med > 0, F.lit(VERDICT_MODERATE)).otherwise(F.lit(VERDICT_LOW)).alias("machine_verdict"),
        F.least(F.lit(100), hi * 5 + med * 2 + mitre * 3 + ips * 2).cast("bigint").alias("confidence_score"),
    ]


def summary_kpis(df: DataFrame) -> DataFrame:
    """One row of totals, confidence bands, distinct high-risk
    users / IPs / technique strings, verdict and confidence score."""
    return df.agg(*kpi_aggregates()).select(*kpi_columns())


def risk_distribution(df: DataFrame) -> DataFrame:
    """R2: counts of the levels present."""
    return df.groupBy("final_risk_level").agg(F.count(F.lit(1)).alias("count"))


def risk_distribution_full(df: DataFrame) -> DataFrame:
    """All four levels, zero when absent (4-row dimension, broadcast)."""
    spark = df.sparkSession
    levels = spark.createDataFrame([(lvl,) for lvl in RISK_ORDER], "final_risk_level string")
    counts = risk_distribution(df)
    return (F.broadcast(levels).join(counts, "final_risk_level", "left")
            .select("final_risk_level", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def top_incidents(df: DataFrame, n: int = 20) -> DataFrame:
    """Highest scores; ties by newer time, then ``log_id``."""
    return (df.select(*INCIDENT_COLUMNS)
            .orderBy(F.col("total_threat_score").desc(), F.col("timestamp").desc_nulls_last(),
                     F.col("log_id").asc())
            .limit(n))


def top_high_risk(df: DataFrame, n: int = 10) -> DataFrame:
    """Top CRITICAL/HIGH incidents, five report columns (+ key)."""
    return (df.where(_high())
            .orderBy(F.col("total_threat_score").desc(), F.col("timestamp").desc_nulls_last(),
                     F.col("log_id").asc())
            .limit(n)
            .select("log_id", "username", "source_ip", "final_risk_level", "total_threat_score",
                    "mitre_techniques"))


def technique_counts(df: DataFrame) -> DataFrame:
    """Split on ',', trim, drop blanks, count."""
    parts = df.select(F.explode(F.split(F.col("mitre_techniques"), ",")).alias("t"))
    return (parts.select(F.trim("t").alias("technique")).where(F.col("technique") != "")
            .groupBy("technique").agg(F.count(F.lit(1)).alias("count")))


def technique_top10_short(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` techniques by count with their short id."""
    return (technique_counts(df).orderBy(F.col("count").desc(), F.col("technique").asc()).limit(n)
            .select("technique", F.split_part(F.col("technique"), F.lit(" - "), F.lit(1)).alias("short_id"),
                    "count"))


def timeline_hourly(df: DataFrame) -> DataFrame:
    """Events per ``yyyy-MM-dd HH:00``; null times dropped."""
    return (df.where(F.col("timestamp").isNotNull())
            .groupBy(F.date_format("timestamp", "yyyy-MM-dd HH:00").alias("hour"))
            .agg(F.count(F.lit(1)).alias("count")))


def user_risk_top10(df: DataFrame, n: int = 10) -> DataFrame:
    """Users by their highest score; null users dropped."""
    return (df.where(F.col("username").isNotNull()).groupBy("username")
            .agg(F.max("total_threat_score").alias("max_threat_score"))
            .orderBy(F.col("max_threat_score").desc(), F.col("username").asc()).limit(n))


def ip_top10(df: DataFrame, n: int = 10) -> DataFrame:
    """Busiest addresses, excluding null and ``N/A``."""
    return (df.where(F.col("source_ip").isNotNull() & (F.col("source_ip") != "N/A"))
            .groupBy("source_ip").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("source_ip").asc()).limit(n))


def incident_search(df: DataFrame, term: str) -> DataFrame:
    """Case-insensitive substring over user, IP, level and techniques."""
    q = F.lit(term.lower())

    def has(c: str) -> Column:
        return F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), q)

    return df.where(has("username") | has("source_ip") | has("final_risk_level") | has("mitre_techniques"))


def incident_sort(incidents: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """Order an incident list by one column: numerically when every
    value is numeric, else by lower-cased text; adds ``sort_rank``. Ties
    keep the incident order (``log_id``). Numbered distributedly (range
    partitions, local numbers, offsets)."""
    from .indexing import row_numbers
    text = F.lower(F.coalesce(F.col(column).cast("string"), F.lit("")))
    num = F.coalesce(F.col(column).cast("string"), F.lit("")).try_cast("double")
    all_numeric = incidents.agg(F.min(F.when(num.isNull(), 0).otherwise(1)).alias("ok")).first()["ok"]
    keyed = incidents.withColumn("_sort_key", num if all_numeric in (1, None) else text)
    order = F.col("_sort_key").desc() if descending else F.col("_sort_key").asc()
    return row_numbers(keyed, [order, F.col("log_id").asc()], "sort_rank").drop("_sort_key") \
        .withColumn("sort_rank", F.col("sort_rank").cast("int"))
