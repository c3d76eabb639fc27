"""Windowed stream aggregates (K5 alert form, K6, K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_timeline(stream: DataFrame) -> DataFrame:
    """K6: events per tumbling hour (``event_time`` carries the watermark)."""
    return (stream.groupBy(F.window("event_time", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:00").alias("hour"), "count"))


def failure_bursts(stream: DataFrame, threshold: int = 5, length: str = "10 minutes",
                   slide: str = "1 minute") -> DataFrame:
    """K5 alert form: users with ≥ ``threshold`` failures in a sliding window."""
    fails = stream.where((F.col("event_id") == 4625) & F.col("username").isNotNull())
    return (fails.groupBy(F.window("event_time", length, slide).alias("w"), "username")
            .agg(F.count(F.lit(1)).alias("failures"))
            .where(F.col("failures") >= threshold))


def failed_users(stream: DataFrame, length: str = "1 hour") -> DataFrame:
    """K8: the exact number of users that each address failed to log on, per closed window. Two stateful steps in a row: a
    (window, address, user) passes once, then what passed is counted. The watermark ends the state of both with the window."""
    fails = stream.where((F.col("event_id") == 4625) & F.col("username").isNotNull())
    once = fails.select(F.window("event_time", length).alias("w"), "source_ip", "username").dropDuplicates(["w", "source_ip", "username"])
    return once.groupBy("w", "source_ip").agg(F.count(F.lit(1)).alias("failed_users")).select(
        F.col("w.start").alias("window_start"), "source_ip", "failed_users")


def spray_candidates(stream: DataFrame, threshold: int = 6, length: str = "1 hour") -> DataFrame:
    """K8: addresses whose failed logons touch ``threshold`` users or more in a window."""
    return failed_users(stream, length).where(F.col("failed_users") >= threshold)
