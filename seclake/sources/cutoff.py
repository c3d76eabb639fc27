"""View cutoff (R19): one table that says from when on a reader sees rows.

Setting and clearing append one row each to a list of actions, and the newest
action holds; a reader therefore never finds the table half replaced. A
cleared cutoff is a row without time.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import ntz_lit

SCHEMA = "action long, watermark_ts timestamp_ntz"


def _append(spark: SparkSession, path: str, at) -> None:
    row = spark.range(1).select(F.lit(time.time_ns()).alias("action"), (ntz_lit(at) if at is not None else F.lit(None).cast("timestamp_ntz")).alias("watermark_ts"))
    row.coalesce(1).write.mode("append").parquet(path)


def set_cutoff(spark: SparkSession, path: str, at: dt.datetime | None = None) -> None:
    """Sets the cutoff to ``at``, by default to now (UTC)."""
    _append(spark, path, at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def clear_cutoff(spark: SparkSession, path: str) -> None:
    _append(spark, path, None)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The cutoff in force as ``watermark_ts``: one row, or none. Fits ``reports.after_cutoff``."""
    try:
        actions = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # nobody has set a cutoff yet
            raise
        actions = spark.createDataFrame([], SCHEMA)
    newest = actions.agg(F.max(F.struct("action", "watermark_ts")).alias("a"))
    return newest.select("a.watermark_ts").where("watermark_ts is not null")


def status(spark: SparkSession, path: str) -> DataFrame:
    """One row: whether a cutoff is in force, and its time."""
    return current(spark, path).agg((F.count("*") > 0).alias("active"), F.max("watermark_ts").alias("watermark_ts"))
