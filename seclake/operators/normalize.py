"""Normalisation and per-row flags.

All of it is narrow column arithmetic: one projection, whole-stage
codegen, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (DEFAULT, EV_KERBEROS_TGS, EV_KERBEROS_TGT, EV_LOGON_FAILED, EV_LOGON_SUCCESS,
                      EV_PRIVILEGED, EV_PROCESS, DetectionConfig)
from ..functions.timecols import parse_mixed_timestamp

# Machine tags written by the two collectors and their short forms.
MACHINE_TAGS = (("DOMAIN_CONTROLLER", "DC"), ("CLIENT_MACHINE", "CLIENT"))

RAW_COLUMNS = ("timestamp", "event_id", "username", "source_ip", "process_name", "command_line",
               "source_machine")


def machine_tag(col: Column) -> Column:
    """P10: long collector tag → short tag; other values kept."""
    out = col
    for long_tag, short_tag in reversed(MACHINE_TAGS):
        out = F.when(col == long_tag, F.lit(short_tag)).otherwise(out)
    return out


def add_missing(df: DataFrame) -> DataFrame:
    """Columns a reader relies on are added as ``N/A`` when absent."""
    missing = {c: F.lit("N/A") for c in ("process_name", "command_line", "source_ip", "username")
               if c not in df.columns}
    return df.withColumns(missing) if missing else df


def normalize(raw: DataFrame) -> DataFrame:
    """raw_logs → normalised rows with ``machine``, ``login_hour``, ``day``.

    Username is deliberately not filled: null users stay out of every
    per-user aggregate (their features become 0).
    """
    df = add_missing(raw)
    if "source_machine" in df.columns:
        df = df.withColumn("machine", machine_tag(F.col("source_machine"))).drop("source_machine")
    else:
        df = df.withColumn("machine", F.lit("UNKNOWN"))
    ts_type = dict(df.dtypes).get("timestamp")
    if ts_type == "string":
        ts = parse_mixed_timestamp("timestamp")
    else:
        ts = F.col("timestamp").cast("timestamp_ntz")
    return df.withColumns({
        "timestamp": ts,
        "source_ip": F.coalesce(F.col("source_ip").cast("string"), F.lit("N/A")),
        "process_name": F.coalesce(F.col("process_name").cast("string"), F.lit("N/A")),
        "command_line": F.coalesce(F.col("command_line").cast("string"), F.lit("")),
    }).withColumns({
        "login_hour": F.coalesce(F.hour("timestamp"), F.lit(0)),
        "day": F.coalesce(F.dayofmonth("timestamp"), F.lit(0)),
    })


def _is(event_id: int) -> Column:
    return F.coalesce(F.col("event_id") == event_id, F.lit(False)).cast("int")


def with_flags(df: DataFrame, cfg: DetectionConfig = DEFAULT) -> DataFrame:
    """Event-type flags, suspicious process / command line,
    after-hours and weekend flags (all 0/1 ints)."""
    hour = F.col("login_hour")
    return df.withColumns({
        "is_failed_login": _is(EV_LOGON_FAILED),
        "is_successful_login": _is(EV_LOGON_SUCCESS),
        "is_privileged": _is(EV_PRIVILEGED),
        "is_process_exec": _is(EV_PROCESS),
        "is_kerberos_tgt": _is(EV_KERBEROS_TGT),
        "is_kerberos_tgs": _is(EV_KERBEROS_TGS),
        "suspicious_process": F.coalesce(
            F.col("process_name").rlike("(?iu)" + cfg.suspicious_process_pattern), F.lit(False)).cast("int"),
        "suspicious_commandline": F.coalesce(
            F.col("command_line").rlike("(?iu)" + cfg.suspicious_cmdline_pattern), F.lit(False)).cast("int"),
        "after_hours_flag": ((hour < cfg.after_hours_end) | (hour >= cfg.after_hours_start)).cast("int"),
        "is_weekend": F.coalesce(F.weekday("timestamp").isin(5, 6), F.lit(False)).cast("int"),
    })


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """P20: nulls in numeric columns → 0."""
    numeric = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")
               or t.startswith("decimal")]
    return df.fillna(0, subset=numeric) if numeric else df


def split_by_machine(raw: DataFrame, tag: str) -> DataFrame:
    """Rows of one collector (``DOMAIN_CONTROLLER`` / ``CLIENT_MACHINE``)."""
    return raw.where(F.col("source_machine") == tag)
