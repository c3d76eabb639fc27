"""Windows Security event records → ``raw_logs`` rows.

Input: exported event records ``(record_number, event_id_raw,
time_generated, string_inserts, host, profile)`` from files or a stream.
The projection is a single ``select`` of ``CASE`` expressions over
``get(string_inserts, i)``: it runs identically in batch and streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CLIENT_EVENT_IDS, DC_EVENT_IDS, LOOPBACK
from ..functions.ipcols import first_stripped_ip_in, looks_like_stripped_ip, sanitize_stripped_client, sanitize_stripped_dc, strip_ws
from ..functions.timecols import parse_mixed_timestamp

WIN_EVENT_SCHEMA = T.StructType([
    T.StructField("record_number", T.LongType()),
    T.StructField("event_id_raw", T.LongType()),
    T.StructField("time_generated", T.StringType()),
    T.StructField("string_inserts", T.ArrayType(T.StringType())),
    T.StructField("host", T.StringType()),
    T.StructField("profile", T.StringType()),
])

# Collector tags written into ``source_machine``.
PROFILE_TAGS = {"dc": "DOMAIN_CONTROLLER", "client": "CLIENT_MACHINE"}


def mask_event_id(raw: Column | str) -> Column:
    """The low 16 bits carry the event id."""
    c = F.col(raw) if isinstance(raw, str) else raw
    return c.bitwiseAND(F.lit(0xFFFF)).cast("int")


def keep_target_events(df: DataFrame, profile_col: str = "profile", event_col: str = "event_id") -> DataFrame:
    """Keep the event ids of each collector profile."""
    p, e = F.col(profile_col), F.col(event_col)
    return df.where(((p == "dc") & e.isin(*DC_EVENT_IDS)) | ((p == "client") & e.isin(*CLIENT_EVENT_IDS)))


def safe_get(arr: Column, i: int, default: str = "N/A") -> Column:
    """P4 (DC): element ``i`` trimmed; missing, empty or ``-`` → default."""
    return _filled(strip_ws(F.get(arr, i)), default)


def _filled(v: Column, default: str = "N/A") -> Column:
    return F.when(v.isNull() | (v == "") | (v == "-"), F.lit(default)).otherwise(v)


def _raw_get(arr: Column, i: int, default: str) -> Column:
    """Client profile: element ``i`` verbatim when present, else default."""
    return F.when(F.size(arr) > i, F.get(arr, i)).otherwise(F.lit(default))


def project_dc(ev: Column, clean: Column) -> dict:
    """P3/P5/P8/P9 for domain controllers. ``clean``: the insertion strings, each stripped."""
    def got(i, default="N/A"):
        return _filled(F.get(clean, i), default)
    logon = ev.isin(4624, 4625)
    kerb = ev.isin(4768, 4769)
    cand = got(9, "")
    logon_ip = F.when(got(8, "0").isin("2", "0"), F.lit(LOOPBACK)) \
        .otherwise(sanitize_stripped_dc(got(18, "")))
    kerb_ip = F.when(looks_like_stripped_ip(cand), sanitize_stripped_dc(cand)).otherwise(first_stripped_ip_in(clean))
    return {
        "username": F.when(logon, got(5)).when(ev == 4672, got(1)).when(kerb, got(0))
        .when(ev == 4688, got(1)).otherwise(F.lit("N/A")),
        "source_ip": F.when(logon, logon_ip).when(ev == 4672, F.lit(LOOPBACK)).when(kerb, kerb_ip)
        .when(ev == 4688, F.lit(LOOPBACK)).otherwise(F.lit("N/A")),
        "process_name": F.when(ev == 4688, got(5)).otherwise(F.lit("N/A")),
        "command_line": F.when(ev == 4688, got(8, "")).otherwise(F.lit("N/A")),
    }


def project_client(ev: Column, s: Column, clean: Column, host_ip: Column) -> dict:
    """P3/P6 for workstations; 4688 rows carry the host's own address."""
    has = s.isNotNull() & (F.size(s) > 0)
    logon = has & ev.isin(4624, 4625)
    proc = has & (ev == 4688)
    return {
        "username": F.when(logon, _raw_get(s, 5, "N/A")).when(proc, _raw_get(s, 1, "N/A")).otherwise(F.lit("N/A")),
        "source_ip": F.when(logon, sanitize_stripped_client(_raw_get(clean, 18, LOOPBACK)))
        .when(proc, F.coalesce(host_ip, F.lit(LOOPBACK))).otherwise(F.lit(LOOPBACK)),
        "process_name": F.when(proc, _raw_get(s, 5, "N/A")).otherwise(F.lit("N/A")),
        "command_line": F.when(proc, _raw_get(s, 8, "N/A")).otherwise(F.lit("N/A")),
    }


def to_raw_logs(records: DataFrame, host_ip_col: str | None = None) -> DataFrame:
    """Event records of either profile → ``raw_logs`` rows."""
    ev = mask_event_id("event_id_raw")
    # A column of its own, so that a row's strings are stripped once and not for each expression that looks at one.
    df = keep_target_events(records.withColumn("event_id", ev)).withColumn("_clean", F.transform("string_inserts", strip_ws))
    e, s, clean = F.col("event_id"), F.col("string_inserts"), F.col("_clean")
    host_ip = F.col(host_ip_col) if host_ip_col else F.lit(None).cast("string")
    dc, cl = project_dc(e, clean), project_client(e, s, clean, host_ip)
    is_dc = F.col("profile") == "dc"
    cols = {k: F.when(is_dc, dc[k]).otherwise(cl[k]) for k in dc}
    return df.select(
        "host", "record_number",
        F.xxhash64("host", "record_number").alias("log_id"),  # stable row id for sampling and ties
        parse_mixed_timestamp("time_generated").alias("timestamp"),
        e.alias("event_id"),
        *[v.alias(k) for k, v in cols.items()],
        F.when(is_dc, F.lit(PROFILE_TAGS["dc"])).otherwise(F.lit(PROFILE_TAGS["client"])).alias("source_machine"))


def incremental(records: DataFrame, high_water: DataFrame | None) -> DataFrame:
    """S4 (batch form): records newer than the host's mark ``(host, mark)``.
    A missing mark or mark 0 means everything. Streaming jobs use the
    checkpoint instead."""
    if high_water is None:
        return records
    hw = high_water.select("host", F.col("mark").alias("_mark"))
    return (records.join(hw, "host", "left")  # AQE broadcasts the mark table when it is small
            .where(F.col("_mark").isNull() | (F.col("_mark") <= 0) | (F.col("record_number") > F.col("_mark")))
            .drop("_mark"))


def new_high_water(records: DataFrame, high_water: DataFrame | None = None) -> DataFrame:
    """New mark per host = max record number seen (all ids, kept or not)."""
    seen = records.groupBy("host").agg(F.max("record_number").alias("mark"))
    if high_water is None:
        return seen
    return seen.unionByName(high_water.select("host", "mark")).groupBy("host").agg(F.max("mark").alias("mark"))
