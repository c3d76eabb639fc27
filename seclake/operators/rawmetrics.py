"""Raw-log metrics per collector (L1–L7) and process executions near
anomalies (J2).

Results are long tables ``(source_machine, metric, key, value, rank)`` so
any number of metrics and keys fit one schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EV_LOGON_SUCCESS, EV_PROCESS
from ..functions.ipcols import strip_ws
from ..functions.timecols import MICROS_PER_MINUTE, micros
from .prefix import running_sum

MACHINES = ("DOMAIN_CONTROLLER", "CLIENT_MACHINE")
LONG_SCHEMA = "source_machine string, metric string, key string, value bigint, rank int"


#: Columns that the metrics read, with what stands in for an absent one.
READ_COLUMNS = {"timestamp": "timestamp_ntz", "event_id": "int", "username": "string", "source_ip": "string", "process_name": "string", "command_line": "string"}


def complete(raw: DataFrame) -> DataFrame:
    """Columns that a collector didn't deliver are added as null, which counts as ''."""
    missing = {c: F.lit(None).cast(kind) for c, kind in READ_COLUMNS.items() if c not in raw.columns}
    return raw.withColumns(missing) if missing else raw


def key_counts(raw: DataFrame, pair_event: int = EV_LOGON_SUCCESS) -> DataFrame:
    """Every counted key of L2, L3 and L5 in one aggregation:
    ``(source_machine, metric, key, value)``. Each row emits its entries
    (null → ''); partial aggregation collapses them before the one shuffle."""
    raw = complete(raw)
    pair = F.concat(F.coalesce(F.col("username"), F.lit("")), F.lit("@"),
                    F.coalesce(strip_ws(F.col("source_ip")), F.lit("")))
    entries = F.array(
        F.struct(F.lit("event_id_counts").alias("metric"), F.coalesce(F.col("event_id").cast("string"), F.lit("")).alias("key")),
        F.struct(F.lit("top_processes").alias("metric"), F.coalesce(F.col("process_name").cast("string"), F.lit("")).alias("key")),
        F.struct(F.lit("top_commands").alias("metric"), F.coalesce(F.col("command_line").cast("string"), F.lit("")).alias("key")),
        F.struct(F.lit("logon_pairs").alias("metric"),
                 F.when(F.col("event_id") == pair_event, pair).alias("key")))
    return (raw.where(F.col("source_machine").isin(*MACHINES))
            .select("source_machine", F.inline(entries))
            .where(F.col("key").isNotNull())
            .groupBy("source_machine", "metric", "key").agg(F.count(F.lit(1)).alias("value")))


def shared_key_counts(raw: DataFrame, pair_event: int = EV_LOGON_SUCCESS) -> DataFrame:
    """``key_counts`` written once to the checkpoint folder (distinct keys
    only), so every top-n branch reads it instead of rescanning ``raw``."""
    from ..session import materialize
    return materialize(key_counts(raw, pair_event), "key-counts")


def _top(counts: DataFrame, machine: str, metric: str, n: int, out_metric: str | None = None,
         min_value: int | None = None, drop_blank: bool = True) -> DataFrame:
    """First ``n`` keys of one fixed (collector, metric) group by count, ties
    by key (a TakeOrdered over that group's counts); ``rank`` 1..n."""
    from pyspark.sql import Window
    sel = counts.where((F.col("source_machine") == machine) & (F.col("metric") == metric))
    if min_value is not None:
        sel = sel.where(F.col("value") >= min_value)
    top = sel.orderBy(F.col("value").desc(), F.col("key").asc()).limit(n)
    w = Window.orderBy(F.col("value").desc(), F.col("key").asc())  # n rows at most
    out = top.withColumn("rank", F.row_number().over(w).cast("int"))
    if drop_blank:
        out = out.where(F.trim("key") != "")
    return out.select(F.lit(machine).alias("source_machine"), F.lit(out_metric or metric).alias("metric"), "key",
                      F.col("value").cast("bigint"), "rank")


def top_counts(df: DataFrame, key: Column, n: int, metric: str, machine: str) -> DataFrame:
    """L1: null → '', count, keep the first ``n`` by count (ties by key),
    then drop blank keys, so a blank may take one of the ``n`` places."""
    counted = df.groupBy(F.coalesce(key.cast("string"), F.lit("")).alias("key")) \
        .agg(F.count(F.lit(1)).alias("value"))
    tagged = counted.select(F.lit(machine).alias("source_machine"), F.lit(metric).alias("metric"), "key", "value")
    return _top(tagged, machine, metric, n)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def event_id_counts(raw: DataFrame, n: int = 50, counts: DataFrame | None = None) -> DataFrame:
    """L2."""
    counts = shared_key_counts(raw) if counts is None else counts
    return _union([_top(counts, m, "event_id_counts", n) for m in MACHINES])


def top_processes(raw: DataFrame, n_proc: int = 15, n_cmd: int = 10, counts: DataFrame | None = None) -> DataFrame:
    """L3: top processes and top command lines."""
    counts = shared_key_counts(raw) if counts is None else counts
    return _union([_top(counts, m, metric, n) for m in MACHINES
                   for metric, n in (("top_processes", n_proc), ("top_commands", n_cmd))])


def raw_metrics(raw: DataFrame) -> DataFrame:
    """L4: rows, unique users (null counted as ''), unique trimmed IPs; a collector without rows gets zeros."""
    raw = complete(raw)
    found = (raw.where(F.col("source_machine").isin(*MACHINES)).groupBy("source_machine").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(F.coalesce(F.col("username"), F.lit(""))).alias("unique_users"),
        F.countDistinct(F.coalesce(strip_ws(F.col("source_ip")), F.lit(""))).alias("unique_ips")))
    both = raw.sparkSession.createDataFrame([(m,) for m in MACHINES], "source_machine string")
    return F.broadcast(both).join(found, "source_machine", "left").select(
        "source_machine", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows", "unique_users", "unique_ips")])


def logon_pairs(raw: DataFrame, event_id: int = EV_LOGON_SUCCESS, min_events: int = 5,
                n: int = 10, counts: DataFrame | None = None) -> DataFrame:
    """``user@ip`` pairs with at least ``min_events`` rows of ``event_id``:
    their number and the top ``n``."""
    counts = shared_key_counts(raw, event_id) if counts is None else counts
    parts = []
    for m in MACHINES:
        sel = counts.where((F.col("source_machine") == m) & (F.col("metric") == "logon_pairs")
                           & (F.col("value") >= min_events))
        parts.append(sel.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(
            F.lit(m).alias("source_machine"), F.lit("brute_force_suspects").alias("metric"), F.lit("").alias("key"),
            "value", F.lit(0).alias("rank")))
        parts.append(_top(counts, m, "logon_pairs", n, out_metric="top_bruteforce_pairs", min_value=min_events,
                          drop_blank=False))
    return _union(parts)


def process_near_anomalies(anomalies: DataFrame, logs: DataFrame, window_minutes: int = 15,
                           n: int = 10) -> DataFrame:
    """Process executions (4688) within ±window (inclusive) of each
    anomaly, multiplicity kept: total matches and the top ``n`` processes.

    Pair-free: matches of a process event at time t = #anomalies ≤ t+w minus
    #anomalies < t−w. Anomalies (+weight), upper queries and lower queries
    are put on one time line ordered by (time, kind) and a distributed
    running sum gives every query its count; summing ``±multiplicity ×
    count`` per process name gives the answer without materialising any
    (anomaly, process) pair.
    """
    win = window_minutes * MICROS_PER_MINUTE
    a = (anomalies.where(F.col("timestamp").isNotNull())
         .groupBy(micros("timestamp").alias("t")).agg(F.count(F.lit(1)).alias("w"))
         .select("t", F.lit(1).alias("kind"), "w", F.lit(None).cast("string").alias("name"),
                 F.lit(0).cast("bigint").alias("m")))
    p = (logs.where((F.col("event_id") == EV_PROCESS) & F.col("timestamp").isNotNull())
         .groupBy(micros("timestamp").alias("tp"),
                  F.coalesce(F.col("process_name"), F.lit("")).alias("name"))
         .agg(F.count(F.lit(1)).alias("m")))
    upper = p.select((F.col("tp") + win).alias("t"), F.lit(2).alias("kind"), F.lit(0).cast("bigint").alias("w"),
                     "name", "m")
    lower = p.select((F.col("tp") - win).alias("t"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("w"),
                     "name", (-F.col("m")).alias("m"))
    line = a.unionByName(upper).unionByName(lower)
    summed = running_sum(line, ["t", "kind"], "w", "cum")
    contrib = summed.where(F.col("kind") != 1).groupBy("name") \
        .agg(F.sum(F.col("m") * F.col("cum")).cast("bigint").alias("value"))
    total = contrib.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("value")).select(
        F.lit("matches").alias("metric"), F.lit("").alias("key"), "value", F.lit(0).alias("rank"))
    from pyspark.sql import Window
    w = Window.orderBy(F.col("value").desc(), F.col("key").asc())
    top = (contrib.where(F.col("value") > 0).select(F.col("name").alias("key"), "value")
           .orderBy(F.col("value").desc(), F.col("key").asc()).limit(n)
           .withColumn("rank", F.row_number().over(w).cast("int"))
           .where(F.trim("key") != "")
           .select(F.lit("top_processes").alias("metric"), "key", "value", "rank"))
    return total.unionByName(top).withColumn("window_minutes", F.lit(window_minutes))
