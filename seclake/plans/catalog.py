"""Registered queries: one Spark callable per operator key, each with its
DuckDB oracle SQL where the operator is SQL-expressible.

Every query reads the given tables (or views Spark derives from them)
in full; limits appear only where a top-k is the operator.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, EV_LOGON_SUCCESS
from ..functions import ipcols
from ..operators import features, normalize, rawmetrics, reports, scoring
from ..plans import detection
from ..session import materialize
from ..sources import fixtures
from . import oracle as O

QUERIES: dict = {}
ORACLE: dict = {}

CUTOFF = "2024-01-20 00:00:00"
NEWEST_N = 1_000  # fewer than the gate's tables hold, so that the cut shows
SEARCH_TERM = "t1110"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- shared views

def _raw(spark: SparkSession, base: str) -> DataFrame:
    return fixtures.raw_logs(spark, base)


def _flags(spark, base) -> DataFrame:
    return normalize.with_flags(normalize.normalize(_raw(spark, base)))


def _features(spark, base) -> DataFrame:
    return detection.features_of(_raw(spark, base))


def _analyze(spark, base) -> DataFrame:
    """Rules + scores with ``events.value`` standing in for the model score."""
    return detection.analyze(fixtures.raw_logs_with_value(spark, base), model="score", score_col="value")


_SAVED: dict = {}


def _analyzed(spark, base) -> DataFrame:
    """The saved ``analyzed_logs`` that reports read: one run per session and folder."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _SAVED:
        _SAVED[key] = materialize(_analyze(spark, base), "analyzed")
    return _SAVED[key]


def _r6(c: str) -> Column:
    return F.round(F.col(c), 6).alias(c)


def _probe(spark, base) -> DataFrame:
    lid = F.col("log_id")
    cand = (F.when(lid % 10 == 0, F.col("source_ip"))
            .when(lid % 10 == 1, F.concat(F.lit("::ffff:"), F.col("source_ip")))
            .when(lid % 10 == 2, F.lit("::1"))
            .when(lid % 10 == 3, F.concat(F.lit("fe80::"), (lid % 97).cast("string")))
            .when(lid % 10 == 4, F.lit(" - "))
            .when(lid % 10 == 5, F.concat(F.lit("host"), (lid % 13).cast("string")))
            .when(lid % 10 == 6, F.concat(F.lit(" "), F.col("source_ip"), F.lit(" ")))
            .when(lid % 10 == 7, F.concat(F.lit("2001:db8::"), (lid % 50).cast("string")))
            .when(lid % 10 == 8, F.lit(""))
            .otherwise(F.concat(F.lit("::"), (lid % 7).cast("string"))))
    return _raw(spark, base).select("log_id", cand.alias("candidate"))


# ---------------------------------------------------------------- sources / projections

@register("event_id_mask", O.chain("raw_logs") + """,
recs AS (SELECT log_id, event_id + 65536 * (log_id % 3) AS event_id_raw,
  CASE WHEN source_machine = 'DOMAIN_CONTROLLER' THEN 'dc' ELSE 'client' END AS profile FROM raw_logs)
SELECT log_id, profile, event_id_raw, CAST(event_id_raw & 65535 AS INTEGER) AS event_id FROM recs
WHERE (profile = 'dc' AND (event_id_raw & 65535) IN (4624, 4625, 4672, 4768, 4769, 4688))
   OR (profile = 'client' AND (event_id_raw & 65535) IN (4624, 4625, 4688))""")
def q_event_id_mask(spark, base):
    from ..sources import winevents
    recs = _raw(spark, base).select(
        "log_id", F.when(F.col("source_machine") == "DOMAIN_CONTROLLER", "dc").otherwise("client").alias("profile"),
        (F.col("event_id") + 65536 * (F.col("log_id") % 3)).alias("event_id_raw"))
    return winevents.keep_target_events(recs.withColumn("event_id", winevents.mask_event_id("event_id_raw")))


@register("looks_like_ip", O.chain("raw_logs") + "," + O.IP_PROBE + f"""
SELECT log_id, candidate, CAST(coalesce(s <> '' AND (regexp_matches(
  CASE WHEN starts_with(lower(s), '::ffff:') THEN substr(s, 8) ELSE s END, {O._q(O.IPV4_SHAPE)})
  OR regexp_matches(s, {O._q(O.IPV6_LIKE)})), false) AS INTEGER) AS looks_like_ip FROM trimmed""")
def q_looks_like_ip(spark, base):
    return _probe(spark, base).select("log_id", "candidate",
                                      ipcols.looks_like_ip("candidate").cast("int").alias("looks_like_ip"))


@register("sanitize_ip_dc", O.chain("raw_logs") + "," + O.IP_PROBE + f"""
SELECT log_id, candidate, CASE WHEN candidate IS NULL THEN '127.0.0.1'
 WHEN s IN {O._in(O.DC_LOOPBACK_FORMS)} THEN '127.0.0.1'
 WHEN starts_with(lower(s), '::ffff:') THEN substr(s, 8)
 WHEN regexp_matches(s, {O._q(O.IPV4_SHAPE)}) THEN s
 WHEN starts_with(s, '::') OR s = '0:0:0:0:0:0:0:1' THEN '127.0.0.1'
 WHEN length(s) > 1 THEN s ELSE '127.0.0.1' END AS ip FROM trimmed""")
def q_sanitize_ip_dc(spark, base):
    return _probe(spark, base).select("log_id", "candidate", ipcols.sanitize_ip_dc("candidate").alias("ip"))


@register("sanitize_ip_client", O.chain("raw_logs") + "," + O.IP_PROBE + f"""
SELECT log_id, candidate, CASE WHEN candidate IS NULL THEN '127.0.0.1'
 WHEN s IN {O._in(O.CLIENT_LOOPBACK_FORMS)} THEN '127.0.0.1'
 WHEN regexp_matches(s, {O._q(O.CLIENT_IPV4)}) THEN s
 WHEN regexp_matches(s, {O._q(O.CLIENT_IPV6)}) AND starts_with(s, 'fe80') THEN '127.0.0.1'
 WHEN regexp_matches(s, {O._q(O.CLIENT_IPV6)}) THEN s ELSE '127.0.0.1' END AS ip FROM trimmed""")
def q_sanitize_ip_client(spark, base):
    return _probe(spark, base).select("log_id", "candidate", ipcols.sanitize_ip_client("candidate").alias("ip"))


@register("fill_defaults", O.chain("raw_logs") + """
SELECT log_id, coalesce(event_id, 0) AS event_id, coalesce(username, '') AS username,
 coalesce(source_ip, 'N/A') AS source_ip, coalesce(process_name, 'N/A') AS process_name,
 coalesce(command_line, '') AS command_line,
 coalesce(regexp_replace(source_ip, '^\\s+|\\s+$', '', 'g'), '') AS ip_trimmed FROM raw_logs""")
def q_fill_defaults(spark, base):
    df = normalize.fill_numeric_zero(normalize.add_missing(_raw(spark, base)).select(
        "log_id", "event_id", "username", "source_ip", "process_name", "command_line"))
    return df.select("log_id", "event_id", F.coalesce("username", F.lit("")).alias("username"),
                     F.coalesce("source_ip", F.lit("N/A")).alias("source_ip"),
                     F.coalesce("process_name", F.lit("N/A")).alias("process_name"),
                     F.coalesce("command_line", F.lit("")).alias("command_line"),
                     F.coalesce(ipcols.strip_ws("source_ip"), F.lit("")).alias("ip_trimmed"))


@register("machine_split", O.chain("raw_logs") + """
SELECT source_machine, count(*) AS n_rows FROM raw_logs
WHERE source_machine IN ('DOMAIN_CONTROLLER', 'CLIENT_MACHINE') GROUP BY source_machine""")
def q_machine_split(spark, base):
    raw = _raw(spark, base)
    parts = [normalize.split_by_machine(raw, m).groupBy("source_machine").agg(F.count(F.lit(1)).alias("n_rows"))
             for m in rawmetrics.MACHINES]
    return parts[0].unionByName(parts[1])


@register("table_scan", O.chain("raw_logs") + """
SELECT log_id, timestamp, event_id, username, source_ip, process_name, command_line, source_machine FROM raw_logs""")
def q_table_scan(spark, base):
    return _raw(spark, base)


@register("newest_n", O.chain("raw_logs") + """
SELECT log_id, timestamp, event_id, username, source_ip, process_name, command_line, source_machine FROM raw_logs
ORDER BY timestamp DESC NULLS LAST, log_id DESC LIMIT 1000""")
def q_newest_n(spark, base):
    """The newest rows."""
    return detection.newest(_raw(spark, base), max_rows=NEWEST_N)


@register("raw_count", O.chain("raw_logs") + f"""
SELECT count(*) AS raw_rows FROM raw_logs WHERE timestamp > TIMESTAMP '{CUTOFF}'""")
def q_raw_count(spark, base):
    cutoff = spark.createDataFrame([(CUTOFF,)], "c string").select(F.col("c").cast("timestamp_ntz").alias("watermark_ts"))
    return reports.after_cutoff(_raw(spark, base), cutoff).agg(F.count(F.lit(1)).alias("raw_rows"))


@register("anomaly_threshold", O.chain("raw_logs") + f"""
SELECT log_id, round(value - (SELECT quantile_cont(value, {DEFAULT.contamination}) FROM raw_logs), 6) AS anomaly_score_raw,
 CAST(value - (SELECT quantile_cont(value, {DEFAULT.contamination}) FROM raw_logs) < 0 AS INTEGER) AS is_anomaly,
 CASE WHEN value - (SELECT quantile_cont(value, {DEFAULT.contamination}) FROM raw_logs) < 0 THEN 3 ELSE 0 END AS ml_score
FROM raw_logs""")
def q_anomaly_threshold(spark, base):
    from ..operators import anomaly
    df = fixtures.raw_logs_with_value(spark, base).select("log_id", "value")
    out = anomaly.with_anomaly(df, "value", anomaly.score_offset(df, "value"))
    return out.select("log_id", _r6("anomaly_score_raw"), "is_anomaly",
                      F.when(F.col("is_anomaly") == 1, F.lit(DEFAULT.ml_weight)).otherwise(F.lit(0)).alias("ml_score"))


# ---------------------------------------------------------------- normalisation / flags / features

@register("normalize_logs", O.chain("norm") + """
SELECT log_id, timestamp, event_id, username, source_ip, process_name, command_line, machine, login_hour, day FROM norm""")
def q_normalize_logs(spark, base):
    return normalize.normalize(_raw(spark, base)).select(
        "log_id", "timestamp", "event_id", "username", "source_ip", "process_name", "command_line", "machine",
        "login_hour", "day")


FLAG_COLS = ("is_failed_login", "is_successful_login", "is_privileged", "is_process_exec", "is_kerberos_tgt",
             "is_kerberos_tgs", "suspicious_process", "suspicious_commandline", "after_hours_flag", "is_weekend")


@register("event_flags", O.chain("flags") + f"SELECT log_id, {', '.join(FLAG_COLS)} FROM flags")
def q_event_flags(spark, base):
    return _flags(spark, base).select("log_id", *FLAG_COLS)


@register("subnet_extract", O.chain("flags") + "SELECT log_id, source_ip, ip_subnet FROM flags")
def q_subnet_extract(spark, base):
    return normalize.normalize(_raw(spark, base)).select(
        "log_id", "source_ip", ipcols.subnet24("source_ip").alias("ip_subnet"))


@register("subnet_encode", O.chain("aggs") + "SELECT ip_subnet, ip_subnet_enc FROM subnets")
def q_subnet_encode(spark, base):
    df = normalize.normalize(_raw(spark, base)).withColumn("ip_subnet", ipcols.subnet24("source_ip"))
    return features.subnet_index(df)


@register("user_profile", O.chain("aggs") + """
SELECT username, user_event_count, user_failed_count, user_success_count, user_unique_machines, user_unique_ips,
 round(user_avg_hour, 6) AS user_avg_hour, user_tgs_count FROM users""")
def q_user_profile(spark, base):
    return features.user_profile(_flags(spark, base)).withColumn("user_avg_hour", F.round("user_avg_hour", 6))


@register("ip_profile", O.chain("aggs") + "SELECT source_ip, ip_event_count, ip_unique_failed_users FROM ips")
def q_ip_profile(spark, base):
    return features.ip_profile(_flags(spark, base))


ROW_FEATURES = ("user_event_count", "user_failed_count", "user_success_count", "user_unique_machines",
                "user_unique_ips", "user_tgs_count", "ip_event_count", "ip_unique_failed_users", "ip_subnet",
                "ip_subnet_enc", "failed_last_10min")


@register("row_features", O.chain("feats") + f"""
SELECT log_id, {', '.join(ROW_FEATURES)}, round(hour_deviation, 6) AS hour_deviation FROM feats""")
def q_row_features(spark, base):
    return _features(spark, base).select("log_id", *ROW_FEATURES, _r6("hour_deviation"))


@register("failed_last_10min", O.chain("aggs") + "SELECT log_id, failed_last_10min FROM win")
def q_failed_last_10min(spark, base):
    return features.with_failed_window(_flags(spark, base)).select("log_id", "failed_last_10min")


# ---------------------------------------------------------------- rules and scores

RULE_COLS = ("brute_force_flag", "privilege_escalation_flag", "lateral_movement_flag", "malicious_process_flag",
             "credential_stuffing_flag", "password_spray_flag", "account_enumeration_flag",
             "success_after_fail_flag", "kerberoasting_flag")


@register("rule_flags", O.chain("ruled") + f"""
SELECT log_id, {', '.join(RULE_COLS)},
 CAST(after_hours_flag = 1 AND is_privileged = 1 AS INTEGER) AS after_hours_privileged FROM ruled""")
def q_rule_flags(spark, base):
    from ..operators import rules
    df = rules.with_rules(_features(spark, base))
    return df.select("log_id", *RULE_COLS, ((F.col("after_hours_flag") == 1) & (F.col("is_privileged") == 1))
                     .cast("int").alias("after_hours_privileged"))


@register("mitre_techniques", O.chain() + "SELECT log_id, mitre_techniques FROM analyzed")
def q_mitre_techniques(spark, base):
    return _analyze(spark, base).select("log_id", "mitre_techniques")


@register("rule_scores", O.chain() + """
SELECT log_id, rule_score, ml_score, total_threat_score, final_risk_level, is_anomaly FROM analyzed""")
def q_rule_scores(spark, base):
    return _analyze(spark, base).select("log_id", "rule_score", "ml_score", "total_threat_score",
                                         "final_risk_level", "is_anomaly")


@register("run_summary", O.chain() + """
SELECT count(*) AS total_events, count(*) FILTER (WHERE final_risk_level = 'CRITICAL') AS critical_events,
 count(*) FILTER (WHERE final_risk_level = 'HIGH') AS high_events FROM analyzed""")
def q_run_summary(spark, base):
    return scoring.run_summary(_analyzed(spark, base))


# ---------------------------------------------------------------- reports over analyzed rows

HIGH = "final_risk_level IN ('CRITICAL', 'HIGH')"


@register("summary_kpis", O.chain() + f""",
k AS (SELECT count(*) AS total_events, count(*) FILTER (WHERE is_anomaly = 1) AS total_anomalies,
  sum(total_threat_score) AS score_sum, count(total_threat_score) AS score_n,
  count(*) FILTER (WHERE total_threat_score >= 7) AS high_confidence_cases,
  count(*) FILTER (WHERE total_threat_score BETWEEN 4 AND 6) AS medium_confidence_cases,
  count(*) FILTER (WHERE total_threat_score <= 3) AS low_confidence_cases,
  count(DISTINCT CASE WHEN {HIGH} THEN username END) AS unique_high_users,
  count(DISTINCT CASE WHEN {HIGH} THEN source_ip END) AS unique_high_ips,
  count(DISTINCT CASE WHEN {HIGH} THEN mitre_techniques END) AS unique_mitre_techniques FROM analyzed)
SELECT total_events, total_anomalies, {O.round2('100 * total_anomalies', 'total_events')} AS anomaly_rate,
 {O.round2('score_sum', 'score_n')} AS avg_threat_score,
 high_confidence_cases, medium_confidence_cases, low_confidence_cases, unique_high_users, unique_high_ips,
 unique_mitre_techniques, unique_high_users > 1 AS multi_user_flag, unique_high_ips > 1 AS multi_ip_flag,
 unique_mitre_techniques > 1 AS multi_technique_flag,
 CASE WHEN high_confidence_cases > 5 AND unique_high_users > 1 AND unique_high_ips > 1 AND unique_mitre_techniques > 1
      THEN 'STRONG_CORRELATED_ATTACK' WHEN medium_confidence_cases > 0 THEN 'MODERATE_CORRELATION_NO_CONFIRMED_COMPROMISE'
      ELSE 'LOW_CONFIDENCE_ACTIVITY' END AS machine_verdict,
 CAST(least(100, high_confidence_cases * 5 + medium_confidence_cases * 2 + unique_mitre_techniques * 3
      + unique_high_ips * 2) AS BIGINT) AS confidence_score FROM k""")
def q_summary_kpis(spark, base):
    return reports.summary_kpis(_analyzed(spark, base))


@register("risk_distribution", O.chain() + """
SELECT final_risk_level, count(*) AS count FROM analyzed GROUP BY final_risk_level""")
def q_risk_distribution(spark, base):
    return reports.risk_distribution(_analyzed(spark, base))


@register("risk_distribution_full", O.chain() + """
SELECT l.final_risk_level, CAST(coalesce(c.count, 0) AS BIGINT) AS count
FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW')) l(final_risk_level)
LEFT JOIN (SELECT final_risk_level, count(*) AS count FROM analyzed GROUP BY final_risk_level) c
 ON l.final_risk_level = c.final_risk_level""")
def q_risk_distribution_full(spark, base):
    return reports.risk_distribution_full(_analyzed(spark, base))


INCIDENT_SQL = ", ".join(reports.INCIDENT_COLUMNS)


@register("top_incidents", O.chain() + f"""
SELECT {INCIDENT_SQL} FROM analyzed
ORDER BY total_threat_score DESC, timestamp DESC NULLS LAST, log_id ASC LIMIT 20""")
def q_top_incidents(spark, base):
    return reports.top_incidents(_analyzed(spark, base))


@register("top_high_risk", O.chain() + f"""
SELECT log_id, username, source_ip, final_risk_level, total_threat_score, mitre_techniques FROM analyzed
WHERE {HIGH} ORDER BY total_threat_score DESC, timestamp DESC NULLS LAST, log_id ASC LIMIT 10""")
def q_top_high_risk(spark, base):
    return reports.top_high_risk(_analyzed(spark, base))


TECH_COUNTS_SQL = """tc AS (SELECT trim(t) AS technique, count(*) AS count
 FROM (SELECT unnest(string_split(mitre_techniques, ',')) AS t FROM analyzed) x
 WHERE trim(t) <> '' GROUP BY trim(t))"""


@register("technique_counts", O.chain() + "," + TECH_COUNTS_SQL + " SELECT technique, count FROM tc")
def q_technique_counts(spark, base):
    return reports.technique_counts(_analyzed(spark, base))


@register("technique_top10_short", O.chain() + "," + TECH_COUNTS_SQL + """
SELECT technique, split_part(technique, ' - ', 1) AS short_id, count FROM tc
ORDER BY count DESC, technique ASC LIMIT 10""")
def q_technique_top10_short(spark, base):
    return reports.technique_top10_short(_analyzed(spark, base))


@register("timeline_hourly", O.chain() + """
SELECT strftime(timestamp, '%Y-%m-%d %H:00') AS hour, count(*) AS count FROM analyzed
WHERE timestamp IS NOT NULL GROUP BY 1""")
def q_timeline_hourly(spark, base):
    return reports.timeline_hourly(_analyzed(spark, base))


@register("user_risk_top10", O.chain() + """
SELECT username, max(total_threat_score) AS max_threat_score FROM analyzed WHERE username IS NOT NULL
GROUP BY username ORDER BY max_threat_score DESC, username ASC LIMIT 10""")
def q_user_risk_top10(spark, base):
    return reports.user_risk_top10(_analyzed(spark, base))


@register("ip_top10", O.chain() + """
SELECT source_ip, count(*) AS count FROM analyzed WHERE source_ip IS NOT NULL AND source_ip <> 'N/A'
GROUP BY source_ip ORDER BY count DESC, source_ip ASC LIMIT 10""")
def q_ip_top10(spark, base):
    return reports.ip_top10(_analyzed(spark, base))


@register("incident_search", O.chain() + f"""
SELECT log_id, username, source_ip, final_risk_level, mitre_techniques FROM analyzed
WHERE contains(lower(coalesce(username, '')), '{SEARCH_TERM}') OR contains(lower(coalesce(source_ip, '')), '{SEARCH_TERM}')
   OR contains(lower(coalesce(final_risk_level, '')), '{SEARCH_TERM}')
   OR contains(lower(coalesce(mitre_techniques, '')), '{SEARCH_TERM}')""")
def q_incident_search(spark, base):
    return reports.incident_search(_analyzed(spark, base), SEARCH_TERM).select(
        "log_id", "username", "source_ip", "final_risk_level", "mitre_techniques")


@register("incident_sort", O.chain() + """,
top AS (SELECT log_id, username, source_ip, final_risk_level, total_threat_score FROM analyzed
 ORDER BY total_threat_score DESC, timestamp DESC NULLS LAST, log_id ASC LIMIT 20)
SELECT *, CAST(row_number() OVER (ORDER BY lower(coalesce(username, '')) ASC, log_id ASC) AS INTEGER) AS sort_rank
FROM top""")
def q_incident_sort(spark, base):
    top = reports.top_incidents(_analyzed(spark, base)).select(
        "log_id", "username", "source_ip", "final_risk_level", "total_threat_score")
    return reports.incident_sort(top, "username", descending=False)


@register("after_cutoff", O.chain() + f"""
SELECT log_id, timestamp, final_risk_level, total_threat_score FROM analyzed WHERE timestamp > TIMESTAMP '{CUTOFF}'""")
def q_after_cutoff(spark, base):
    cutoff = spark.createDataFrame([(CUTOFF,)], "c string").select(F.col("c").cast("timestamp_ntz").alias("watermark_ts"))
    return reports.after_cutoff(_analyzed(spark, base), cutoff).select(
        "log_id", "timestamp", "final_risk_level", "total_threat_score")


# ---------------------------------------------------------------- raw-log metrics per collector

def _top_sql(metric: str, key: str, n: int, where: str = "TRUE") -> str:
    return f"""SELECT source_machine, '{metric}' AS metric, key, value, CAST(rank AS INTEGER) AS rank FROM (
 SELECT source_machine, key, value, row_number() OVER (PARTITION BY source_machine ORDER BY value DESC, key ASC) AS rank
 FROM (SELECT source_machine, coalesce(CAST({key} AS VARCHAR), '') AS key, count(*) AS value FROM raw_logs
       WHERE source_machine IN ('DOMAIN_CONTROLLER', 'CLIENT_MACHINE') AND {where} GROUP BY 1, 2) c) r
WHERE rank <= {n} AND trim(key) <> ''"""


@register("event_id_counts", O.chain("raw_logs") + _top_sql("event_id_counts", "event_id", 50))
def q_event_id_counts(spark, base):
    return rawmetrics.event_id_counts(_raw(spark, base))


@register("top_processes", O.chain("raw_logs") + _top_sql("top_processes", "process_name", 15)
          + " UNION ALL " + _top_sql("top_commands", "command_line", 10))
def q_top_processes(spark, base):
    return rawmetrics.top_processes(_raw(spark, base))


@register("raw_metrics", O.chain("raw_logs") + """
SELECT source_machine, count(*) AS rows, count(DISTINCT coalesce(username, '')) AS unique_users,
 count(DISTINCT coalesce(regexp_replace(source_ip, '^\\s+|\\s+$', '', 'g'), '')) AS unique_ips
FROM raw_logs WHERE source_machine IN ('DOMAIN_CONTROLLER', 'CLIENT_MACHINE') GROUP BY source_machine""")
def q_raw_metrics(spark, base):
    return rawmetrics.raw_metrics(_raw(spark, base))


@register("logon_pairs", O.chain("raw_logs") + f""",
pairs AS (SELECT source_machine, concat(coalesce(username, ''), '@',
   coalesce(regexp_replace(source_ip, '^\\s+|\\s+$', '', 'g'), '')) AS key, count(*) AS value
 FROM raw_logs WHERE event_id = {EV_LOGON_SUCCESS} GROUP BY 1, 2 HAVING count(*) >= 5),
machines AS (SELECT * FROM (VALUES ('DOMAIN_CONTROLLER'), ('CLIENT_MACHINE')) m(source_machine))
SELECT m.source_machine, 'brute_force_suspects' AS metric, '' AS key,
 CAST((SELECT count(*) FROM pairs p WHERE p.source_machine = m.source_machine) AS BIGINT) AS value, 0 AS rank
FROM machines m
UNION ALL
SELECT source_machine, 'top_bruteforce_pairs', key, value, CAST(rank AS INTEGER) FROM (
 SELECT *, row_number() OVER (PARTITION BY source_machine ORDER BY value DESC, key ASC) AS rank FROM pairs) r
WHERE rank <= 10""")
def q_logon_pairs(spark, base):
    return rawmetrics.logon_pairs(_raw(spark, base))


NEAR_ANOMALY_SCORE = 6


@register("proc_near_anomaly", O.chain() + f""",
anom AS (SELECT timestamp AS ta FROM analyzed WHERE total_threat_score >= {NEAR_ANOMALY_SCORE} AND timestamp IS NOT NULL),
src AS (SELECT * FROM raw_logs WHERE source_machine = CASE WHEN EXISTS (
   SELECT 1 FROM raw_logs WHERE source_machine = 'DOMAIN_CONTROLLER') THEN 'DOMAIN_CONTROLLER' ELSE 'CLIENT_MACHINE' END),
procs AS (SELECT timestamp AS tp, coalesce(process_name, '') AS name FROM src WHERE event_id = 4688 AND timestamp IS NOT NULL),
m AS (SELECT p.name FROM anom a JOIN procs p
   ON p.tp >= a.ta - INTERVAL 15 MINUTE AND p.tp <= a.ta + INTERVAL 15 MINUTE),
c AS (SELECT name AS key, count(*) AS value FROM m GROUP BY name)
SELECT 'matches' AS metric, '' AS key, CAST((SELECT count(*) FROM m) AS BIGINT) AS value, 0 AS rank, 15 AS window_minutes
UNION ALL
SELECT 'top_processes', key, value, CAST(rank AS INTEGER), 15 FROM (
 SELECT *, row_number() OVER (ORDER BY value DESC, key ASC) AS rank FROM c) r WHERE rank <= 10 AND trim(key) <> ''""")
def q_proc_near_anomaly(spark, base):
    analyzed = _analyzed(spark, base)
    anomalies = analyzed.where(F.col("total_threat_score") >= NEAR_ANOMALY_SCORE)
    raw = _raw(spark, base)
    dc = normalize.split_by_machine(raw, "DOMAIN_CONTROLLER")
    logs = dc if dc.limit(1).count() > 0 else normalize.split_by_machine(raw, "CLIENT_MACHINE")
    return rawmetrics.process_near_anomalies(anomalies, logs, DEFAULT.near_anomaly_minutes)


# ---------------------------------------------------------------- text guardrails over reports

from ..operators import guardrails as G  # noqa: E402
from ..operators import retrieval as V  # noqa: E402
from . import evidence  # noqa: E402


def _reports(spark, base) -> DataFrame:
    return fixtures.reports(spark, base)


@register("prompt_scrub", O.chain("raw_logs") + "," + O.REPORTS + f"""
SELECT id, {O.scrub_sql('text', None)} AS scrubbed FROM reports""")
def q_prompt_scrub(spark, base):
    """G1 over whole report texts."""
    return _reports(spark, base).select("id", G.scrub("text", None).alias("scrubbed"))


@register("technique_split", O.chain() + f""",
p AS (SELECT log_id, {O.split_sql('mitre_techniques')} AS parts FROM analyzed)
SELECT log_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS pos, unnest(parts) AS part FROM p""")
def q_technique_split(spark, base):
    return _analyzed(spark, base).select("log_id", F.posexplode(G.split_techniques("mitre_techniques"))
                                         .alias("pos", "part"))


ALLOWED_TECH_SQL = f"""allowed_t AS (
 SELECT technique, CASE WHEN regexp_extract(technique, '\\b(T\\d{{4,5}}(?:\\.\\d{{3}})?)\\b', 1) = '' THEN 'ZZZZZ'
   ELSE regexp_extract(technique, '\\b(T\\d{{4,5}}(?:\\.\\d{{3}})?)\\b', 1) END AS sort_id
 FROM (SELECT DISTINCT {O.scrub_sql(O.strip_sql("regexp_replace(t, '\\s+', ' ', 'g')"))} AS technique
       FROM (SELECT unnest({O.split_sql('mitre_techniques')}) AS t FROM analyzed
             WHERE final_risk_level IN ('CRITICAL', 'HIGH')) x) y
 WHERE technique <> '' AND technique <> 'N/A'),
ranked_t AS (SELECT technique, sort_id, CAST(row_number() OVER (ORDER BY sort_id, technique) AS INTEGER) AS rank
 FROM allowed_t)"""


@register("allowed_techniques", O.chain() + "," + ALLOWED_TECH_SQL + " SELECT technique, sort_id, rank FROM ranked_t")
def q_allowed_techniques(spark, base):
    return G.allowed_techniques(_analyzed(spark, base))


@register("technique_ids", O.chain("raw_logs") + "," + O.REPORTS + f"""
SELECT id, array_to_string({O.ids_sql('text')}, ',') AS ids FROM reports""")
def q_technique_ids(spark, base):
    return _reports(spark, base).select("id", F.array_join(G.technique_ids("text"), ",").alias("ids"))


@register("allowed_ids", O.chain("raw_logs") + "," + O.REPORTS + f"""
SELECT id, array_to_string(list_sort({O.allowed_ids_sql('allowed')}), ',') AS allowed_ids FROM reports""")
def q_allowed_ids(spark, base):
    return _reports(spark, base).select("id", F.array_join(F.array_sort(G.allowed_ids("allowed")), ",")
                                        .alias("allowed_ids"))


@register("report_validate", O.chain("raw_logs") + "," + O.REPORTS + f""",
v AS (SELECT id, list_concat(list_concat(
   CASE WHEN contains(lower(coalesce(text, '')), 'known compromised') OR contains(lower(coalesce(text, '')), 'compromised ip')
        THEN [{O._q(G.REASON_COMPROMISED)}] ELSE [] END,
   list_transform(list_filter({O.ids_sql('text')}, lambda i: NOT list_contains({O.allowed_ids_sql('allowed')}, i)),
                  lambda i: concat({O._q(G.REASON_ID)}, i))),
   CASE WHEN contains(lower(coalesce(text, '')), 'credential stuffing')
         AND NOT contains(lower(array_to_string(coalesce(allowed, []), ' ')), 'credential stuffing')
        THEN [{O._q(G.REASON_STUFFING)}] ELSE [] END) AS reasons FROM reports)
SELECT id, len(reasons) = 0 AS ok, CAST(len(reasons) AS INTEGER) AS n_reasons,
 array_to_string(reasons, ' | ') AS reasons_text FROM v""")
def q_report_validate(spark, base):
    v = _reports(spark, base).select("id", G.validate("text", "allowed").alias("v"))
    return v.select("id", F.col("v.ok").alias("ok"), F.size("v.reasons").alias("n_reasons"),
                    F.array_join("v.reasons", " | ").alias("reasons_text"))


@register("report_soften", O.chain("raw_logs") + "," + O.REPORTS + f"""
SELECT id, {O.soften_sql('text', 'allowed')} AS softened FROM reports""")
def q_report_soften(spark, base):
    return _reports(spark, base).select("id", G.soften("text", "allowed").alias("softened"))


@register("report_squeeze", O.chain("raw_logs") + "," + O.REPORTS + f"""
SELECT id, {O.squeeze_sql('text')} AS squeezed FROM reports""")
def q_report_squeeze(spark, base):
    return _reports(spark, base).select("id", G.squeeze("text").alias("squeezed"))


@register("report_sanitize")
def q_report_sanitize(spark, base):
    """G7–G12 (rows-only: the id filter needs a look-ahead RE2 lacks)."""
    return _reports(spark, base).select("id", G.sanitize("text", "allowed").alias("sanitized"))


@register("evidence_lines", O.chain() + "," + ALLOWED_TECH_SQL + f""",
top8 AS (SELECT *, CAST(row_number() OVER (ORDER BY total_threat_score DESC, log_id ASC) AS INTEGER) AS rank FROM (
  SELECT * FROM analyzed WHERE final_risk_level IN ('CRITICAL', 'HIGH')
  ORDER BY total_threat_score DESC, timestamp DESC NULLS LAST, log_id ASC LIMIT 10) t
  ORDER BY total_threat_score DESC, log_id ASC LIMIT 8),
inc AS (SELECT 'incident' AS section, rank, concat('  ', CAST(rank AS VARCHAR), '. User=', {O.scrub_sql('username')},
  ' | IP=', {O.scrub_sql('source_ip')}, ' | Risk=', coalesce(final_risk_level, 'None'), ' | Score=',
  CAST(total_threat_score AS VARCHAR), ' | Techniques=', {O.scrub_sql('mitre_techniques')}) AS line FROM top8),
tech AS (SELECT 'technique' AS section, rank, concat('  ', CAST(rank AS VARCHAR), '. ', technique) AS line FROM ranked_t),
k AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_anomaly = 1) AS a,
  count(*) FILTER (WHERE total_threat_score >= 7) AS hi, count(*) FILTER (WHERE total_threat_score BETWEEN 4 AND 6) AS med,
  count(DISTINCT CASE WHEN final_risk_level IN ('CRITICAL', 'HIGH') THEN username END) AS u,
  count(DISTINCT CASE WHEN final_risk_level IN ('CRITICAL', 'HIGH') THEN source_ip END) AS ip FROM analyzed),
kt AS (SELECT *, ((CASE WHEN n > 0 THEN (20000 * a + n) // (2 * n) ELSE 0 END) + 5) // 10 AS tenths FROM k),
risk AS (SELECT 'risk' AS section, 1 AS rank, concat('The ML model flagged ', format('{{:,}}', a), ' anomalies out of ',
  format('{{:,}}', n), ' events (', CAST(tenths // 10 AS VARCHAR), '.', CAST(tenths % 10 AS VARCHAR),
  '% anomaly rate), with ', CAST(hi AS VARCHAR), ' high-confidence and ', CAST(med AS VARCHAR),
  ' medium-confidence cases across ', CAST(u AS VARCHAR), ' distinct user(s) and ', CAST(ip AS VARCHAR),
  ' distinct source IP(s).') AS line FROM kt)
SELECT * FROM inc UNION ALL SELECT 'incident', 0, '{evidence.NO_INCIDENTS}' WHERE NOT EXISTS (SELECT 1 FROM inc)
UNION ALL SELECT * FROM tech UNION ALL SELECT 'technique', 0, '{evidence.NO_TECHNIQUES}' WHERE NOT EXISTS (SELECT 1 FROM tech)
UNION ALL SELECT * FROM risk""")
def q_evidence_lines(spark, base):
    # Reports read the saved analyzed table, as every dashboard reader does.
    analyzed = detection.analyze_saved(fixtures.raw_logs_with_value(spark, base), model="score", score_col="value")
    return evidence.evidence_lines(analyzed)


@register("retrieval_query", O.chain() + "," + ALLOWED_TECH_SQL + f"""
SELECT CAST(count(*) AS INTEGER) AS n_techniques,
 CASE WHEN count(*) > 0 THEN concat({O._q(V.QUERY_PREFIX)}, string_agg(technique, ', ' ORDER BY rank)) END AS query_text
FROM ranked_t""")
def q_retrieval_query(spark, base):
    techs = G.allowed_techniques(_analyzed(spark, base)).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "technique"))), lambda s: s["technique"]).alias("t"))
    return techs.select(F.size("t").alias("n_techniques"), V.retrieval_query(F.col("t")).alias("query_text"))


KNN_SQL = """e AS (SELECT vec_id, label, embedding FROM embeddings),
parts AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v
  FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM e) x GROUP BY label, i),
cent AS (SELECT label AS query_id, list(v ORDER BY i) AS q FROM parts GROUP BY label),
dist AS (SELECT c.query_id, e.vec_id, e.label,
  round(list_sum(list_transform(generate_series(1, len(c.q)),
        lambda i: (c.q[i] - CAST(e.embedding[i] AS DOUBLE)) * (c.q[i] - CAST(e.embedding[i] AS DOUBLE)))), 6) AS distance
  FROM cent c JOIN e ON true),
hits AS (SELECT query_id, vec_id, label, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist) r WHERE rank <= 3)"""


def _knn_hits(spark, base) -> DataFrame:
    emb = fixtures.read_table(spark, base, "embeddings")
    queries = V.centroids(emb, "label").withColumnRenamed("label", "query_id")
    return V.knn(emb, queries).join(emb.select("vec_id", "label"), "vec_id")


@register("knn_top3", "WITH " + KNN_SQL + " SELECT query_id, vec_id, distance, rank FROM hits")
def q_knn_top3(spark, base):
    return _knn_hits(spark, base).select("query_id", "vec_id", "distance", "rank")


@register("context_join", "WITH " + KNN_SQL + """
SELECT query_id, string_agg(concat('vector ', CAST(vec_id AS VARCHAR), ' (label ', CAST(label AS VARCHAR), ')'),
  chr(10) || chr(10) ORDER BY rank) AS context FROM hits GROUP BY query_id""")
def q_context_join(spark, base):
    hits = _knn_hits(spark, base).withColumn(
        "text", F.concat(F.lit("vector "), F.col("vec_id").cast("string"), F.lit(" (label "),
                         F.col("label").cast("string"), F.lit(")")))
    return V.context_join(hits)


# ---------------------------------------------------------------- rows-only: model, full run, text jobs

@register("anomaly_scores")
def q_anomaly_scores(spark, base):
    """M1–M6: fit the isolation forest on the feature rows and score them."""
    an = detection.analyze(_raw(spark, base), model="forest")
    return an.select("log_id", "anomaly_score_raw", "is_anomaly")


@register("full_detection")
def q_full_detection(spark, base):
    """Everything: features, forest, rules, techniques, scores; saved, as a run does."""
    _SAVED[spark.sparkContext.applicationId, base, "forest"] = saved = detection.analyze_saved(_raw(spark, base), model="forest")
    return saved


@register("evidence_summary")
def q_evidence_summary(spark, base):
    """R18 over the forest-scored run, read from where the session's last run saved it."""
    saved = _SAVED.get((spark.sparkContext.applicationId, base, "forest"))
    return evidence.evidence_summary(q_full_detection(spark, base) if saved is None else saved, _raw(spark, base))


@register("chunk_documents")
def q_chunk_documents(spark, base):
    """V1 over every document."""
    docs = fixtures.read_table(spark, base, "documents", balance=True).select(
        F.col("doc_id").cast("string").alias("doc_path"), "text")
    return V.chunk_documents(docs)


@register("embed_chunks")
def q_embed_chunks(spark, base):
    """V2: hashed TF-IDF vectors for every chunk."""
    chunks = materialize(V.term_counts(q_chunk_documents(spark, base)), "chunks")  # read by the fit and the transform
    model = V.fit_embedder(chunks)
    return V.embed(model, chunks).select("doc_path", "chunk_idx", "embedding")


# ---------------------------------------------------------------- collectors over derived event records

def _records_sql() -> str:
    def arr(width, at):
        return "[" + ", ".join(at.get(i, "'-'") for i in range(width)) + "]"
    user = "coalesce(username, '-')"
    lt = "CASE log_id % 4 WHEN 0 THEN '2' WHEN 1 THEN '3' WHEN 2 THEN '10' ELSE '-' END"
    ip18 = "CASE log_id % 5 WHEN 0 THEN concat('::ffff:', source_ip) WHEN 1 THEN concat(' ', source_ip) WHEN 2 THEN '-' ELSE source_ip END"
    ip9 = "CASE log_id % 3 WHEN 0 THEN source_ip WHEN 1 THEN 'x' ELSE '-' END"
    ins = (f"CASE WHEN event_id IN (4624, 4625) THEN {arr(20, {5: user, 8: lt, 18: ip18})} "
           f"WHEN event_id = 4672 THEN {arr(3, {1: user})} "
           f"WHEN event_id IN (4768, 4769) THEN {arr(13, {0: user, 9: ip9, 12: 'source_ip'})} "
           f"ELSE {arr(9, {1: user, 5: 'process_name', 8: 'command_line'})} END")
    return f"""recs AS (SELECT log_id AS record_number, event_id + 65536 * (log_id % 3) AS event_id_raw,
  CASE WHEN log_id % 2 = 0 THEN strftime(timestamp, '%Y-%m-%d %H:%M:%S') ELSE strftime(timestamp, '%a %b %d %H:%M:%S %Y') END
    AS time_generated, {ins} AS s, concat('h', CAST(log_id % 4 AS VARCHAR)) AS host,
  CASE WHEN source_machine = 'DOMAIN_CONTROLLER' THEN 'dc' ELSE 'client' END AS profile,
  concat('10.9.9.', CAST(log_id % 7 AS VARCHAR)) AS host_ip FROM raw_logs),
masked AS (SELECT *, CAST(event_id_raw & 65535 AS INTEGER) AS ev FROM recs),
kept AS (SELECT * FROM masked WHERE (profile = 'dc' AND ev IN (4624, 4625, 4672, 4768, 4769, 4688))
   OR (profile = 'client' AND ev IN (4624, 4625, 4688)))"""


def _projection_sql() -> str:
    sg, rg = O.safe_get_sql, O.raw_get_sql
    first_ip = f"list_filter(s, lambda e: e IS NOT NULL AND {O.looks_like_sql('e')})[1]"
    dc_user = (f"CASE WHEN ev IN (4624, 4625) THEN {sg('s', 5)} WHEN ev = 4672 THEN {sg('s', 1)} "
               f"WHEN ev IN (4768, 4769) THEN {sg('s', 0)} WHEN ev = 4688 THEN {sg('s', 1)} ELSE 'N/A' END")
    kerb_ip = (f"CASE WHEN {O.looks_like_sql(sg('s', 9, ''))} THEN {O.dc_sanitize_sql(sg('s', 9, ''))} "
               f"WHEN {first_ip} IS NULL THEN '127.0.0.1' ELSE {O.dc_sanitize_sql(O.strip_sql(first_ip))} END")
    dc_ip = (f"CASE WHEN ev IN (4624, 4625) THEN CASE WHEN {sg('s', 8, '0')} IN ('2', '0') THEN '127.0.0.1' "
             f"ELSE {O.dc_sanitize_sql(sg('s', 18, ''))} END WHEN ev = 4672 THEN '127.0.0.1' "
             f"WHEN ev IN (4768, 4769) THEN {kerb_ip} WHEN ev = 4688 THEN '127.0.0.1' ELSE 'N/A' END")
    has = "s IS NOT NULL AND len(s) > 0"
    cl_user = (f"CASE WHEN {has} AND ev IN (4624, 4625) THEN {rg('s', 5, 'N/A')} "
               f"WHEN {has} AND ev = 4688 THEN {rg('s', 1, 'N/A')} ELSE 'N/A' END")
    cl_ip = (f"CASE WHEN {has} AND ev IN (4624, 4625) THEN {O.client_sanitize_sql(rg('s', 18, '127.0.0.1'))} "
             f"WHEN {has} AND ev = 4688 THEN coalesce(host_ip, '127.0.0.1') ELSE '127.0.0.1' END")
    ts = ("coalesce(try_strptime(time_generated, '%Y-%m-%d %H:%M:%S'), "
          "try_strptime(time_generated, '%a %b %d %H:%M:%S %Y'))")
    return f"""
SELECT host, record_number, {ts} AS timestamp, ev AS event_id,
 CASE WHEN profile = 'dc' THEN {dc_user} ELSE {cl_user} END AS username,
 CASE WHEN profile = 'dc' THEN {dc_ip} ELSE {cl_ip} END AS source_ip,
 CASE WHEN profile = 'dc' THEN CASE WHEN ev = 4688 THEN {sg('s', 5)} ELSE 'N/A' END
      ELSE CASE WHEN {has} AND ev = 4688 THEN {rg('s', 5, 'N/A')} ELSE 'N/A' END END AS process_name,
 CASE WHEN profile = 'dc' THEN CASE WHEN ev = 4688 THEN {sg('s', 8, '')} ELSE 'N/A' END
      ELSE CASE WHEN {has} AND ev = 4688 THEN {rg('s', 8, 'N/A')} ELSE 'N/A' END END AS command_line,
 CASE WHEN profile = 'dc' THEN 'DOMAIN_CONTROLLER' ELSE 'CLIENT_MACHINE' END AS source_machine
FROM kept"""


@register("win_event_projection", O.chain("raw_logs") + "," + _records_sql() + _projection_sql())
def q_win_event_projection(spark, base):
    from ..sources import records, winevents
    # ``log_id`` is a Spark hash of (host, record_number); the projection is compared without it.
    return winevents.to_raw_logs(records.records_from_raw(_raw(spark, base)), host_ip_col="host_ip").drop("log_id")


UPLOAD_ROWS = 40


def _payloads(spark, base) -> DataFrame:
    """JSON upload bodies built from raw_logs: ``UPLOAD_ROWS`` rows per body,
    with some empty-array and non-array bodies."""
    raw = _raw(spark, base)
    pid = F.floor(F.col("log_id") / UPLOAD_ROWS).cast("bigint")
    item = F.struct(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "event_id", "username",
                    "source_ip", "process_name", "command_line", "source_machine")
    grouped = raw.groupBy(pid.alias("payload_id")).agg(F.to_json(F.collect_list(item)).alias("json"))
    p = F.col("payload_id")
    return grouped.select("payload_id", F.when(p % 25 == 0, F.lit("{}")).when(p % 25 == 1, F.lit("[]"))
                          .otherwise(F.col("json")).alias("body"))


@register("upload_parse", O.chain("raw_logs") + f""",
grouped AS (SELECT CAST(floor(log_id / {UPLOAD_ROWS}) AS BIGINT) AS payload_id,
  to_json(list({{'timestamp': strftime(timestamp, '%Y-%m-%d %H:%M:%S'), 'event_id': event_id, 'username': username,
   'source_ip': source_ip, 'process_name': process_name, 'command_line': command_line,
   'source_machine': source_machine}})) AS json FROM raw_logs GROUP BY 1),
payloads AS (SELECT payload_id, CASE WHEN payload_id % 25 = 0 THEN '{{}}' WHEN payload_id % 25 = 1 THEN '[]'
  ELSE json END AS body FROM grouped),
parsed AS (SELECT payload_id, unnest(from_json(body, '[{{"timestamp":"VARCHAR","event_id":"VARCHAR","username":"VARCHAR",
  "source_ip":"VARCHAR","process_name":"VARCHAR","command_line":"VARCHAR","source_machine":"VARCHAR"}}]')) AS r
  FROM payloads WHERE coalesce(json_array_length(body) > 0, false))
SELECT payload_id, 'accepted' AS status, r.timestamp AS timestamp, TRY_CAST(r.event_id AS INTEGER) AS event_id,
 r.username AS username, r.source_ip AS source_ip, r.process_name AS process_name, r.command_line AS command_line,
 r.source_machine AS source_machine FROM parsed
UNION ALL
SELECT payload_id, 'rejected', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM payloads
WHERE NOT coalesce(json_array_length(body) > 0, false)""")
def q_upload_parse(spark, base):
    from ..sources import upload
    rows, rejected = upload.parse_uploads(_payloads(spark, base))
    fields = upload.UPLOAD_FIELDS
    acc = rows.select("payload_id", F.lit("accepted").alias("status"), *fields)
    rej = rejected.select("payload_id", F.lit("rejected").alias("status"),
                          *[F.lit(None).cast("int" if f == "event_id" else "string").alias(f) for f in fields])
    return acc.unionByName(rej)


@register("runbook_context")
def q_runbook_context(spark, base):
    """V2–V5: context for the run's allowed techniques, retrieved from the
    chunked ``documents`` corpus."""
    from . import context
    chunks = materialize(V.term_counts(q_chunk_documents(spark, base)), "chunks")
    return context.runbook_context(_analyzed(spark, base), chunks)


def _sectioned(spark, base) -> DataFrame:
    return fixtures.sectioned_reports_from_documents(fixtures.read_table(spark, base, "documents", balance=True))


@register("report_list_filter", "WITH " + O.SECTIONED + f"""
SELECT id, {O.list_filter_sql('text', 'allowed')} AS filtered FROM sectioned""")
def q_report_list_filter(spark, base):
    """G9 on sectioned report texts."""
    return _sectioned(spark, base).select("id", G.drop_disallowed_list_lines("text", "allowed").alias("filtered"))


@register("report_mitre_rewrite", "WITH " + O.SECTIONED + f"""
SELECT id, {O.mitre_rewrite_sql('text', 'allowed')} AS rewritten FROM sectioned""")
def q_report_mitre_rewrite(spark, base):
    """G11 on sectioned report texts."""
    return _sectioned(spark, base).select("id", G.rewrite_mitre_section("text", "allowed").alias("rewritten"))


@register("conversation_scrub", f"""
SELECT conv_id, turn, role, {O.scrub_sql('text', None)} AS scrubbed FROM conversations""")
def q_conversation_scrub(spark, base):
    """G1 over every conversation turn (realistic chat text)."""
    conv = fixtures.read_table(spark, base, "conversations", balance=True)
    return conv.select("conv_id", "turn", "role", G.scrub("text", None).alias("scrubbed"))
