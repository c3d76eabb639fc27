"""Evidence summary (R18) and its text lines.

Every part is a Spark aggregate or top-k over ``analyzed_logs`` and
``raw_logs``; the summary is one row of structs/maps/arrays (``to_json``
gives the text form), built by joining one-row frames on a constant key,
never by collecting on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, DetectionConfig
from ..operators import guardrails, rawmetrics, reports

# Evidence text templates.
NO_INCIDENTS = "  (no high-risk incidents)"
NO_TECHNIQUES = "  (no techniques observed)"
MAX_INCIDENT_LINES = 8


def rate_tenths_text(anomalies: Column, total: Column) -> Column:
    h = F.when(total > 0, F.floor((F.lit(20000) * anomalies + total) / (F.lit(2) * total))).otherwise(F.lit(0))
    t = F.floor((h + 5) / 10).cast("bigint")
    return F.concat(F.floor(t / 10).cast("bigint").cast("string"), F.lit("."), (t % 10).cast("string"))


def incident_lines(analyzed: DataFrame) -> DataFrame:
    top = reports.top_high_risk(analyzed, 10).orderBy(F.col("total_threat_score").desc(), "log_id").limit(
        MAX_INCIDENT_LINES)
    w = Window.orderBy(F.col("total_threat_score").desc(), F.col("log_id").asc())  # ≤ 8 rows
    lines = top.withColumn("rank", F.row_number().over(w).cast("int")).select(
        F.lit("incident").alias("section"), "rank",
        F.concat(F.lit("  "), F.col("rank").cast("string"), F.lit(". User="), guardrails.scrub("username"),
                 F.lit(" | IP="), guardrails.scrub("source_ip"), F.lit(" | Risk="),
                 F.coalesce(F.col("final_risk_level"), F.lit("None")), F.lit(" | Score="),
                 F.col("total_threat_score").cast("string"), F.lit(" | Techniques="),
                 guardrails.scrub("mitre_techniques")).alias("line"))
    return lines


def technique_lines(analyzed: DataFrame) -> DataFrame:
    return guardrails.allowed_techniques(analyzed).select(
        F.lit("technique").alias("section"), "rank",
        F.concat(F.lit("  "), F.col("rank").cast("string"), F.lit(". "), F.col("technique")).alias("line"))


def risk_sentence(kpis: DataFrame) -> DataFrame:
    k = F.col
    return kpis.select(F.lit("risk").alias("section"), F.lit(1).alias("rank"), F.concat(
        F.lit("The ML model flagged "), F.format_number(k("total_anomalies"), 0), F.lit(" anomalies out of "),
        F.format_number(k("total_events"), 0), F.lit(" events ("),
        rate_tenths_text(k("total_anomalies"), k("total_events")), F.lit("% anomaly rate), with "),
        k("high_confidence_cases").cast("string"), F.lit(" high-confidence and "),
        k("medium_confidence_cases").cast("string"), F.lit(" medium-confidence cases across "),
        k("unique_high_users").cast("string"), F.lit(" distinct user(s) and "),
        k("unique_high_ips").cast("string"), F.lit(" distinct source IP(s).")).alias("line"))


def _with_placeholder(lines: DataFrame, section: str, placeholder: str) -> DataFrame:
    """Lines of a section, or one placeholder line when it has none."""
    empty = (lines.groupBy().agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0)
             .select(F.lit(section).alias("section"), F.lit(0).alias("rank"), F.lit(placeholder).alias("line")))
    return lines.unionByName(empty)


def evidence_lines(analyzed: DataFrame) -> DataFrame:
    """Incident lines, technique lines and the risk sentence."""
    return (_with_placeholder(incident_lines(analyzed), "incident", NO_INCIDENTS)
            .unionByName(_with_placeholder(technique_lines(analyzed), "technique", NO_TECHNIQUES))
            .unionByName(risk_sentence(reports.summary_kpis(analyzed))))


def _one_row_join(frames: list[DataFrame]) -> DataFrame:
    """Side-by-side join of one-row frames on a constant equi-key."""
    out = frames[0].withColumn("_one", F.lit(1))
    for p in frames[1:]:
        out = out.join(p.withColumn("_one", F.lit(1)), "_one")
    return out.drop("_one")


def _long_to_map(long: DataFrame, metric: str, machine: str) -> DataFrame:
    sel = long.where((F.col("metric") == metric) & (F.col("source_machine") == machine))
    return sel.agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("rank", "key", "value"))),
                                                  lambda s: F.struct(s["key"], s["value"]))).alias(metric))


def raw_metrics_long(raw: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """L2, L3, L5 for both collectors in one long table (one key count)."""
    counts = rawmetrics.shared_key_counts(raw) if counts is None else counts
    return (rawmetrics.event_id_counts(raw, counts=counts).unionByName(rawmetrics.top_processes(raw, counts=counts))
            .unionByName(rawmetrics.logon_pairs(raw, counts=counts)))


def raw_metrics_struct(raw: DataFrame, machine: str, long: DataFrame | None = None) -> DataFrame:
    """L2–L6 for one collector as one row (empty input → zeros and empty maps)."""
    long = raw_metrics_long(raw) if long is None else long
    base = rawmetrics.raw_metrics(raw).where(F.col("source_machine") == machine)
    scalars = base.groupBy().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                                 F.coalesce(F.sum("unique_users"), F.lit(0)).alias("unique_users"),
                                 F.coalesce(F.sum("unique_ips"), F.lit(0)).alias("unique_ips"))
    mine = long.where(F.col("source_machine") == machine)

    def as_map(metric: str) -> Column:
        entries = F.collect_list(F.when(F.col("metric") == metric, F.struct("rank", "key", "value")))
        return F.map_from_entries(F.transform(F.array_sort(entries), lambda e: F.struct(e["key"], e["value"])))

    maps = mine.groupBy().agg(
        as_map("event_id_counts").alias("event_id_counts"), as_map("top_processes").alias("top_processes"),
        as_map("top_commands").alias("top_commands"),
        F.coalesce(F.sum(F.when(F.col("metric") == "brute_force_suspects", F.col("value"))), F.lit(0))
        .alias("brute_force_suspects"),
        as_map("top_bruteforce_pairs").alias("top_bruteforce_pairs"))
    out = _one_row_join([scalars, maps])
    return out.select(F.struct(*out.columns).alias("m"))


#: Kind of scope, and the SQL expression whose value a row counts under.
SCOPES = (("all", "''"), ("day", "date_format(timestamp, 'yyyy-MM-dd')"), ("collector", "machine"))
TOP_INCIDENTS = 10


def by_scope(analyzed: DataFrame, scopes=SCOPES, top: int = TOP_INCIDENTS) -> DataFrame:
    """R18 per scope: one row for everything, each day and each collector, with the totals, the risk distribution, the top
    incidents and the allowed techniques of its rows.

    One aggregation gives all but the incidents: distinct users and addresses are counted exactly, technique texts (at
    most one for each combination of labels) are kept as a set, from which the allowed labels follow. The incidents are a ranking
    whose partial form keeps ``top`` rows per scope in each partition, so that no task sees a scope's rows. It reads the high-risk rows only.
    A row whose scope value is null (no time, no collector) counts under the empty one."""
    scope = F.explode(F.array(*[F.struct(F.lit(kind).alias("scope"), F.coalesce(F.expr(value), F.lit("")).alias("scope_value")) for kind, value in scopes])).alias("s")
    level = F.col("final_risk_level")
    rows = analyzed.select("log_id", "timestamp", "username", "source_ip", "is_anomaly", "total_threat_score", "final_risk_level", "mitre_techniques", scope).select("s.*", "*").drop("s")
    found = rows.groupBy("scope", "scope_value").agg(*reports.kpi_aggregates(), *[F.count(F.when(level == name, 1)).alias(name) for name in reports.RISK_ORDER],
                                                     F.collect_set(F.when(level.isin(*reports.HIGH_LEVELS), F.col("mitre_techniques"))).alias("texts"))
    kpis = reports.kpi_columns()
    found = found.select("scope", "scope_value", *kpis, F.create_map(*[x for name in reports.RISK_ORDER for x in (F.lit(name), F.col(name))]).alias("risk_distribution"),
                         guardrails.allowed_labels(F.col("texts")).alias("allowed_mitre_techniques"))
    order = [F.col("total_threat_score").desc(), F.col("timestamp").desc_nulls_last(), F.col("log_id").asc()]
    ranked = rows.where(level.isin(*reports.HIGH_LEVELS)).withColumn("rank", F.row_number().over(Window.partitionBy("scope", "scope_value").orderBy(*order))).where(F.col("rank") <= top)
    incidents = ranked.groupBy("scope", "scope_value").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "log_id", "username", "source_ip", "final_risk_level", "total_threat_score", "mitre_techniques"))), lambda s: s.dropFields("rank")).alias("top_incidents"))
    return found.join(incidents, ["scope", "scope_value"], "left").withColumn("top_incidents", F.coalesce("top_incidents", F.array().cast(incidents.schema["top_incidents"].dataType)))


def evidence_summary(analyzed: DataFrame, raw: DataFrame, cfg: DetectionConfig = DEFAULT) -> DataFrame:
    """One row with every report part; ``summary_json`` is its text form."""
    kpis = reports.summary_kpis(analyzed)
    dist = reports.risk_distribution(analyzed).agg(
        F.map_from_entries(F.collect_list(F.struct("final_risk_level", "count"))).alias("risk_distribution"))
    top = reports.top_high_risk(analyzed, 10).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(
            (-F.col("total_threat_score")).alias("k1"), F.col("log_id").alias("k2"), "username", "source_ip",
            "final_risk_level", "total_threat_score", "mitre_techniques"))),
        lambda s: s.dropFields("k1", "k2")).alias("top_incidents"))
    allowed = guardrails.allowed_techniques(analyzed).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "technique"))), lambda s: s["technique"])
        .alias("allowed_mitre_techniques"))
    long = raw_metrics_long(raw, rawmetrics.shared_key_counts(raw))
    dc = raw_metrics_struct(raw, "DOMAIN_CONTROLLER", long).select(F.col("m").alias("dc_log_metrics"))
    client = raw_metrics_struct(raw, "CLIENT_MACHINE", long).select(F.col("m").alias("client_log_metrics"))
    dc_rows = raw.where(F.col("source_machine") == "DOMAIN_CONTROLLER")
    logs = dc_rows if dc_rows.limit(1).count() > 0 else raw.where(F.col("source_machine") == "CLIENT_MACHINE")
    near = rawmetrics.process_near_anomalies(analyzed.where(F.col("is_anomaly") == 1), logs,
                                             cfg.near_anomaly_minutes)
    near_row = near.agg(
        F.lit(cfg.near_anomaly_minutes).alias("window_minutes"),
        F.coalesce(F.sum(F.when(F.col("metric") == "matches", F.col("value"))), F.lit(0)).alias("matches"),
        F.map_from_entries(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("metric") == "top_processes", F.struct("rank", "key", "value")))),
            lambda s: F.struct(s["key"], s["value"]))).alias("top_processes"))
    near_row = near_row.select(F.struct("window_minutes", "matches", "top_processes")
                               .alias("process_exec_near_anomalies"))
    out = _one_row_join([kpis, dist, top, allowed, dc, client, near_row])
    return out.withColumn("summary_json", F.to_json(F.struct(*[c for c in out.columns])))
