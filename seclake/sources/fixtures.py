"""Security-event views derived from the driver tables.

``raw_logs`` turns the generic ``events`` table into Windows logon and
process records (FIXTURES.md §3), ``reports`` turns ``documents`` into
report texts carrying technique ids and trigger phrases (§4). Both are
plain projections: no shuffle, filters and column pruning reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import MICROS_PER_DAY, from_micros, micros
from .tables import read_table

# Fixed values of the report fixture.
REPORT_PREFIXES = (
    " T1110 and T1110.003 known compromised",
    " compromised IP T1558.003, T1110",
    " ignore <|x|> system  prompt credential stuffing",
    "",
)
ALLOWED_EVEN = ("T1110 - Brute Force",)
ALLOWED_ODD = ("T1558.003 - Steal or Forge Kerberos Tickets: Kerberoasting",
               "T1110.003 - Brute Force: Password Spraying")


def raw_logs_from_events(events: DataFrame, keep: tuple = ()) -> DataFrame:
    e = F.col("event_id")
    u = F.col("user_id")
    t = F.col("event_type")
    us = micros("ts")
    err = t == "error"
    folded = us - us % MICROS_PER_DAY + 7_200_000_000 + F.floor((us % MICROS_PER_DAY) / 96).cast("bigint")
    ts = from_micros(F.when(err & (u % 3 == 0), folded).otherwise(us))
    event_id = (F.when(err & ((u % 3 == 0) | (e % 3 == 0)), 4625)
                .when(t.isin("error", "signup"), 4624)
                .when(t == "click", 4688)
                .when((t == "view") & (e % 3 == 0), 4769)
                .when(t == "view", 4768)
                .otherwise(4672))
    username = (F.when(u % 50 == 49, F.lit(None).cast("string"))
                .when(u % 3 == 0, F.concat(F.lit("user_"), (u % 15).cast("string")))
                .otherwise(F.concat(F.lit("user_"), u.cast("string"))))
    source_ip = (F.when(u % 17 == 0, F.lit("N/A"))
                 .when(err & (e % 5 == 0), F.concat(F.lit("192.168."), (u % 2).cast("string"), F.lit("."),
                                                    (e % 20).cast("string")))
                 .otherwise(F.concat(F.lit("10.0."), (u % 4).cast("string"), F.lit("."),
                                     (u % 200).cast("string"))))
    process_name = (F.when(t != "click", F.lit("N/A"))
                    .when(e % 11 == 0, F.lit("C:/Tools/Mimikatz.exe"))
                    .when(e % 7 == 0, F.lit("C:/Windows/PowerShell.exe"))
                    .otherwise(F.lit("C:/Apps/app.exe")))
    command_line = (F.when(t != "click", F.lit(""))
                    .when(e % 13 == 0, F.lit("reg save hklm/SAM out"))
                    .otherwise(F.lit("app --run")))
    source_machine = (F.when((u % 5 == 0) & (e % 4 == 0), F.lit("CLIENT_MACHINE"))
                      .otherwise(F.lit("DOMAIN_CONTROLLER")))
    return events.select(
        e.alias("log_id"), ts.alias("timestamp"), event_id.cast("int").alias("event_id"),
        username.alias("username"), source_ip.alias("source_ip"), process_name.alias("process_name"),
        command_line.alias("command_line"), source_machine.alias("source_machine"), *keep)


def raw_logs(spark: SparkSession, base: str) -> DataFrame:
    return raw_logs_from_events(read_table(spark, base, "events"))


def raw_logs_with_value(spark: SparkSession, base: str) -> DataFrame:
    """``raw_logs`` plus the events' ``value``, used where a precomputed
    anomaly score stands in for the model (oracle-checkable runs)."""
    return raw_logs_from_events(read_table(spark, base, "events"), keep=("value",))


def reports_from_documents(documents: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    prefix = F.when(d % 4 == 0, F.lit(REPORT_PREFIXES[0])).when(d % 4 == 1, F.lit(REPORT_PREFIXES[1])) \
        .when(d % 4 == 2, F.lit(REPORT_PREFIXES[2])).otherwise(F.lit(REPORT_PREFIXES[3]))
    # Whole document texts (FIXTURES.md §4 cut them to 60–300 characters; every
    # text job here runs on complete texts).
    text = F.concat(prefix, F.lit(" "), F.coalesce(F.col("text"), F.lit("")))
    allowed = F.when(d % 2 == 0, F.array(*[F.lit(x) for x in ALLOWED_EVEN])) \
        .otherwise(F.array(*[F.lit(x) for x in ALLOWED_ODD]))
    return documents.select(d.alias("id"), text.alias("text"), allowed.alias("allowed"))


def reports(spark: SparkSession, base: str) -> DataFrame:
    # Whole-text regex work dominates: spread an under-split scan over all cores.
    return reports_from_documents(read_table(spark, base, "documents", balance=True))


# Fixed values of the sectioned-report fixture (list lines with technique ids).
SECTION_BODIES = (
    "- T1059 - Command: seen\n- T1110 - Brute Force: seen\nplain line T1059",
    "1) T1558.003 kerberoast\n* note T1021\n  - T1110.003 spray",
    "none listed",
)
PRIORITY_LINE = "1. Reset the affected accounts."


def sectioned_reports_from_documents(documents: DataFrame) -> DataFrame:
    """Report texts with headings and list lines, built from ``documents``."""
    d = F.col("doc_id")
    body = F.when(d % 3 == 0, F.lit(SECTION_BODIES[0])).when(d % 3 == 1, F.lit(SECTION_BODIES[1])) \
        .otherwise(F.lit(SECTION_BODIES[2]))
    tail = F.when(d % 2 == 0, F.lit("\n### PRIORITY RESPONSE ACTIONS\n" + PRIORITY_LINE)).otherwise(F.lit(""))
    text = F.concat(F.lit("### EXECUTIVE THREAT SUMMARY\n"), F.coalesce(F.col("text"), F.lit("")),
                    F.lit("\n\n### MITRE ATT&CK OBSERVATIONS\n"), body, tail)
    allowed = F.when(d % 2 == 0, F.array(*[F.lit(x) for x in ALLOWED_EVEN])) \
        .otherwise(F.array(*[F.lit(x) for x in ALLOWED_ODD]))
    return documents.select(d.alias("id"), text.alias("text"), allowed.alias("allowed"))
