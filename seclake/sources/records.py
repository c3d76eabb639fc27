"""Windows event records derived from ``raw_logs`` (inverse of S1/S2).

Used to exercise the collector projection on realistic volumes: each
``raw_logs`` row becomes the record a collector would have read, with
varied logon types, address spellings and both time formats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = {"logon": 20, "priv": 3, "kerberos": 13, "process": 9}


def _arr(width: int, at: dict) -> Column:
    return F.array(*[at.get(i, F.lit("-")) for i in range(width)])


def records_from_raw(raw: DataFrame) -> DataFrame:
    lid, ev, ip = F.col("log_id"), F.col("event_id"), F.col("source_ip")
    user = F.coalesce(F.col("username"), F.lit("-"))
    logon_type = (F.when(lid % 4 == 0, F.lit("2")).when(lid % 4 == 1, F.lit("3"))
                  .when(lid % 4 == 2, F.lit("10")).otherwise(F.lit("-")))
    ip18 = (F.when(lid % 5 == 0, F.concat(F.lit("::ffff:"), ip)).when(lid % 5 == 1, F.concat(F.lit(" "), ip))
            .when(lid % 5 == 2, F.lit("-")).otherwise(ip))
    ip9 = F.when(lid % 3 == 0, ip).when(lid % 3 == 1, F.lit("x")).otherwise(F.lit("-"))
    inserts = (F.when(ev.isin(4624, 4625), _arr(WIDTH["logon"], {5: user, 8: logon_type, 18: ip18}))
               .when(ev == 4672, _arr(WIDTH["priv"], {1: user}))
               .when(ev.isin(4768, 4769), _arr(WIDTH["kerberos"], {0: user, 9: ip9, 12: ip}))
               .otherwise(_arr(WIDTH["process"], {1: user, 5: F.col("process_name"), 8: F.col("command_line")})))
    time_text = F.when(lid % 2 == 0, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")) \
        .otherwise(F.date_format("timestamp", "EEE MMM dd HH:mm:ss yyyy"))
    profile = F.when(F.col("source_machine") == "DOMAIN_CONTROLLER", F.lit("dc")).otherwise(F.lit("client"))
    return raw.select(
        lid.alias("record_number"), (ev + 65536 * (lid % 3)).cast("long").alias("event_id_raw"),
        time_text.alias("time_generated"), inserts.alias("string_inserts"),
        F.concat(F.lit("h"), (lid % 4).cast("string")).alias("host"), profile.alias("profile"),
        F.concat(F.lit("10.9.9."), (lid % 7).cast("string")).alias("host_ip"))
