"""Streaming (K1–K8): file stream with availableNow, compared with batch."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake.operators import features, normalize
from seclake.sources import fixtures
from seclake.streaming import ingest, stateful, windows


def write_records(spark, folder, parts=4):
    """Event records derived from the driver's events table, split into files."""
    raw = fixtures.raw_logs(spark, SF_SMALL).where(F.col("source_machine") == "DOMAIN_CONTROLLER")
    rows = raw.orderBy("timestamp", "log_id").collect()
    os.makedirs(folder, exist_ok=True)
    size = -(-len(rows) // parts)
    for p in range(parts):
        # Collectors export in time order: each file is a contiguous time span.
        with open(os.path.join(folder, f"part-{p}.json"), "w") as f:
            for r in rows[p * size:(p + 1) * size]:
                ins = ["-"] * 20
                if r.event_id in (4624, 4625):
                    ins[5], ins[8], ins[18] = r.username or "-", "3", r.source_ip
                elif r.event_id == 4688:
                    ins[1], ins[5], ins[8] = r.username or "-", r.process_name, r.command_line or "-"
                else:
                    ins[0] = ins[1] = r.username or "-"
                    ins[9] = r.source_ip
                f.write(json.dumps({"record_number": r.log_id, "event_id_raw": r.event_id,
                                    "time_generated": r.timestamp.strftime("%Y-%m-%d %H:%M:%S.%f"),
                                    "string_inserts": ins, "host": "dc1", "profile": "dc"}) + "\n")
    return rows


def test_stream_ingest_matches_batch_and_dedups(spark, scratch):
    src = os.path.join(scratch, "in")
    rows = write_records(spark, src)
    out, ck = os.path.join(scratch, "raw"), os.path.join(scratch, "ck")
    q = ingest.start_raw_sink(ingest.to_raw_stream(ingest.read_event_stream(spark, src, max_files=1)), out, ck)
    q.awaitTermination(300)
    first = spark.read.parquet(out)
    assert first.count() == len(rows)
    # K3: a replayed file inside the watermark adds nothing.
    with open(os.path.join(src, "part-3.json")) as f, open(os.path.join(src, "replay.json"), "w") as g:
        g.write(f.read())
    q = ingest.start_raw_sink(ingest.to_raw_stream(ingest.read_event_stream(spark, src)), out, ck)
    q.awaitTermination(300)
    assert spark.read.parquet(out).select("record_number").distinct().count() == len(rows)


def test_stateful_failure_window_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    write_records(spark, src)
    stream = ingest.to_raw_stream(ingest.read_event_stream(spark, src, max_files=1))
    flagged = stream.withColumn("log_id", F.col("record_number")).withColumn(
        "is_failed_login", (F.col("event_id") == 4625).cast("int"))
    counts = stateful.failed_window_stream(flagged)
    q = (counts.writeStream.format("memory").queryName("k5_out").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck5")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.log_id: r.failed_last_10min for r in spark.sql("SELECT * FROM k5_out").collect()}
    raw = batch_rows(spark)
    batch = features.with_failed_window(normalize.with_flags(normalize.normalize(raw)))
    expect = {r.log_id: r.failed_last_10min for r in batch.collect()}
    assert got == final(expect, raw)


def test_windowed_stream_aggregates(spark, scratch):
    src = os.path.join(scratch, "in")
    write_records(spark, src)
    stream = ingest.to_raw_stream(ingest.read_event_stream(spark, src))
    for name, df in (("k6_out", windows.hourly_timeline(stream)), ("k5a_out", windows.failure_bursts(stream)),
                     ("k8_out", windows.spray_candidates(stream, threshold=1))):
        q = (df.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", os.path.join(scratch, "ck-" + name)).trigger(availableNow=True).start())
        q.awaitTermination(300)
    assert spark.sql("SELECT sum(count) FROM k6_out").first()[0] > 0
    raw = batch_rows(spark)
    mark = raw.agg(F.date_trunc("second", F.max("timestamp")).cast("timestamp_ntz").alias("m")).first()["m"]
    closed = (raw.where(F.col("event_id") == 4625)
              .where(F.date_trunc("hour", "timestamp").cast("timestamp_ntz") + F.expr("interval 70 minute") <= F.lit(mark))
              .select(F.date_trunc("hour", "timestamp").alias("hour")).distinct().count())
    assert spark.sql("SELECT count(DISTINCT w) FROM k8_out").first()[0] == closed > 0


def test_detection_loop_on_stream(spark, scratch):
    from seclake.sources import sinks
    from seclake.streaming import detect
    src = os.path.join(scratch, "in")
    write_records(spark, src)
    raw_path, ck = os.path.join(scratch, "raw"), os.path.join(scratch, "ck")
    q = ingest.start_raw_sink(ingest.to_raw_stream(ingest.read_event_stream(spark, src)), raw_path, ck)
    q.awaitTermination(300)
    stream = ingest.to_raw_stream(ingest.read_event_stream(spark, src))
    an_base = os.path.join(scratch, "analyzed")
    q = detect.start_detection(stream.drop("event_time"), raw_path, an_base, os.path.join(scratch, "ck4"),
                               lookback_hours=24 * 40, model="none")
    q.awaitTermination(300)
    analyzed = sinks.read_analyzed(spark, an_base)
    assert analyzed.count() == spark.read.parquet(raw_path).count()
    assert "final_risk_level" in analyzed.columns


def final(counts: dict, raw) -> dict:
    """Those of the batch counts whose row the final watermark (in milliseconds) has passed."""
    import datetime as dt
    times = {r.log_id: r.timestamp for r in raw.collect()}
    mark = max(times.values()) - dt.timedelta(minutes=10)
    mark = mark.replace(microsecond=mark.microsecond // 1000 * 1000)
    return {k: v for k, v in counts.items() if times[k] <= mark}


def batch_rows(spark):
    """What the written records hold; the projection names missing users N/A."""
    raw = fixtures.raw_logs(spark, SF_SMALL).where(F.col("source_machine") == "DOMAIN_CONTROLLER")
    return raw.withColumn("username", F.coalesce("username", F.lit("N/A")))


def test_stateful_exact_with_out_of_order_files(spark, scratch):
    """File B holds rows older than file A's newest (within the delay):
    every emitted count must still equal the batch window."""
    import datetime as dt
    src = os.path.join(scratch, "ooo")
    write_records(spark, src, parts=1)
    recs = [json.loads(l) for l in open(os.path.join(src, "part-0.json"))]
    os.remove(os.path.join(src, "part-0.json"))

    def t(r):
        return dt.datetime.fromisoformat(r["time_generated"])
    times = sorted(t(r) for r in recs)
    overlap = dt.timedelta(minutes=4)
    # the densest stretch: most rows within one overlap (folded failures)
    best = max(range(len(times)), key=lambda i: sum(1 for x in times[i:i + 40] if x - times[i] < overlap))
    mid = times[best]
    in_a = [r for r in recs if t(r) < mid or (t(r) < mid + overlap and r["record_number"] % 2 == 0)]
    in_b = [r for r in recs if r not in in_a]
    assert any(t(r) < max(t(x) for x in in_a) for r in in_b)
    for name, part in (("a.json", in_a), ("b.json", in_b)):
        with open(os.path.join(src, name), "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in part))
        os.utime(os.path.join(src, name), (1_700_000_000 + len(name) + (0 if name == "a.json" else 10),) * 2)
    stream = ingest.to_raw_stream(ingest.read_event_stream(spark, src, max_files=1))
    flagged = stream.withColumn("log_id", F.col("record_number")).withColumn(
        "is_failed_login", (F.col("event_id") == 4625).cast("int"))
    q = (stateful.failed_window_stream(flagged).writeStream.format("memory").queryName("k5_ooo")
         .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck-ooo"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.log_id: r.failed_last_10min for r in spark.sql("SELECT * FROM k5_ooo").collect()}
    raw = batch_rows(spark)
    batch = features.with_failed_window(normalize.with_flags(normalize.normalize(raw)))
    expect = {r.log_id: r.failed_last_10min for r in batch.collect()}
    assert got == final(expect, raw)


def test_failure_window_calls_once_for_many_users(spark, scratch):
    """K5: the number of groups goes with parts and time, not with users; users of one part don't count for each other."""
    src = os.path.join(scratch, "many")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for k in range(300):  # every user fails twice, eleven minutes apart, and once more in between for every third
            for at, wanted in ((0, True), (5, k % 3 == 0), (11, True), (60, k == 0)):
                if wanted:
                    ins = ["-"] * 20
                    ins[5], ins[8], ins[18] = f"user{k}", "3", "10.0.0.1"
                    f.write(json.dumps({"record_number": 100 * k + at, "event_id_raw": 4625, "time_generated": f"2024-01-01 {at // 60:02d}:{at % 60:02d}:00", "string_inserts": ins, "host": "dc1", "profile": "dc"}) + "\n")
    stream = ingest.to_raw_stream(ingest.read_event_stream(spark, src))
    flagged = stream.withColumn("log_id", F.col("record_number")).withColumn("is_failed_login", (F.col("event_id") == 4625).cast("int"))
    q = (stateful.failed_window_stream(flagged).writeStream.format("memory").queryName("k5_many").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck-many")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.log_id: r.failed_last_10min for r in spark.sql("SELECT * FROM k5_many").collect()}
    want = {100 * k: 1 for k in range(300)} | {100 * k + 5: 2 for k in range(0, 300, 3)} | {100 * k + 11: 2 if k % 3 == 0 else 1 for k in range(300)}
    assert got == want
    groups = max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators if op.operatorName == "applyInPandasWithState")
    assert groups <= 4 * stateful.PARTS  # the three windows there are, and the one that the last is copied into
