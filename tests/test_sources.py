"""Event-record projection (S1–S4, P1–P9), uploads (S3) and sinks."""

import datetime as dt
import os

from pyspark.sql import functions as F

from seclake.sources import sinks, upload, winevents


def rec(spark, rows):
    return spark.createDataFrame(rows, winevents.WIN_EVENT_SCHEMA)


def inserts(n, **at):
    arr = ["-"] * n
    for i, v in at.items():
        arr[int(i[1:])] = v
    return arr


def test_dc_projection(spark):
    rows = [
        (1, 4625 + 65536, "Mon Jan 15 08:00:00 2024", inserts(20, s5="alice", s8="3", s18="::ffff:10.0.0.5"), "dc1", "dc"),
        (2, 4624, "2024-01-15 08:00:01", inserts(20, s5="bob", s8="2", s18="10.0.0.9"), "dc1", "dc"),
        (3, 4624, "2024-01-15 08:00:02", inserts(8, s5="carl"), "dc1", "dc"),  # P9: logon type missing
        (4, 4769, "2024-01-15 08:00:03", inserts(12, s0="svc", s9="bad", s10="192.168.1.7"), "dc1", "dc"),
        (5, 4688, "2024-01-15 08:00:04", inserts(9, s1="dan", s5="C:/x/cmd.exe", s8="cmd /c whoami"), "dc1", "dc"),
        (6, 4634, "2024-01-15 08:00:05", [], "dc1", "dc"),  # not a target id
    ]
    out = {r.record_number: r for r in winevents.to_raw_logs(rec(spark, rows)).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert (out[1].event_id, out[1].username, out[1].source_ip) == (4625, "alice", "10.0.0.5")
    assert out[1].timestamp == dt.datetime(2024, 1, 15, 8, 0, 0)
    assert out[2].source_ip == "127.0.0.1" and out[3].source_ip == "127.0.0.1"
    assert (out[4].username, out[4].source_ip) == ("svc", "192.168.1.7")
    assert (out[5].process_name, out[5].command_line, out[5].source_ip) == ("C:/x/cmd.exe", "cmd /c whoami",
                                                                            "127.0.0.1")
    assert out[5].source_machine == "DOMAIN_CONTROLLER"


def test_p4_safe_get_defaults(spark):
    df = spark.createDataFrame([([" - "],), ([""],), (["x"],)], "a array<string>")
    got = [r[0] for r in df.select(winevents.safe_get(F.col("a"), 0, "D")).collect()]
    assert got == ["D", "D", "x"]
    past = df.select(winevents.safe_get(F.col("a"), 5, "D")).first()[0]
    assert past == "D"


def test_client_projection(spark):
    rows = [(1, 4625, "2024-01-15 08:00:00", inserts(19, s5="-", s18="fe80::1"), "ws1", "client"),
            (2, 4688, "2024-01-15 08:00:01", inserts(9, s1="eve", s5="p.exe", s8="p --x"), "ws1", "client"),
            (3, 4672, "2024-01-15 08:00:02", inserts(3), "ws1", "client")]
    df = rec(spark, rows).withColumn("host_ip", F.lit("10.1.1.1"))
    out = {r.record_number: r for r in winevents.to_raw_logs(df, host_ip_col="host_ip").collect()}
    assert set(out) == {1, 2}
    assert (out[1].username, out[1].source_ip) == ("-", "127.0.0.1")
    assert (out[2].source_ip, out[2].source_machine) == ("10.1.1.1", "CLIENT_MACHINE")


def test_s4_high_water(spark):
    df = rec(spark, [(n, 4624, "2024-01-15 08:00:00", [], "h", "dc") for n in (9, 10, 11)])
    hw = spark.createDataFrame([("h", 10)], "host string, mark long")
    assert [r.record_number for r in winevents.incremental(df, hw).collect()] == [11]
    assert winevents.new_high_water(df, hw).first().mark == 11


def test_s3_uploads(spark):
    bodies = spark.createDataFrame([("[]",), ("{}",), ('[{"event_id": 4625, "source_ip": "1.2.3.4"}]',)],
                                   "body string")
    rows, rejected = upload.parse_uploads(bodies)
    assert rejected.count() == 2
    r = rows.first()
    assert (r.event_id, r.source_ip, r.username) == (4625, "1.2.3.4", None)


def test_sinks_roundtrip(spark, scratch):
    path = os.path.join(scratch, "raw")
    sinks.create_raw_table(spark, path)
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3), 4624, "u", "1.1.1.1", "N/A", "", "DOMAIN_CONTROLLER")],
                               sinks.RAW_LOGS_SCHEMA)
    sinks.append_raw_logs(df, path)
    sinks.append_raw_logs(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and "event_date" in back.columns
    plan = back.where("event_date = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    an = os.path.join(scratch, "analyzed")
    sinks.replace_analyzed(df.withColumn("total_threat_score", F.lit(3)), an)
    assert sinks.read_analyzed(spark, an).count() == 1
    two = df.unionAll(df).withColumn("total_threat_score", F.lit(3))
    sinks.replace_analyzed(two, an)
    assert sinks.read_analyzed(spark, an).count() == 2
    by_batch = os.path.join(scratch, "by-batch")
    for batch, rows in ((0, df), (1, df.unionAll(df)), (1, df)):  # batch 1 is replayed
        sinks.replace_analyzed(rows.withColumn("total_threat_score", F.lit(3)), by_batch, batch)
    assert sinks.read_analyzed(spark, by_batch).count() == 1


def test_cutoff_set_clear_status(spark, scratch):
    from seclake.sources import cutoff
    path = os.path.join(scratch, "cutoff")
    assert cutoff.status(spark, path).first() == (False, None)
    cutoff.set_cutoff(spark, path, dt.datetime(2024, 1, 2))
    cutoff.set_cutoff(spark, path, dt.datetime(2024, 1, 3, 4, 5, 6))
    assert cutoff.status(spark, path).first() == (True, dt.datetime(2024, 1, 3, 4, 5, 6))
    cutoff.clear_cutoff(spark, path)
    assert cutoff.status(spark, path).first() == (False, None) and cutoff.current(spark, path).count() == 0
    cutoff.set_cutoff(spark, path)
    assert abs((cutoff.status(spark, path).first()[1] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 60


def test_csv_export_quotes_everything(spark, scratch):
    df = spark.createDataFrame([("a,b", "1.1.1.1", "HIGH", 7, 'x "y"')],
                               "username string, source_ip string, final_risk_level string, "
                               "total_threat_score int, mitre_techniques string")
    out = os.path.join(scratch, "csv")
    sinks.export_incidents_csv(df, out, single_file=True)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert text.splitlines()[0] == '"username","source_ip","risk_level","threat_score","mitre_techniques"'
    assert text.splitlines()[1] == '"a,b","1.1.1.1","HIGH","7","x ""y"""'


def test_runbooks_and_chunks(spark, scratch):
    from seclake.operators import retrieval
    os.makedirs(os.path.join(scratch, "rb", "sub"))
    body = "# Heading\n\n" + ("Lock the account and reset the password. " * 30)
    for name in ("a.md", "sub/b.md"):
        with open(os.path.join(scratch, "rb", name), "w") as f:
            f.write(body)
    with open(os.path.join(scratch, "rb", "skip.txt"), "w") as f:
        f.write("not markdown")
    docs = sinks.load_runbooks(spark, os.path.join(scratch, "rb"))
    assert docs.count() == 2
    chunks = retrieval.chunk_documents(docs)
    assert chunks.agg(F.max(F.length("text"))).first()[0] <= retrieval.CHUNK_SIZE
    first = sinks.save_chunks(chunks, os.path.join(scratch, "vec"))
    again = sinks.save_chunks(chunks, os.path.join(scratch, "vec"), spark.read.parquet(first))
    assert spark.read.parquet(again).count() == chunks.count()


def test_cutoff_reaches_the_scan_and_prunes_dates(spark, scratch):
    from seclake.operators import reports
    path = os.path.join(scratch, "raw2")
    rows = [(i, dt.datetime(2024, 1, 1 + i % 5, 12), 4624, "u", "1.1.1.1", "N/A", "", "DOMAIN_CONTROLLER")
            for i in range(50)]
    sinks.append_raw_logs(spark.createDataFrame(rows, sinks.RAW_LOGS_SCHEMA), path)
    cutoff = spark.createDataFrame([(dt.datetime(2024, 1, 3, 0),)], "watermark_ts timestamp_ntz")
    out = reports.after_cutoff(spark.read.parquet(path), cutoff, date_col="event_date").select("log_id", "timestamp")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThan(timestamp" in plan
    assert "PartitionFilters: [isnotnull(event_date" in plan and "ReadSchema: struct<log_id:bigint,timestamp" in plan
    assert out.count() == sum(1 for r in rows if r[1] > dt.datetime(2024, 1, 3))


def test_ingest_to_detection_end_to_end(spark):
    """Event records and JSON uploads both feed the full detection run."""
    from seclake.plans import detection
    from seclake.sources import fixtures, records
    from conftest import SF_SMALL
    raw = winevents.to_raw_logs(records.records_from_raw(fixtures.raw_logs(spark, SF_SMALL)), "host_ip")
    assert raw.select("log_id").distinct().count() == raw.count()
    an = detection.analyze(raw.drop("host", "record_number"), model="forest")
    assert an.count() == raw.count() and an.agg(F.sum("is_anomaly")).first()[0] > 0
    bodies = spark.createDataFrame([(1, '[{"timestamp": "Mon Jan 15 08:00:00 2024", "event_id": 4625, '
                                        '"username": "a", "source_ip": "1.2.3.4"}, {"event_id": "4624"}]')],
                                   "payload_id long, body string")
    rows, _ = upload.parse_uploads(bodies)
    out = detection.analyze(rows.drop("payload_id"), model="none").orderBy("event_id").collect()
    assert [r.event_id for r in out] == [4624, 4625] and out[1].timestamp is not None
    assert len({r.log_id for r in out}) == 2


def test_upload_tells_strings_from_objects(spark):
    """A string that spells an object out is a string."""
    from seclake.sources import upload
    body = '["{\\"username\\":\\"a\\"}", {"username":"b","event_id":4625}, {}, "x", null, 3, [{}]]'
    rows, rejected = upload.parse_uploads(spark.createDataFrame([(1, body), (2, '[{"username":"c"'), (3, None)], "pid int, body string"))
    assert [(r.pid, r.username, r.event_id) for r in rows.orderBy("event_id").collect()] == [(1, None, None), (1, "b", 4625)]
    assert sorted((r.pid, -1 if r.pos is None else r.pos) for r in rejected.collect()) == [(1, 0), (1, 3), (1, 4), (1, 5), (1, 6), (2, -1), (3, -1)]
