"""Registered queries of the writers, the streams and the parts around them.

Each writes data that Spark derives from the given tables into a new folder in the
checkpoint folder, reads it back, and is compared with SQL over the tables.
"""

from __future__ import annotations

import os
import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import ntz_lit, parse_mixed_timestamp
from ..operators import features, forest, guardrails, normalize, reports, retrieval
from ..operators import anomaly
from ..session import checkpoint_dir, list_path, materialize
from ..sources import cutoff, fixtures, marks, records, sinks, snapshots, upload, winevents
from . import catalog
from . import oracle as O
from .catalog import CUTOFF, _analyzed, _raw, _records_sql, _projection_sql, register

RAW_COLS = "log_id, timestamp, event_id, username, source_ip, process_name, command_line, source_machine"


def folder(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- W1 in a burst, fields, times

BURST_US = 3_600_000_000


@register("failed_window_burst", O.chain("raw_logs") + f""",
folded AS (SELECT log_id, event_id, epoch_us(timestamp) % {BURST_US} AS us FROM raw_logs)
SELECT log_id, CAST(sum(CASE WHEN event_id = 4625 THEN 1 ELSE 0 END)
  OVER (ORDER BY us RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS failed_last_10min FROM folded""")
def q_failed_window_burst(spark, base):
    """W1 with all rows in one hour of one user."""
    from ..functions.timecols import from_micros, micros
    raw = _raw(spark, base).withColumns({"timestamp": from_micros(micros("timestamp") % BURST_US), "username": F.lit("user")})
    return features.with_failed_window(normalize.with_flags(normalize.normalize(raw))).select("log_id", "failed_last_10min")


@register("field_scrub", O.chain() + f"""
SELECT log_id, {O.scrub_sql('username')} AS username, {O.scrub_sql('source_ip')} AS source_ip,
 {O.scrub_sql('concat(mitre_techniques, command_line, mitre_techniques, process_name)')} AS detail FROM analyzed""")
def q_field_scrub(spark, base):
    """G1 on prompt fields, with the field limit."""
    detail = F.concat("mitre_techniques", "command_line", "mitre_techniques", "process_name")
    return _analyzed(spark, base).select("log_id", *[guardrails.scrub(c).alias(c) for c in ("username", "source_ip")], guardrails.scrub(detail).alias("detail"))


#: By form: a text with the time in it, as Spark formats it, and what the parser has to make of it.
TIME_FORMS = (
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "date_trunc('second', timestamp)"), ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "date_trunc('millisecond', timestamp)"),
    ("yyyy-MM-dd'T'HH:mm:ss'+02:00'", "date_trunc('second', timestamp) - INTERVAL 120 MINUTE"), ("yyyy-MM-dd HH:mm:ss.SSSSSS", "timestamp"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS'7'", "timestamp"), ("yyyy-MM-dd HH:mm:ss.SSSSSS'789'", "timestamp"), ("yyyy-MM-dd HH:mm", "date_trunc('minute', timestamp)"),
    ("MM/dd/yyyy HH:mm:ss", "date_trunc('second', timestamp)"), ("yyyy/MM/dd HH:mm:ss", "date_trunc('second', timestamp)"), ("  yyyy-MM-dd ", "date_trunc('day', timestamp)"),
    ("EEE MMM dd HH:mm:ss yyyy", "date_trunc('second', timestamp)"), ("yyyy-MM-dd'T'HH:mm:ss'-0530'", "date_trunc('second', timestamp) + INTERVAL 330 MINUTE"),
    ("'garbage' yyyy", "NULL"), ("yyyy-'13'-dd HH:mm:ss", "NULL"), ("''", "NULL"), ("HH:mm:ss", "NULL"))


@register("timestamp_parse", O.chain("raw_logs") + f"""
SELECT log_id, CAST(log_id % {len(TIME_FORMS)} AS INTEGER) AS form, CAST(CASE log_id % {len(TIME_FORMS)} """
          + " ".join(f"WHEN {k} THEN {sql}" for k, (_, sql) in enumerate(TIME_FORMS)) + """ END AS TIMESTAMP) AS parsed FROM raw_logs""")
def q_timestamp_parse(spark, base):
    """P12 over the forms that times come in."""
    form = F.pmod("log_id", F.lit(len(TIME_FORMS))).cast("int")
    text = F.lit(None).cast("string")
    for k, (pattern, _) in enumerate(TIME_FORMS):
        text = F.when(form == k, F.date_format("timestamp", pattern)).otherwise(text)
    return _raw(spark, base).select("log_id", form.alias("form"), parse_mixed_timestamp(text).alias("parsed"))


# ---------------------------------------------------------------- sources and sinks

@register("incremental_records", O.chain("raw_logs") + "," + _records_sql() + f""",
marks AS (SELECT host, max(record_number) AS mark FROM recs WHERE record_number % 3 = 0 AND host <> 'h1' GROUP BY host),
fresh AS (SELECT r.host, record_number FROM recs r LEFT JOIN marks m ON r.host = m.host WHERE mark IS NULL OR record_number > mark - 100),
after AS (SELECT host, max(record_number) AS mark FROM recs GROUP BY host)
SELECT f.host, count(*) AS new_records, min(record_number) AS first_record, max(mark) AS next_mark
FROM fresh f JOIN after a ON f.host = a.host GROUP BY f.host""")
def q_incremental_records(spark, base):
    """Records beyond each host's mark (one host has none yet), and the next marks."""
    recs = records.records_from_raw(_raw(spark, base))
    before = winevents.new_high_water(recs.where("record_number % 3 = 0 and host <> 'h1'")).withColumn("mark", F.col("mark") - 100)
    after = winevents.new_high_water(recs, before)
    return (winevents.incremental(recs, before).groupBy("host").agg(F.count("*").alias("new_records"), F.min("record_number").alias("first_record"))
            .join(after, "host").withColumnRenamed("mark", "next_mark"))


@register("incremental_commit", O.chain("raw_logs") + "," + _records_sql() + ", projected AS (" + _projection_sql() + """),
m AS (SELECT host, max(record_number) AS mark FROM recs GROUP BY host)
SELECT p.host, count(*) AS n_rows, count(DISTINCT record_number) AS n_records, max(mark) AS mark, 2 AS last_batch FROM projected p JOIN m ON p.host = m.host GROUP BY p.host""")
def q_incremental_commit(spark, base):
    """A run that breaks off between rows and commit, one that takes its place, and one that finds nothing new."""
    collector = marks.Collector(spark, folder(spark, "collector"))
    recs = materialize(records.records_from_raw(_raw(spark, base)), "records")
    most = recs.agg(F.max("record_number")).first()[0] or 0
    collector.collect(recs.where(F.col("record_number") <= most // 3))
    collector.append(recs.where(F.col("record_number") <= 2 * (most // 3)), 1, collector.marks())  # and no commit
    collector.collect(recs)
    last = collector.collect(recs)
    counts = collector.rows().groupBy("host").agg(F.count("*").alias("n_rows"), F.countDistinct("record_number").alias("n_records"))
    return counts.join(collector.marks(), "host").withColumn("last_batch", F.lit(last))


@register("raw_table", O.chain("raw_logs") + f"""
SELECT {RAW_COLS}, CAST(timestamp AS DATE) AS event_date FROM raw_logs WHERE CAST(timestamp AS DATE) >= DATE '{CUTOFF[:10]}'""")
def q_raw_table(spark, base):
    """An empty table, two appends, and a read that prunes dates."""
    path = folder(spark, "raw-table")
    sinks.create_raw_table(spark, path)
    raw = _raw(spark, base)
    for odd in (0, 1):
        sinks.append_raw_logs(raw.where(F.pmod("log_id", F.lit(2)) == odd), path)
    return spark.read.parquet(path).where(F.col("event_date") >= ntz_lit(CUTOFF).cast("date")).select(*RAW_COLS.split(", "), "event_date")


@register("analyzed_replace", O.chain() + """
SELECT log_id, total_threat_score, final_risk_level FROM analyzed""")
def q_analyzed_replace(spark, base):
    """The table is replaced, and a replayed batch replaces itself; the newest version holds."""
    path = folder(spark, "analyzed")
    cols = _analyzed(spark, base).select("log_id", "total_threat_score", "final_risk_level")
    saved = materialize(cols, "analyzed-once")
    sinks.replace_analyzed(saved.where("log_id % 2 = 0"), path, 7)
    for rows in (saved.where("log_id % 3 = 0"), saved):
        sinks.replace_analyzed(rows, path, 8)
    return sinks.read_analyzed(spark, path)


@register("snapshot_retention", O.chain("raw_logs") + """
SELECT step, CASE WHEN step = 'pinned' THEN count(*) FILTER (WHERE log_id % 4 = 0) ELSE count(*) END AS n_rows, CASE step WHEN 'pinned' THEN '0' WHEN 'newest' THEN '0,3' ELSE '3' END AS versions
FROM raw_logs, (VALUES ('pinned'), ('newest'), ('released')) s(step) GROUP BY step""")
def q_snapshot_retention(spark, base):
    """A pinned version outlives three replacements and a clean-up, and goes once it is released."""
    store = snapshots.Snapshots(spark, folder(spark, "snapshots"))
    raw = _raw(spark, base).select("log_id")
    out = []

    def note(step, rows):
        names = ",".join(str(int(n[2:])) for n in list_path(spark, store.path) if n.startswith("v-"))
        out.append(materialize(rows.agg(F.count("*").alias("n_rows")).select(F.lit(step).alias("step"), "n_rows", F.lit("0" if step == "pinned" else names).alias("versions")), "step"))
    store.publish(raw.where("log_id % 4 = 0"))
    held = store.read(store.pin("report"))
    for part in (raw.where("log_id % 4 = 1"), raw.where("log_id % 2 = 0"), raw):
        store.publish(part)
    store.clean()
    note("pinned", held)
    note("newest", store.read())
    store.release("report")
    store.clean()
    note("released", store.read())
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("incidents_csv", O.chain() + """
SELECT coalesce(username, '') AS username, coalesce(source_ip, '') AS source_ip, final_risk_level AS risk_level,
 CAST(total_threat_score AS VARCHAR) AS threat_score, mitre_techniques FROM analyzed""")
def q_incidents_csv(spark, base):
    """Export and read back."""
    path = folder(spark, "incidents")
    sinks.export_incidents_csv(_analyzed(spark, base), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


@register("chunk_store", """
SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents""")
def q_chunk_store(spark, base):
    """A half, then everything; chunks that are there already aren't added again."""
    path = folder(spark, "chunk-store")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    chunks = docs.select("doc_id", F.col("doc_id").cast("string").alias("doc_path"), F.lit(0).alias("chunk_idx"), F.coalesce("text", F.lit("")).alias("text"))
    sinks.save_chunks(chunks.where("doc_id % 2 = 0"), path)
    sinks.save_chunks(chunks, path, spark.read.parquet(path))
    sinks.save_chunks(chunks, path, spark.read.parquet(path))
    return spark.read.parquet(path).select("doc_id", F.md5("text").alias("text_md5"))


@register("chunk_store_bucketed", """
SELECT doc_id, md5(coalesce(text, '')) AS text_md5, doc_id % 2 = 0 AS first_save FROM documents""")
def q_chunk_store_bucketed(spark, base):
    """S13 by buckets of the key: a half, then everything, then everything again; each save tells what it appended."""
    path = folder(spark, "chunk-buckets")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    chunks = docs.select("doc_id", F.col("doc_id").cast("string").alias("doc_path"), F.lit(0).alias("chunk_idx"), F.coalesce("text", F.lit("")).alias("text"))
    first = sinks.save_chunks_bucketed(chunks.where("doc_id % 2 = 0"), path, 64).select("chunk_key", F.lit(True).alias("first_save"))
    for _ in range(2):
        sinks.save_chunks_bucketed(chunks, path, 64)
    saved = spark.read.parquet(path).join(first, "chunk_key", "left")
    return saved.select("doc_id", F.md5("text").alias("text_md5"), F.coalesce("first_save", F.lit(False)).alias("first_save"))


@register("cutoff_status", O.chain("raw_logs") + """,
c AS (SELECT max(timestamp) - INTERVAL 5 DAY AS since FROM raw_logs)
SELECT step, step % 2 = 1 AS active, CASE WHEN step % 2 = 1 THEN since END AS watermark_ts,
 (SELECT count(*) FROM raw_logs WHERE step % 2 = 0 OR timestamp > since) AS visible_rows FROM c, (VALUES (0), (1), (2)) s(step)""")
def q_cutoff_status(spark, base):
    """Status and visible rows before a cutoff is set, with it, and after it is cleared."""
    path, raw = folder(spark, "cutoff"), _raw(spark, base)
    at = raw.agg(F.expr("max(timestamp) - interval 5 day")).first()[0]
    out = []
    for step in range(3):
        if step == 1:
            cutoff.set_cutoff(spark, path, at)
        elif step == 2:
            cutoff.clear_cutoff(spark, path)
        rows = reports.after_cutoff(raw, cutoff.current(spark, path)).agg(F.count("*").alias("visible_rows"))
        out.append(materialize(cutoff.status(spark, path).select(F.lit(step).alias("step"), "active", "watermark_ts").join(rows.select("visible_rows", F.lit(step).alias("step")), "step"), "status"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("upload_elements", O.chain("raw_logs") + """
SELECT log_id AS payload_id, CAST(CASE WHEN log_id % 6 = 5 THEN 0 ELSE 1 END AS BIGINT) AS accepted,
 CAST(CASE log_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 4 THEN 3 ELSE 2 END AS BIGINT) AS rejected FROM raw_logs""")
def q_upload_elements(spark, base):
    """S3: mixed arrays; every element is accepted or rejected."""
    user = F.to_json(F.struct("username", "event_id"))
    k = F.pmod("log_id", F.lit(6))
    body = (F.when(k == 0, F.concat(F.lit("[1, "), user, F.lit(', "a"]'))).when(k == 1, F.concat(F.lit("["), user, F.lit(", null]")))
            .when(k == 2, F.concat(F.lit("[[1, {}], "), user, F.lit("]"))).when(k == 3, F.concat(F.lit("["), user, F.lit("]")))
            .when(k == 4, F.concat(F.lit("[true, 2.5, "), user, F.lit(", []]"))).otherwise(F.lit('[1, "x"]')))
    payloads = _raw(spark, base).select(F.col("log_id").alias("payload_id"), body.alias("body"))
    rows, rejected = upload.parse_uploads(payloads)
    both = rows.select("payload_id", F.lit(1).alias("a"), F.lit(0).alias("r")).unionAll(rejected.select("payload_id", F.lit(0), F.lit(1)))
    return both.groupBy("payload_id").agg(F.sum("a").alias("accepted"), F.sum("r").alias("rejected"))


# ---------------------------------------------------------------- model and chunks, by what must hold of them

@register("forest_check", """
SELECT count(*) AS n_rows, CAST(ceil(count(*) * 0.03 - 0.5) AS BIGINT) - 1 <= CAST(count(*) * 0.04 AS BIGINT) AS share_right,
 true AS flag_is_sign, count(*) AS n_walked, 100 * count(*) AS n_leaves FROM events""")
def q_forest_check(spark, base):
    """M2–M5: about 3 % are flagged, the flag is the sign, and every row's score is the one that a walk of the saved node table, by joins, gives."""
    from . import detection
    feats = materialize(detection.features_of(_raw(spark, base)), "features")
    nodes, psi = forest.fit_nodes(feats)
    nodes = materialize(nodes, "nodes")
    scored = materialize(forest.score(feats, forest.Forest.from_nodes(nodes.toPandas(), psi), "s").select("log_id", "s"), "scores")
    flagged = anomaly.with_anomaly(scored, "s", anomaly.score_offset(scored, "s"))
    walked = forest.walk(feats, nodes, psi)
    both = flagged.join(walked, "log_id", "left")
    share = F.avg("is_anomaly")
    return both.agg(F.count("*").alias("n_rows"), ((share > 0) & (share <= 0.031)).alias("share_right"),
                    F.bool_and((F.col("anomaly_score_raw") < 0) == (F.col("is_anomaly") == 1)).alias("flag_is_sign"),
                    F.count(F.when(F.abs(F.col("s") - F.col("walked")) < 1e-9, 1)).alias("n_walked"), F.sum("leaves").cast("long").alias("n_leaves"))


@register("chunk_check", """
SELECT doc_id, true AS short_enough, true AS in_order, length(regexp_replace(coalesce(text, ''), '[\\t\\n\\f\\r ]', '', 'g')) AS covered FROM documents""")
def q_chunk_check(spark, base):
    """V1: chunks are short, stand in their document one behind the other, and hold all its characters but blanks: each is counted where a chunk first covers it."""
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", F.col("doc_id").cast("string").alias("doc_path"), F.coalesce("text", F.lit("")).alias("text"))
    split = retrieval.split_table()
    held = docs.lateralJoin(split(F.col("text").outer()), how="left").groupBy("doc_path").agg(
        F.sort_array(F.collect_list(F.struct("chunk_idx", "chunk"))).alias("chunks"))  # one document's chunks
    blank = re.compile(r"[\t\n\f\r ]")

    @F.pandas_udf("in_order boolean, covered long, longest int")
    def look(texts: pd.Series, chunks: pd.Series) -> pd.DataFrame:
        out = []
        for text, some in zip(texts, chunks):
            some = [] if some is None else [c["chunk"] for c in some]
            whole, ends = "".join(text.split()), {0}
            for c in some:  # each begins where the one before ends, or at most the overlap earlier; a text that repeats itself allows several places
                bare = "".join(c.split())
                ends = {e - o + len(bare) for e in ends for o in range(min(e, retrieval.CHUNK_OVERLAP) + 1) if whole.startswith(bare, e - o)}
            most = max(ends, default=0)
            out.append((bool(ends), len(blank.sub("", text)) if most == len(whole) else most, max(map(len, some), default=0)))
        return pd.DataFrame(out, columns=["in_order", "covered", "longest"])
    seen = docs.join(held, "doc_path", "left").select("doc_id", look("text", F.filter("chunks", lambda c: c["chunk"].isNotNull())).alias("l"))
    return seen.select("doc_id", (F.col("l.longest") <= retrieval.CHUNK_SIZE).alias("short_enough"), "l.in_order", "l.covered")


_PLACE = "CAST(CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % 256 AS INTEGER)"


@register("embed_texts", f"""
WITH w AS (SELECT doc_id AS id, unnest(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}_]+')) AS word FROM documents),
t AS (SELECT id, {_PLACE} AS pos, count(*) AS tf FROM w WHERE word <> '' GROUP BY 1, 2),
d AS (SELECT pos, ln((SELECT count(DISTINCT doc_id) FROM documents) + 1) - ln(count(*) + 1) AS idf, count(*) AS df FROM t GROUP BY pos),
x AS (SELECT id, t.pos, tf * ln(((SELECT count(DISTINCT doc_id) FROM documents) + 1) / (df + 1)) AS w FROM t JOIN d ON d.pos = t.pos WHERE df < (SELECT count(DISTINCT doc_id) FROM documents)),
n AS (SELECT id, sqrt(sum(w * w)) AS norm FROM x GROUP BY id)
SELECT x.id, pos, round(w / norm, 6) AS weight FROM x JOIN n ON n.id = x.id""")
def q_embed_texts(spark, base):
    """V2 by built-in functions over whole texts."""
    found = retrieval.hashed_tfidf(spark.read.parquet(f"{base}/documents.parquet"), "doc_id")
    return found.select("id", "pos", F.round("weight", 6).alias("weight"))


SEARCH_TERMS = ("t1110", "USER_1", "10.0.", "192.168.1.1", "high", "brute force", "r_", "7", "nothing like it", "T1021 - Remote")


@register("incident_search_indexed", O.chain() + f"""
SELECT term, log_id FROM analyzed, (VALUES {", ".join(f"({O._q(t)})" for t in SEARCH_TERMS)}) s(term)
WHERE contains(lower(coalesce(username, '')), lower(term)) OR contains(lower(coalesce(source_ip, '')), lower(term))
   OR contains(lower(coalesce(final_risk_level, '')), lower(term)) OR contains(lower(coalesce(mitre_techniques, '')), lower(term))""")
def q_incident_search_indexed(spark, base):
    """R15 through the index of distinct values, for ten terms, some of them short."""
    from ..operators import searchindex
    rows = _analyzed(spark, base)
    index = searchindex.build(rows)
    out = None
    for term in SEARCH_TERMS:
        found = searchindex.search(rows, index, term).select(F.lit(term).alias("term"), "log_id")
        out = found if out is None else out.unionByName(found)
    return out


# ---------------------------------------------------------------- streams

SLICES = 4


def write_slices(spark: SparkSession, base: str, path: str, times: int = 1) -> list[DataFrame]:
    """Event records in time order, one folder's worth at a time (collectors deliver so)."""
    recs = materialize(records.records_from_raw(_raw(spark, base)).drop("host_ip").withColumn("at", parse_mixed_timestamp("time_generated")), "records")
    low, high = recs.agg(F.min("at"), F.max("at")).first()
    step = (high - low) / SLICES if low else None
    bounds = [low + step * k for k in range(1, SLICES)] if low else []
    parts = []
    for k in range(SLICES if low else 0):
        part = recs
        if k:
            part = part.where(F.col("at") >= ntz_lit(bounds[k - 1]))
        if k < SLICES - 1:
            part = part.where(F.col("at") < ntz_lit(bounds[k]))
        parts.append(part.drop("at"))
    return parts


def run_slices(spark: SparkSession, base: str, build, name: str, times: int = 1) -> str:
    """Delivers each slice (``times`` times) and runs the stream over what is new, always from the
    same checkpoint; returns the output folder."""
    from ..streaming import ingest
    work = folder(spark, name)
    for part in write_slices(spark, base, work):
        for _ in range(times):
            part.write.mode("append").json(os.path.join(work, "in"))
        stream = ingest.to_raw_stream(ingest.read_event_stream(spark, os.path.join(work, "in")))
        query = (build(stream).writeStream.format("parquet").option("path", os.path.join(work, "out"))
                 .option("checkpointLocation", os.path.join(work, "ck")).outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()
    return os.path.join(work, "out")


PROJECTED = O.chain("raw_logs") + "," + _records_sql() + ", projected AS (" + _projection_sql() + "), mark AS (SELECT max(timestamp) - INTERVAL 10 MINUTE AS final_mark FROM projected)"


@register("stream_failed_window", PROJECTED + """
SELECT * FROM (SELECT username, record_number AS log_id, epoch_us(timestamp) AS event_us,
 CAST(sum(CASE WHEN event_id = 4625 THEN 1 ELSE 0 END) OVER (PARTITION BY username ORDER BY epoch_us(timestamp)
   RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS failed_last_10min, timestamp
 FROM projected WHERE username IS NOT NULL) t WHERE timestamp <= (SELECT final_mark FROM mark)""".replace("SELECT * FROM (", "SELECT username, log_id, event_us, failed_last_10min FROM ("))
def q_stream_failed_window(spark, base):
    """K1, K3, K5, K7: records arrive in slices, are projected and freed of replays,
    and leave with their trailing failure count once the watermark passes them."""
    from ..streaming import stateful

    def build(stream):
        flagged = stream.withColumns({"log_id": F.col("record_number"), "is_failed_login": (F.col("event_id") == 4625).cast("int")})
        return stateful.failed_window_stream(flagged)
    return spark.read.schema(stateful.OUTPUT_SCHEMA).parquet(run_slices(spark, base, build, "stream"))


@register("stream_replay", PROJECTED + """
SELECT host, count(*) AS n_rows, count(DISTINCT record_number) AS n_records FROM projected GROUP BY host""")
def q_stream_replay(spark, base):
    """K2, K3: every file is delivered twice; each record arrives in the raw table once."""
    out = run_slices(spark, base, lambda stream: stream.drop("event_time"), "replay", times=2)
    return spark.read.parquet(out).groupBy("host").agg(F.count("*").alias("n_rows"), F.countDistinct("record_number").alias("n_records"))


@register("stream_timeline", PROJECTED + """
SELECT strftime(timestamp, '%Y-%m-%d %H:00') AS hour, count(*) AS count FROM projected
WHERE date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= (SELECT final_mark FROM mark) GROUP BY 1""")
def q_stream_timeline(spark, base):
    """K6: events per hour, of the hours that the watermark has closed."""
    from ..streaming import windows
    return spark.read.schema("hour string, count long").parquet(run_slices(spark, base, windows.hourly_timeline, "timeline"))


@register("stream_spray", PROJECTED + """
SELECT date_trunc('hour', timestamp) AS window_start, source_ip, count(DISTINCT username) AS failed_users FROM projected
WHERE event_id = 4625 AND date_trunc('hour', timestamp) + INTERVAL 1 HOUR <= (SELECT final_mark FROM mark) GROUP BY 1, 2 HAVING count(DISTINCT username) >= 2""")
def q_stream_spray(spark, base):
    """K8: the addresses that failed to log on two users or more in an hour, of the hours that the watermark has closed; every file is delivered twice."""
    from ..streaming import windows
    out = run_slices(spark, base, lambda stream: windows.spray_candidates(stream, threshold=2), "spray", times=2)
    found = spark.read.schema("window_start timestamp, source_ip string, failed_users long").parquet(out)
    return found.withColumn("window_start", F.to_timestamp_ntz(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


#: The SQL chain from rows to scores, over the projected records instead of raw_logs, without a model.
_ON_RECORDS = O.chain("ruled")[O.chain("raw_logs").rstrip().__len__():].replace("count(DISTINCT machine)", "count(DISTINCT split_part(log_id, ':', 1))").replace("FROM raw_logs", "FROM (SELECT concat(host, ':', CAST(record_number AS VARCHAR)) AS log_id, *, 0.0 AS value FROM projected)")
_LABELS = ", ".join(f"CASE WHEN {c} THEN {O._q(label)} END" for c, label in O.LABELS)


# The slices come without the host's own address, which the projection would take for process events.
@register("stream_detection", PROJECTED.replace("coalesce(host_ip, '127.0.0.1')", "'127.0.0.1'") + _ON_RECORDS + f"""
SELECT split_part(log_id, ':', 1) AS host, CAST(split_part(log_id, ':', 2) AS BIGINT) AS record_number, failed_last_10min, user_failed_count, user_unique_ips, user_unique_machines,
 ip_unique_failed_users, CAST({O.RULE_SCORE} AS INTEGER) AS rule_score, concat_ws(', ', {_LABELS}) AS mitre_techniques,
 CASE WHEN {O.RULE_SCORE} >= 9 THEN 'CRITICAL' WHEN {O.RULE_SCORE} >= 6 THEN 'HIGH' WHEN {O.RULE_SCORE} >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS final_risk_level FROM ruled""")
def q_stream_detection(spark, base):
    """K4: four slices, each processed as it comes, one replayed, the aggregates compacted on the way; then the scores of all rows."""
    from ..streaming import incremental
    store = incremental.Store(spark, folder(spark, "detection"), compact_every=2)
    for k, part in enumerate(write_slices(spark, base, "")):
        batch = materialize(winevents.to_raw_logs(part), "slice")
        store.process(batch, k)
        store.process(batch, k)  # a replay of what is committed changes nothing
    return store.analyzed().select("host", "record_number", "failed_last_10min", "user_failed_count", "user_unique_ips", "user_unique_machines", "ip_unique_failed_users",
                                   "rule_score", "mitre_techniques", "final_risk_level")


# ---------------------------------------------------------------- the whole sanitiser, and scopes

_KEPT_IDS = f"""array_to_string(list_transform(range(1, len(parts) + 1), lambda i: concat(parts[i],
  CASE WHEN i <= len(ids) AND list_contains(ok, ids[i]) THEN ids[i] ELSE '' END)), '')"""
catalog.ORACLE["report_sanitize"] = O.chain("raw_logs") + "," + O.REPORTS + f""",
s1 AS (SELECT id, allowed, {O.soften_sql('text', 'allowed')} AS t FROM reports),
s2 AS (SELECT id, allowed, {O.list_filter_sql('t', 'allowed')} AS t FROM s1),
s3 AS (SELECT id, allowed, string_split_regex(t, {O._q(O.TID)}) AS parts, regexp_extract_all(t, {O._q(O.TID)}) AS ids, {O.allowed_ids_sql('allowed')} AS ok FROM s2),
s4 AS (SELECT id, allowed, {_KEPT_IDS} AS t FROM s3),
s5 AS (SELECT id, {O.mitre_rewrite_sql('t', 'allowed')} AS t FROM s4)
SELECT id, {O.squeeze_sql('t')} AS sanitized FROM s5"""


@register("techniques_by_machine", O.chain() + """,
p AS (SELECT DISTINCT machine, trim(unnest(string_split(mitre_techniques, ','))) AS technique FROM analyzed WHERE final_risk_level IN ('CRITICAL', 'HIGH'))
SELECT machine, technique, CAST(row_number() OVER (PARTITION BY machine ORDER BY regexp_extract(technique, '^T[0-9.]+'), technique) AS INTEGER) AS rank
FROM p WHERE technique <> ''""")
def q_techniques_by_machine(spark, base):
    """G3 per scope (here per collector)."""
    return guardrails.allowed_techniques(_analyzed(spark, base), scope=("machine",)).select("machine", "technique", "rank")


@register("raw_defaults", O.chain("raw_logs") + """
SELECT source_machine, CAST(count(*) AS BIGINT) AS value FROM raw_logs WHERE source_machine IN ('DOMAIN_CONTROLLER', 'CLIENT_MACHINE') GROUP BY 1""")
def q_raw_defaults(spark, base):
    """Metrics of a frame without process, command and address columns; each row counts under the empty key."""
    from ..operators import rawmetrics
    counts = rawmetrics.key_counts(_raw(spark, base).select("log_id", "source_machine", "event_id", "timestamp"))
    return counts.where("metric = 'top_processes' and key = ''").select("source_machine", "value")


@register("raw_metrics_empty", O.chain("raw_logs") + """,
m AS (SELECT * FROM (VALUES ('DOMAIN_CONTROLLER'), ('CLIENT_MACHINE')) m(source_machine)), r AS (SELECT * FROM raw_logs WHERE source_machine = 'DOMAIN_CONTROLLER')
SELECT m.source_machine, count(r.log_id) AS rows, count(DISTINCT CASE WHEN r.log_id IS NOT NULL THEN coalesce(username, '') END) AS unique_users,
 count(DISTINCT CASE WHEN r.log_id IS NOT NULL THEN coalesce(trim(source_ip), '') END) AS unique_ips FROM m LEFT JOIN r ON r.source_machine = m.source_machine GROUP BY 1""")
def q_raw_metrics_empty(spark, base):
    """A collector that sent nothing counts zero."""
    from ..operators import rawmetrics
    return rawmetrics.raw_metrics(_raw(spark, base).where("source_machine = 'DOMAIN_CONTROLLER'"))


@register("lateral_by_host", PROJECTED + """,
u AS (SELECT username, count(DISTINCT host) AS user_unique_machines FROM projected GROUP BY username)
SELECT host, record_number, coalesce(user_unique_machines, 0) AS user_unique_machines, CAST(coalesce(user_unique_machines, 0) > 1 AS INTEGER) AS lateral_movement_flag
FROM projected p LEFT JOIN u ON p.username = u.username""")
def q_lateral_by_host(spark, base):
    """A4, D3: rows that name their host are told apart by it."""
    from . import detection
    rows = materialize(winevents.to_raw_logs(records.records_from_raw(_raw(spark, base))), "rows")
    return detection.analyze(rows, model="none").select("host", "record_number", "user_unique_machines", "lateral_movement_flag")


@register("evidence_by_scope", O.chain() + f""",
x AS (SELECT *, unnest(['all', 'day', 'collector']) AS scope, unnest(['', coalesce(strftime(timestamp, '%Y-%m-%d'), ''), coalesce(machine, '')]) AS scope_value FROM analyzed),
k AS (SELECT scope, scope_value, count(*) AS total_events, count(*) FILTER (WHERE is_anomaly = 1) AS total_anomalies, sum(total_threat_score) AS score_sum, count(total_threat_score) AS score_n,
  count(*) FILTER (WHERE total_threat_score >= 7) AS high_confidence_cases, count(*) FILTER (WHERE total_threat_score BETWEEN 4 AND 6) AS medium_confidence_cases,
  count(*) FILTER (WHERE total_threat_score <= 3) AS low_confidence_cases, count(DISTINCT CASE WHEN {catalog.HIGH} THEN username END) AS unique_high_users,
  count(DISTINCT CASE WHEN {catalog.HIGH} THEN source_ip END) AS unique_high_ips, count(DISTINCT CASE WHEN {catalog.HIGH} THEN mitre_techniques END) AS unique_mitre_techniques,
  count(*) FILTER (WHERE final_risk_level = 'CRITICAL') AS n_critical, count(*) FILTER (WHERE final_risk_level = 'HIGH') AS n_high,
  count(*) FILTER (WHERE final_risk_level = 'MEDIUM') AS n_medium, count(*) FILTER (WHERE final_risk_level = 'LOW') AS n_low FROM x GROUP BY scope, scope_value),
t AS (SELECT scope, scope_value, string_agg(technique, ' | ' ORDER BY regexp_extract(technique, '^T[0-9.]+'), technique) AS techniques FROM
  (SELECT DISTINCT scope, scope_value, trim(unnest(string_split(mitre_techniques, ','))) AS technique FROM x WHERE {catalog.HIGH}) d WHERE technique <> '' GROUP BY scope, scope_value),
i AS (SELECT scope, scope_value, string_agg(concat(log_id, '|', coalesce(username, ''), '|', source_ip, '|', final_risk_level, '|', total_threat_score, '|', mitre_techniques), chr(10) ORDER BY rank) AS incidents FROM
  (SELECT *, row_number() OVER (PARTITION BY scope, scope_value ORDER BY total_threat_score DESC, timestamp DESC NULLS LAST, log_id) AS rank FROM x WHERE {catalog.HIGH}) r WHERE rank <= 10 GROUP BY scope, scope_value)
SELECT k.scope, k.scope_value, total_events, total_anomalies, {O.round2('100 * total_anomalies', 'total_events')} AS anomaly_rate, {O.round2('score_sum', 'score_n')} AS avg_threat_score,
 high_confidence_cases, medium_confidence_cases, low_confidence_cases, unique_high_users, unique_high_ips, unique_mitre_techniques, n_critical, n_high, n_medium, n_low,
 CASE WHEN high_confidence_cases > 5 AND unique_high_users > 1 AND unique_high_ips > 1 AND unique_mitre_techniques > 1
      THEN 'STRONG_CORRELATED_ATTACK' WHEN medium_confidence_cases > 0 THEN 'MODERATE_CORRELATION_NO_CONFIRMED_COMPROMISE' ELSE 'LOW_CONFIDENCE_ACTIVITY' END AS machine_verdict,
 CAST(least(100, high_confidence_cases * 5 + medium_confidence_cases * 2 + unique_mitre_techniques * 3 + unique_high_ips * 2) AS BIGINT) AS confidence_score,
 coalesce(techniques, '') AS techniques, coalesce(incidents, '') AS incidents
FROM k LEFT JOIN t ON t.scope = k.scope AND t.scope_value = k.scope_value LEFT JOIN i ON i.scope = k.scope AND i.scope_value = k.scope_value""")
def q_evidence_by_scope(spark, base):
    """R18 for everything, each day and each collector, from saved rows."""
    from . import evidence
    saved = _analyzed(spark, base)
    risk = {f"n_{name.lower()}": F.col("risk_distribution")[name] for name in reports.RISK_ORDER}
    line = lambda s: F.concat_ws("|", s["log_id"].cast("string"), F.coalesce(s["username"], F.lit("")), s["source_ip"], s["final_risk_level"], s["total_threat_score"].cast("string"), s["mitre_techniques"])
    return evidence.by_scope(saved).select(
        "scope", "scope_value", "total_events", "total_anomalies", "anomaly_rate", "avg_threat_score", "high_confidence_cases", "medium_confidence_cases", "low_confidence_cases",
        "unique_high_users", "unique_high_ips", "unique_mitre_techniques", *[c.alias(k) for k, c in risk.items()], "machine_verdict", "confidence_score",
        F.array_join("allowed_mitre_techniques", " | ").alias("techniques"), F.array_join(F.transform("top_incidents", line), "\n").alias("incidents"))


@register("knn_index")
def q_knn_index(spark, base):
    """V4 for large corpora: for every row whose id 20 divides its ten nearest rows among those that the hash-bucket index holds close (recall is tested against the exact path)."""
    from ..operators import lsh
    corpus = spark.read.parquet(f"{base}/embeddings.parquet").select("vec_id", "embedding")
    queries = corpus.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    index = lsh.fit(corpus, bucket_rows=64, k=10)
    return lsh.search(lsh.entries(corpus, index, 10), queries, index, 10)
