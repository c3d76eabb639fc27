"""Table writers (S5, S6, S10, S11, S13) and the runbook reader."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_LOGS_SCHEMA = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("event_id", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("process_name", T.StringType()),
    T.StructField("command_line", T.StringType()),
    T.StructField("source_machine", T.StringType()),
])


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("timestamp"))


def create_raw_table(spark: SparkSession, path: str) -> None:
    """An empty, date-partitioned ``raw_logs`` dataset (idempotent)."""
    empty = spark.createDataFrame([], RAW_LOGS_SCHEMA)
    with_event_date(empty).write.mode("append").partitionBy("event_date").parquet(path)


MAX_RECORDS_PER_FILE = 5_000_000


def append_raw_logs(df: DataFrame, path: str) -> None:
    """Append rows; the date partition lets time filters prune files.
    Every task writes the dates it holds (no shuffle by date, which would put
    a whole day into one task); files are capped in rows."""
    (with_event_date(df).write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("event_date").parquet(path))


def replace_analyzed(df: DataFrame, base: str, version: int | None = None) -> str:
    """Write a new version directory, then append its name to the list
    of committed versions. A reader takes the newest committed one, so that
    it never sees a half-written table, nor none while one is replaced. The
    same ``version`` (a stream's batch id) written again replaces itself;
    by default it is the time. Rows are sorted by score only within files
    (no global sort)."""
    name = f"v-{time.time_ns() if version is None else version:020d}"
    df.sortWithinPartitions(F.col("total_threat_score").desc()).write.mode("overwrite").parquet(os.path.join(base, name))
    df.sparkSession.createDataFrame([(name,)], "name string").coalesce(1).write.mode("append").text(os.path.join(base, "committed"))
    return os.path.join(base, name)


def read_analyzed(spark: SparkSession, base: str) -> DataFrame:
    newest = spark.read.text(os.path.join(base, "committed")).agg(F.max("value")).first()[0]
    return spark.read.parquet(os.path.join(base, newest))


def export_incidents_csv(incidents: DataFrame, path: str, single_file: bool = False) -> None:
    """Five columns, header, every value quoted. Written in parallel with
    a header in each part file, or with ``single_file`` (for a list known to
    be short) by one task into one file."""
    cols = [F.coalesce(F.col("username"), F.lit("")).alias("username"),
            F.coalesce(F.col("source_ip"), F.lit("")).alias("source_ip"),
            F.coalesce(F.col("final_risk_level"), F.lit("")).alias("risk_level"),
            F.coalesce(F.col("total_threat_score").cast("string"), F.lit("")).alias("threat_score"),
            F.coalesce(F.col("mitre_techniques"), F.lit("")).alias("mitre_techniques")]
    out = incidents.select(*cols)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def load_runbooks(spark: SparkSession, root: str) -> DataFrame:
    """Every ``*.md`` below ``root`` as ``(doc_path, text)``."""
    return (spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
            .select(F.col("_metadata.file_path").alias("doc_path"), F.col("value").alias("text")))


def chunk_key():
    return F.sha2(F.concat_ws("\u0001", F.col("doc_path"), F.col("chunk_idx").cast("string"), F.col("text")), 256)


def save_chunks(chunks: DataFrame, path: str, existing: DataFrame | None = None) -> str:
    """Vector table keyed by a content hash. Only chunks that ``existing``
    (the table read back) lacks are appended, so saving the same ones again
    adds nothing and rewrites nothing."""
    keyed = chunks.withColumn("chunk_key", chunk_key()).dropDuplicates(["chunk_key"])
    if existing is not None:
        keyed = keyed.join(existing.select("chunk_key"), "chunk_key", "left_anti")
    keyed.write.mode("append").parquet(path)
    return path


KEY_BUCKETS = 1024


def key_bucket(buckets: int = KEY_BUCKETS):
    """The bucket of a content hash: its first 32 bits modulo the number of buckets."""
    return F.pmod(F.conv(F.substring("chunk_key", 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def save_chunks_bucketed(chunks: DataFrame, path: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """S13 for large tables: the vector table in folders by a hash of the key. Saving reads the keys of those
    buckets alone that the new chunks fall into (partition pruning; at most ``buckets`` numbers reach the driver), and appends what they
    lack. Returns what was appended. The number of buckets belongs to the table and has to stay as it was."""
    from ..session import list_path, materialize
    spark = chunks.sparkSession
    keyed = materialize(chunks.withColumn("chunk_key", chunk_key()).dropDuplicates(["chunk_key"]).withColumn("bucket", key_bucket(buckets)), "chunks")
    touched = sorted(r["bucket"] for r in keyed.select("bucket").distinct().collect())
    if any(name.startswith("bucket=") for name in list_path(spark, path)):
        there = spark.read.parquet(path).where(F.col("bucket").isin(touched)).select("bucket", "chunk_key")
        keyed = materialize(keyed.join(there, ["bucket", "chunk_key"], "left_anti"), "new-chunks")
    # One task writes a bucket, so that a save adds one file to each; keys in order, so that readers skip row groups.
    keyed.repartition("bucket").sortWithinPartitions("bucket", "chunk_key").write.mode("append").partitionBy("bucket").parquet(path)
    return keyed
