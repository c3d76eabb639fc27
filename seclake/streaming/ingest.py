"""Streaming ingest (K1–K3, K7): exported event-record files → raw_logs.

The stream checkpoint replaces the collectors' high-water file (S4) and
commits only after the sink has written, so delivery is at-least-once;
``dropDuplicatesWithinWatermark`` on ``(host, record_number)`` removes
replays inside the watermark delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.winevents import WIN_EVENT_SCHEMA, to_raw_logs

DEFAULT_DELAY = "10 minutes"


def read_event_stream(spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(WIN_EVENT_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def to_raw_stream(records: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """K1 + K3 + K7: normalise, put an event-time watermark on the stream
    and drop replayed records within it."""
    rows = to_raw_logs(records).withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return (rows.withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["host", "record_number"]))


def start_raw_sink(raw_stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                   interval: str = "60 seconds"):
    """K1/K2 + S5: append to the date-partitioned raw table."""
    writer = (raw_stream.drop("event_time").withColumn("event_date", F.to_date("timestamp"))
              .writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint).partitionBy("event_date").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
