"""JSON upload payloads (S3): each body is a JSON array of event objects
with the seven ``raw_logs`` fields, every field optional."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPLOAD_FIELDS = ("timestamp", "event_id", "username", "source_ip", "process_name", "command_line",
                 "source_machine")
UPLOAD_ROW = T.StructType([T.StructField(f, T.StringType()) for f in UPLOAD_FIELDS])


def parse_uploads(payloads: DataFrame, body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """→ (accepted rows, rejected payloads and elements). A body that is not a
    non-empty JSON array is rejected whole; an element that is not an object
    is rejected by itself, with its position and text in ``pos`` and
    ``element``. So each element of an array is either accepted or
    rejected. A string that spells out an object is none. Inside an object a missing field becomes null. Columns other than
    the body (payload id, sender …) are carried onto every row, and ``log_id`` is a
    stable hash of the payload (its other columns, or its body when it has none) and the position."""
    n = F.json_array_length(F.col(body_col))
    tagged = payloads.withColumn("_ok", F.coalesce(n > 0, F.lit(False)))
    no_pos, no_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    carried = [c for c in payloads.columns if c != body_col]
    identity = [F.col(c) for c in carried] or [F.col(body_col)]
    elements = (tagged.where(F.col("_ok"))
                .select(*carried, body_col, F.xxhash64(*identity).alias("_payload"), F.posexplode(F.arrays_zip(
                    F.from_json(F.col(body_col), "array<string>").alias("text"),
                    F.transform(F.from_json(F.col(body_col), "array<variant>"), lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))).alias("object"))).alias("_pos", "_e"))
                .withColumns({"_element": F.col("_e.text"), "_object": F.col("_e.object")}).drop("_e"))
    is_object = F.coalesce("_object", F.lit(False))
    rows = (elements.where(is_object).withColumn("r", F.from_json("_element", UPLOAD_ROW))
            .select(*carried, F.xxhash64("_payload", "_pos").alias("log_id"),
                    *[F.col(f"r.{f}").alias(f) for f in UPLOAD_FIELDS])
            .withColumn("event_id", F.col("event_id").try_cast("int")))
    whole = tagged.where(~F.col("_ok")).drop("_ok").withColumns(
        {"pos": no_pos, "element": no_text, "reason": F.lit("Invalid payload format. Expected JSON array.")})
    parts = elements.where(~is_object).select(*payloads.columns, F.col("_pos").alias("pos"), F.col("_element").alias("element"),
                                              F.lit("Invalid element. Expected JSON object.").alias("reason"))
    return rows, whole.select(*payloads.columns, "pos", "element", "reason").unionByName(parts)
