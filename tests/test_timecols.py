"""The forms in full width give what the patterns for every form give, and skip them."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake.functions import timecols

TEXTS = ["2024-01-15 08:00:00", "2024-01-15T08:00:00", "2024-01-15 08:00:00.1", "2024-01-15 08:00:00.123456", "2024-01-15 08:00:00.1234567", "2024-13-15 08:00:00", "2024-02-30 08:00:00", "2024-01-15 24:00:00",
         "2024-01-15 08:60:00", "2024-01-15 08:00:61", "0000-01-15 08:00:00", "0001-01-15 08:00:00", "2024-01-15 08:00:00\n", " 2024-01-15 08:00:00", "2024-01-15 08:00:00Z", "2024-01-15 08:00", "Mon Jan 15 08:00:00 2024",
         "MON JAN 15 08:00:00 2024", "xyz dec 01 23:59:59 1999", "Mon Anf 15 08:00:00 2024", "Mon Xyz 15 08:00:00 2024", "Mon Jan 32 08:00:00 2024", "Mon Jan 15 25:00:00 2024", "Mon Jan  5 08:00:00 2024", "Mon Jan 5 08:00:00 2024",
         "Mon Jan 15 08:00:00 2024 ", "Mon Jan 15 08:00:00 0000", "٢024-01-15 08:00:00", "", "garbage", None]


def test_full_width_forms_agree(spark):
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(TEXTS)], "k int, s string")
    got = rows.select("s", timecols.parse_mixed_timestamp("s").cast("string").alias("fast"), timecols.parse_any_timestamp(F.col("s")).cast("string").alias("any")).collect()
    assert [r for r in got if r.fast != r["any"]] == []
    assert sum(r.fast is not None for r in got) >= 12


def test_full_width_forms_skip_the_patterns(spark, monkeypatch):
    monkeypatch.setattr(timecols, "parse_any_timestamp", lambda c: F.raise_error(F.concat(F.lit("searched: "), c)).cast("timestamp_ntz"))
    rows = spark.createDataFrame([("2024-01-15 08:00:00",), ("Mon Jan 15 08:00:00 2024",)], "s string")
    assert rows.select(timecols.parse_mixed_timestamp("s").alias("t")).distinct().count() == 1


def test_projection_strips_a_row_once(spark):
    """One strip of the array in the plan, where each look at a string had its own."""
    from seclake.sources import records, winevents, fixtures
    recs = records.records_from_raw(fixtures.raw_logs(spark, SF_SMALL))
    plan = winevents.to_raw_logs(recs)._jdf.queryExecution().optimizedPlan().toString()
    shown = plan.count("transform(string_inserts") + plan.count("regexp_replace(string_inserts[")
    assert shown == 1
