"""K4 by deltas: what the store says after any batches equals one run over everything."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake.config import DEFAULT
from seclake.operators import forest
from seclake.plans import detection
from seclake.session import materialize
from seclake.sources import fixtures
from seclake.streaming import incremental, ingest

COLS = ["log_id", "failed_last_10min", "user_event_count", "user_failed_count", "user_unique_ips", "user_unique_machines", "ip_event_count", "ip_unique_failed_users",
        "hour_deviation", "ip_subnet_enc", "is_anomaly", "rule_score", "mitre_techniques", "final_risk_level"]


def rows_of(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*COLS).collect())


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(fixtures.raw_logs(spark, SF_SMALL), "raw")


@pytest.fixture(scope="module")
def wanted(raw):
    return rows_of(detection.analyze(raw, model="none"))


def test_shuffled_batches_equal_one_run(spark, raw, wanted, scratch):
    """Rows are dealt to batches at random, so most come late; a base is written on the way."""
    store = incremental.Store(spark, scratch, compact_every=2)
    for k in range(4):
        assert store.process(raw.where(F.pmod(F.xxhash64("log_id"), F.lit(4)) == k), 10 + 3 * k)
        assert not store.process(raw, 10 + 3 * k)
    assert store.newest() == (19, 19) or store.newest()[0] == 19
    assert rows_of(store.analyzed()) == wanted
    assert store.process(raw.limit(0), 30) and rows_of(store.analyzed()) == wanted


def test_a_broken_batch_is_written_anew(spark, raw, wanted, scratch, monkeypatch):
    store = incremental.Store(spark, scratch, compact_every=0)
    first, second = raw.where("log_id % 3 = 0"), raw.where("log_id % 3 <> 0")
    store.process(first, 0)
    before = rows_of(store.analyzed())
    for broken in ("_commit", "profiles"):
        with monkeypatch.context() as m:
            m.setattr(incremental.Store, broken, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                store.process(second, 1)
        assert rows_of(store.analyzed()) == before
    store.process(second, 1)
    assert rows_of(store.analyzed()) == wanted
    store.compact()
    assert store.newest() == (1, 1) and rows_of(store.analyzed()) == wanted


def test_saved_model(spark, raw, scratch):
    feats = materialize(detection.features_of(raw), "features")
    fitted = forest.fit(feats, DEFAULT)
    saved = forest.SavedModel(fitted, -0.5)
    store = incremental.Store(spark, scratch)
    for k in range(2):
        store.process(raw.where(F.col("log_id") % 2 == k), k)
    assert rows_of(store.analyzed(saved)) == rows_of(detection.analyze(raw, model="saved", saved=saved))


def test_a_batch_reads_only_the_dates_around_it(spark, raw, scratch):
    store = incremental.Store(spark, scratch)
    mid = raw.agg(F.expr("min(timestamp) + (max(timestamp) - min(timestamp)) * 0.8")).first()[0]
    store.process(raw.where(F.col("timestamp") < F.lit(mid)), 0)
    new = raw.where(F.col("timestamp") >= F.lit(mid)).select("log_id", "username", "timestamp", F.lit(0).alias("is_failed_login"))
    old = store._around(new, 0)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    every = spark.read.parquet(os.path.join(scratch, "rows"))
    assert len(old.inputFiles()) == len(every.inputFiles()) and old.select(F.to_date("timestamp")).distinct().count() <= 2 < every.select("event_date").distinct().count()


def test_stream_runs_the_store(spark, raw, scratch):
    from test_streaming import write_records
    src = os.path.join(scratch, "in")
    write_records(spark, src)
    stream = ingest.to_raw_stream(ingest.read_event_stream(spark, src, max_files=1))
    incremental.start(stream, os.path.join(scratch, "store"), os.path.join(scratch, "ck")).awaitTermination(400)
    store = incremental.Store(spark, os.path.join(scratch, "store"))
    got = store.analyzed()
    batch = ingest.to_raw_logs(spark.read.schema(ingest.WIN_EVENT_SCHEMA).json(src))
    assert rows_of(got) == rows_of(detection.analyze(batch, model="none"))
    final = {r.log_id for r in got.where("final_risk_level in ('CRITICAL', 'HIGH')").collect()}
    assert {r.log_id for r in store.alerts().collect()} <= final
