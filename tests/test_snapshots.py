import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from seclake import session
from seclake.plans import detection
from seclake.sources import fixtures, marks, records
from seclake.sources.snapshots import Snapshots


def versions(spark, store):
    return [int(n[2:]) for n in session.list_path(spark, store.path) if n.startswith("v-")]


def test_pinned_versions_survive(spark, scratch):
    store = Snapshots(spark, os.path.join(scratch, "t"))
    assert store.newest() == -1 and store.clean() == [] and store.pins() == {}
    with pytest.raises(ValueError):
        store.read()
    store.publish(spark.range(5))
    assert store.pin("a") == 0 and store.pin("late", seconds=-1) == 0
    held = store.read(0)
    for n in (6, 7, 8):
        store.publish(spark.range(n))
    assert store.pins() == {"a": 0} and store.clean(keep=2) == [1] and versions(spark, store) == [0, 2, 3]
    assert held.count() == 5 and store.read().count() == 8
    assert store.pin("a") == 3 and store.clean() == [0, 2]
    with pytest.raises(ValueError):
        store.pin("b", version=0)
    assert store.pins() == {"a": 3}


def test_a_broken_publish_is_not_read_and_goes(spark, scratch, monkeypatch):
    store = Snapshots(spark, os.path.join(scratch, "t"))
    store.publish(spark.range(5))
    with monkeypatch.context() as m:
        m.setattr(store.log, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.publish(spark.range(9))
    assert store.read().count() == 5 and store.clean() == [] and versions(spark, store) == [0, 1]
    assert store.publish(spark.range(6)) == 1 and store.read().count() == 6 and store.clean() == [0]


def test_a_run_leaves_nothing_behind(spark, scratch):
    raw = fixtures.raw_logs(spark, SF_SMALL)
    before = session.list_path(spark, session.checkpoint_dir(spark))
    with session.Scratch(spark) as outer:
        with session.Scratch(spark):
            detection.analyze(raw, model="forest").write.parquet(os.path.join(scratch, "analyzed"))
        assert outer.paths and session.list_path(spark, session.checkpoint_dir(spark)) == before
    assert spark.read.parquet(os.path.join(scratch, "analyzed")).count() == raw.count()
    assert session.materialize(spark.range(3), "kept").count() == 3


def test_marks_and_rows_count_together(spark, scratch):
    """A run that breaks off anywhere neither loses nor repeats records."""
    recs = session.materialize(records.records_from_raw(fixtures.raw_logs(spark, SF_SMALL)), "records")
    collector = marks.Collector(spark, os.path.join(scratch, "c"))
    with pytest.raises(ValueError):
        collector.rows()
    assert collector.collect(recs.where("record_number < 300")) == 0
    collector.append(recs.where("record_number < 700"), 1, collector.marks())
    assert collector.last() == 0 and collector.rows().agg(F.max("record_number")).first()[0] < 300
    assert collector.collect(recs.where("record_number < 500")) == 1
    assert collector.collect(recs) == 2 and collector.collect(recs) == 3
    got = collector.rows().groupBy("host", "record_number").count()
    assert got.where("count > 1").count() == 0
    from seclake.sources import winevents
    assert got.count() == winevents.to_raw_logs(recs).count()
    assert {r.host: r.mark for r in collector.marks().collect()} == {r.host: r.m for r in recs.groupBy("host").agg(F.max("record_number").alias("m")).collect()}


def test_saving_chunks_reads_the_touched_buckets_alone(spark, scratch):
    from seclake.sources import sinks
    path = os.path.join(scratch, "chunks")
    chunks = spark.range(3000).select(F.col("id").cast("string").alias("doc_path"), F.lit(0).alias("chunk_idx"), F.concat(F.lit("text "), (F.col("id") % 2990).cast("string")).alias("text"))
    assert sinks.save_chunks_bucketed(chunks, path, 256).count() == 3000
    some = chunks.where("int(doc_path) % 100 = 0").unionByName(spark.createDataFrame([("new", 0, "one more")], chunks.schema))
    keyed = some.withColumn("chunk_key", sinks.chunk_key()).withColumn("bucket", sinks.key_bucket(256))
    touched = {r.bucket for r in keyed.collect()}
    there = spark.read.parquet(path).where(F.col("bucket").isin(sorted(touched)))
    assert len(touched) <= 31 and {int(f.split("bucket=")[1].split("/")[0]) for f in there.inputFiles()} >= touched
    assert "PartitionFilters: [bucket" in (plan := there._jdf.queryExecution().executedPlan().toString()) or "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    appended = sinks.save_chunks_bucketed(some, path, 256).collect()
    assert [r.doc_path for r in appended] == ["new"]
    saved = spark.read.parquet(path)
    assert saved.count() == 3001 and sinks.save_chunks_bucketed(chunks.limit(0), path, 256).count() == 0
    assert saved.where("bucket <> pmod(cast(conv(substring(chunk_key, 1, 8), 16, 10) as bigint), 256)").count() == 0
