"""Property tests: the hand rewrites equal their brute-force definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from seclake.config import DEFAULT, RULE_WEIGHTS
from seclake.functions.timecols import micros
from seclake.operators import features, guardrails, indexing, normalize, prefix, rawmetrics, scoring

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)
RAW = ("log_id long, timestamp timestamp_ntz, event_id int, username string, source_ip string, "
       "process_name string, command_line string, source_machine string")

row_st = st.tuples(st.integers(0, 3), st.integers(0, 7200), st.sampled_from([4624, 4625, 4625, 4688]))


def make_raw(spark, rows):
    data = [(i, BASE + dt.timedelta(seconds=s), e, f"u{u}" if u else None, "10.0.0.1", "p", "", "DOMAIN_CONTROLLER")
            for i, (u, s, e) in enumerate(rows)]
    return spark.createDataFrame(data, RAW)


@SETTINGS
@given(st.lists(row_st, min_size=1, max_size=60), st.sampled_from([1, 3, 10]))
def test_salted_window_equals_plain_window(spark, rows, salt):
    from dataclasses import replace
    df = normalize.with_flags(normalize.normalize(make_raw(spark, rows)))
    salted = features.with_failed_window(df, replace(DEFAULT, window_salt=salt)).select("log_id", "failed_last_10min")
    w = Window.partitionBy("username").orderBy("_us").rangeBetween(-599_999_999, 0)
    plain = (df.withColumn("_us", micros("timestamp"))
             .withColumn("p", F.when(F.col("username").isNotNull(), F.sum("is_failed_login").over(w)).otherwise(0))
             .select("log_id", F.col("p").cast("bigint").alias("failed_last_10min")))
    assert sorted(salted.collect()) == sorted(plain.collect())


@SETTINGS
@given(st.lists(st.integers(0, 5400), min_size=1, max_size=25), st.lists(st.integers(0, 5400), min_size=1, max_size=25))
def test_band_join_equals_brute_force(spark, anomaly_s, proc_s):
    anomalies = spark.createDataFrame([(BASE + dt.timedelta(seconds=s),) for s in anomaly_s], "timestamp timestamp_ntz")
    procs = spark.createDataFrame([(BASE + dt.timedelta(seconds=s), 4688, f"p{s % 3}") for s in proc_s],
                                  "timestamp timestamp_ntz, event_id int, process_name string")
    got = {(r.metric, r.key): r.value for r in rawmetrics.process_near_anomalies(anomalies, procs, 15).collect()}
    pairs = [(p, f"p{p % 3}") for a in anomaly_s for p in proc_s if abs(p - a) <= 900]
    assert got[("matches", "")] == len(pairs)
    for name in {n for _, n in pairs}:
        assert got[("top_processes", name)] == sum(1 for _, n in pairs if n == name)


@SETTINGS
@given(st.lists(st.text(alphabet="ab\n<|>xyz ", max_size=400), min_size=1, max_size=10))
def test_scrub_is_bounded(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for (out,) in df.select(guardrails.scrub("t")).collect():
        assert len(out) <= 200 and "\n" not in out


def test_score_is_weighted_flags_and_level_monotone(spark):
    flags = [f for f, _ in RULE_WEIGHTS]
    import itertools
    import random
    rnd = random.Random(7)
    rows = [tuple(rnd.randint(0, 1) for _ in flags) + (rnd.randint(0, 1), rnd.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in (*flags, "is_anomaly", "is_privileged")))
    out = scoring.with_scores(df).collect()
    order = {"LOW": 0, "MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}
    for r in out:
        expect = sum(r[f] * w for f, w in RULE_WEIGHTS) + (3 if r.is_anomaly else 0)
        assert r.total_threat_score == expect
    ranked = sorted(out, key=lambda r: r.total_threat_score)
    for a, b in itertools.pairwise(ranked):
        assert order[a.final_risk_level] <= order[b.final_risk_level]


def test_dense_index_distributed_path(spark):
    values = spark.createDataFrame([(f"s{i % 37:03d}",) for i in range(500)], "ip_subnet string")
    got = indexing.dense_index(values, "ip_subnet", "enc", partitions=5).collect()
    assert sorted((r.enc, r.ip_subnet) for r in got) == list(enumerate(sorted({f"s{i % 37:03d}" for i in range(500)})))


def test_running_sum_matches_cumsum(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), rnd.randint(0, 2), rnd.randint(0, 5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "t long, kind int, w long")
    got = prefix.running_sum(df, ["t", "kind"], "w", "cum", partitions=7)
    # every row's running total must equal the sum over rows strictly before its (t, kind) key plus its key group
    by_key = {}
    for t, k, w in rows:
        by_key[(t, k)] = by_key.get((t, k), 0) + w
    for r in got.collect():
        before = sum(v for key, v in by_key.items() if key < (r.t, r.kind))
        assert before < r.cum <= before + by_key[(r.t, r.kind)] or (r.w == 0 and before <= r.cum <= before + by_key[(r.t, r.kind)])


def test_incident_sort_equals_plain_sort(spark):
    from seclake.operators import reports
    import random
    rnd = random.Random(11)
    rows = [(i, f"user{rnd.randint(0, 30)}", rnd.randint(0, 12)) for i in range(400)]
    df = spark.createDataFrame(rows, "log_id long, username string, total_threat_score int")
    text = {(r.log_id, r.sort_rank) for r in reports.incident_sort(df, "username", descending=False).collect()}
    num = {(r.log_id, r.sort_rank) for r in reports.incident_sort(df, "total_threat_score").collect()}
    assert text == {(r[0], i + 1) for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert num == {(r[0], i + 1) for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}


def test_order_statistic_equals_sorting(spark):
    """Ties, negative and huge values, neighbours in floating point; few bins, so that bins are split again."""
    import math
    import random
    from seclake.operators import anomaly
    rnd = random.Random(5)
    values = [rnd.gauss(0, 1) for _ in range(300)] + [0.25] * 100 + [1e300, -1e300, 1.0, math.nextafter(1.0, 2.0)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    want = sorted(values)
    for rank in (0, 1, 12, 200, 250, 302, len(values) - 1):
        following = want[rank + 1] if rank + 1 < len(want) else None
        assert anomaly.order_statistics(df.where("v is not null"), rank, want[0], want[-1], bins=7) == (want[rank], following)
    assert anomaly.order_statistics(df.where("v = 0.25"), 99, 0.25, 0.25) == (0.25, None) and anomaly.order_statistics(df.where("v = 0.25"), 98, 0.25, 0.25) == (0.25, 0.25)
    from seclake.config import DEFAULT
    at = (len(values) - 1) * DEFAULT.contamination
    assert anomaly.score_offset(df, "v") == want[int(at)] + (at - int(at)) * (want[int(at) + 1] - want[int(at)])


def test_every_tree_draws_its_own_rows(spark):
    """Distinct fitted rows are close to trees × ψ, not a shared pool."""
    from seclake.config import DEFAULT, MODEL_FEATURES
    from seclake.operators import forest
    n = 200_000
    feats = spark.range(n).select(F.col("id").alias("log_id"), *[F.col("id").cast("double").alias(c) for c in MODEL_FEATURES])
    chosen, psi = forest.sample_for_trees(feats, rows=n)
    sizes = {r["count"] for r in chosen.groupBy("tree_id").count().collect()}
    assert sizes == {psi}
    expected = n * (1 - (1 - psi / n) ** DEFAULT.trees)  # of independent draws
    assert chosen.select("_key").distinct().count() >= 0.97 * expected >= 0.9 * 0.9 * DEFAULT.trees * psi
