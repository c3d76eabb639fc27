import numpy as np
import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

import corpus_pipeline
from seclake.llm import mixing, queries

SCHEMA = "tokens long, posterior array<double>"


def brute_rates(tokens, p, targets, max_rate, rounds=60, tolerance=1e-3):
    """The same descent in numpy."""
    there = (tokens[:, None] * p).sum(axis=0)
    r, before = np.ones(len(tokens)), np.inf
    for _ in range(rounds):
        now = (tokens[:, None] * r[:, None] * p).sum(axis=0)
        squares = ((now - targets) ** 2 / there).sum()
        if (abs(now - targets) <= tolerance * np.maximum(targets, 1e-3 * sum(targets))).all() or squares > mixing.STALLED * before:
            break
        before = squares
        r = np.clip(r - p @ np.where(there > 0, (now - targets) / np.where(there > 0, there, 1), 0), 0, max_rate)
    return r


@pytest.mark.parametrize("max_rate,budget", [(1.0, None), (None, 60_000.0), (None, None), (3.0, 30_000.0)])
def test_rates_meet_the_targets(spark, max_rate, budget):
    draw = np.random.default_rng(1)
    p = draw.dirichlet([0.3, 0.2, 0.1], 400)
    tokens = draw.integers(0, 300, 400)
    soft = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], SCHEMA)
    weights = [0.5, 0.3, 0.2]
    rate, now, targets = mixing.rates(soft, weights, budget, max_rate)
    got = np.array([r.rate for r in soft.withColumn("rate", rate).select("tokens", "posterior", "rate").collect()])
    assert got.min() >= 0 and (max_rate is None or got.max() <= max_rate)
    assert got == pytest.approx(brute_rates(tokens.astype(float), p, np.array(targets), np.inf if max_rate is None else max_rate), abs=1e-6)
    if max_rate is None or budget:
        assert now == pytest.approx(targets, rel=2e-3)
    assert (got[:, None] * tokens[:, None] * p).sum(axis=0) == pytest.approx(now, rel=1e-6)


@pytest.mark.parametrize("low,toxic", [(0.05, 0.0), (0.05, 0.005), (0.05, 0.02), (0.0, 0.0), (0.0, 0.3), (0.11, 0.13)])
def test_scarce_domains_cost_no_clean_document(spark, scratch, low, toxic):
    n, draw = 1000, np.random.default_rng(3)
    kinds = ["toxic"] * int(toxic * n) + ["low"] * int(low * n)
    kinds += ["clean"] * (n - len(kinds))
    texts = [" ".join(draw.choice([f"{d}{k}" for k in range(20)] + [f"any{k}" for k in range(20)], 30)) for d in kinds]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(k, int(d != "low"), int(d == "toxic")) for k, d in enumerate(kinds)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    rows = queries.op1(spark, scratch).collect()
    left = [kinds[r.doc_id] for r in corpus_pipeline.mixture(spark, spark.read.parquet(f"{scratch}/documents.parquet"), scratch).collect()]
    clean = kinds.count("clean")
    assert np.mean([r.rate for r in rows if kinds[r.doc_id] == "clean"]) > 0.98 and left.count("clean") > 0.98 * clean
    for d, share in (("low", low), ("toxic", toxic)):  # all of a scarce domain, else its share
        want = min(share * n, clean * queries.TARGETS[d] / queries.TARGETS["clean"])
        assert sum(r.rate for r in rows if kinds[r.doc_id] == d) == pytest.approx(want, rel=0.1, abs=1)


def test_documents_table(spark):
    got = queries.op1(spark, SF_MID)
    assert got.columns == ["doc_id", "tokens", "p_clean", "p_low", "p_toxic", "rate", "copies"]
    rows = got.collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.tokens == len((docs[r.doc_id] or "").split()) for r in rows)
    assert all(abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-9 and 0 <= r.rate <= 1 and r.copies in (0, 1) for r in rows)
    truth = {r.doc_id: r.domain for r in mixing.labelled_domains(spark.read.parquet(f"{SF_MID}/labels.parquet")).collect()}
    clean = [r for r in rows if truth.get(r.doc_id) == "clean"]
    assert sum(r.copies for r in clean) > 0.95 * len(clean)
    total = {d: sum(r.tokens * r.rate * r[f"p_{d}"] for r in rows) for d in queries.TARGETS}
    share = {d: x / sum(total.values()) for d, x in total.items()}
    assert share == pytest.approx(queries.TARGETS, abs=0.02)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = mixing.labelled_domains(spark.read.parquet(f"{SF_MID}/labels.parquet"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    classifier = mixing.train(docs, labels.where(~fold), ["clean", "low", "toxic"])
    found = docs.join(labels.where(fold), "doc_id").withColumn("x", mixing.classified(docs, classifier)).collect()
    right = [classifier.domains[int(np.argmax(r.x.posterior))] == r.domain for r in found]
    assert np.mean(right) > 0.85


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", 0), (1, "good words here", 0), (2, None, 0), (3, "", 0), (None, "bad words", 0), (4, "bad " * 100_000, 0), (5, "good good", 0), (6, "bad stuff", 0)], "doc_id long, text string, rate int")
    labels = spark.createDataFrame([(1, "a"), (5, "a"), (6, "b"), (4, "b"), (99, "a"), (None, "a"), (3, None), (2, "unknown"), (6, "b")], "doc_id long, domain string")
    rows = mixing.mix(docs, labels, {"a": 0.5, "b": 0.5}).collect()
    assert len(rows) == 8 and all(abs(sum(r.posterior.values()) - 1) < 1e-9 for r in rows)
    assert {r.tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert mixing.mix(docs.limit(0), labels, {"a": 0.5, "b": 0.5}).collect() == []
    flat = mixing.mix(docs, labels.limit(0), {"a": 0.5, "b": 0.5}).collect()
    assert all(list(r.posterior.values()) == [0.5, 0.5] and r.rate == 1 for r in flat)


def test_copies(spark):
    rows = spark.range(20_000).select("id", mixing.copies(F.lit(1.25), F.col("id")).alias("n")).agg(F.avg("n"), F.min("n"), F.max("n")).first()
    assert rows[0] == pytest.approx(1.25, abs=0.02) and rows[1:] == (1, 2)
