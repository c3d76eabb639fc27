import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_MID

from seclake.llm import lm, queries


def brute_base(train, texts):
    """(tokens, known, training tokens, base score) by text; the end is a token of its own."""
    split = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for t in train for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    return [(len(split(t)), sum(counts[w] > 0 for w in split(t)), total, sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in split(t))) for t in texts]


def rows_equal(rows, ids, want):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows))
    for g, w in zip(got, sorted((i is None, i or 0, *x) for i, x in zip(ids, want)), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


def test_documents_table(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 3000)  # so that most words take the join
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    got = queries.op4(spark, SF_MID)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = got.collect()
    rows_equal(rows, [i for i, _ in docs], brute_base([t for i, t in docs if not held[i]], [t for _, t in docs]))
    assert all(r.held_out == held[r.doc_id] and r.score < 0 for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) * 0.97  # the model predicts unseen texts better than word counts do


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(k, "a b c a b d " * 20 + f"rare{k}") for k in range(300)], "doc_id long, text string")
    model, _ = lm.train(docs)
    one, two, bias, normaliser = model.tables
    p = np.exp(one[:, None, :] + two[None, :, :] + bias - normaliser[:, :, None])
    assert p.sum(axis=2) == pytest.approx(1, abs=1e-4)
    others = [c for w, c in model.counts.items() if w not in model.head]
    inner = [math.log10(c + lm.SMOOTH) - model.log_other for c in others] + [math.log10(lm.SMOOTH) - model.log_other]
    assert sum(10 ** x for x in inner) == pytest.approx(1)
    # "a" follows "c" or begins, and "b" follows "a": the trained model knows.
    a, b = model.head[b"a"], model.head[b"b"]
    assert p[a, model.head[b"c"], b] > 3 * p[b, a, b]


def test_score_equals_token_by_token(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 3)
    monkeypatch.setattr(lm, "KNOWN", 5)
    texts = ["a a a a b b b c c x y", "a b c", "z z x", "", None, "q A\tB"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, counts = lm.train(docs.where("doc_id < 3"))
    seen = Counter(w for t in texts[:3] for w in t.encode().lower().split())
    one, two, bias, normaliser = model.tables
    for r in lm.score(docs, model, counts).collect():
        words, total, w1, w2 = (texts[r.doc_id] or "").encode().lower().split(), 0.0, lm.END, lm.END
        for w in [*words, None]:
            k = lm.END if w is None else model.head.get(w, lm.OTHER)
            total += (one[w1, k] + two[w2, k] + bias[k] - normaliser[w1, w2]) / math.log(10)
            if k == lm.OTHER:
                total += math.log10(seen[w] + lm.SMOOTH) - model.log_other
            w1, w2 = k, w1
        assert r.score == pytest.approx(total, rel=1e-5)


def test_odd_rows(spark):
    texts = [(1, "one two two"), (1, "one two two"), (2, None), (3, ""), (None, "two three"), (5, "w" * 200_000), (6, "é É " * 30_000)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in texts], "doc_id long, text string, word string, row int")
    model, counts = lm.train(docs)
    rows_equal(lm.score(docs, model, counts).collect(), [i for i, _ in texts], brute_base([t for _, t in texts], [t for _, t in texts]))
    model, counts = lm.train(docs.limit(0))
    rows_equal(lm.score(docs, model, counts).collect(), [i for i, _ in texts], brute_base([], [t for _, t in texts]))
    assert lm.score(docs.limit(0), model, counts).collect() == []
