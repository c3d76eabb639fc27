import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from seclake.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    """The contract's patterns, as they are written."""
    digits = lambda x: "".join(c for c in x if "0" <= c <= "9")

    def luhn(d):
        total = 0
        for k, c in enumerate(d[::-1]):
            x = int(c) * (1 + k % 2)
            total += x - 9 * (x > 9)
        return total % 10 == 0
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


TEXTS = [None, "", "a@b.c", "x a.b+c@d-e.f.g. y", "a@b", "@b.c", "a@b.c@d.e", "a@b@c.d", "é@b.c éa@b.c", "1.2.3.4", "1.2.3.4.5", "1.2.3.256", "01.002.0003.4", "1.2.3", "1.2.3.4.5.6.7.8", "a1.2.3.4b",
         "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111 x", "4111111111111112", "12 4111111111111111", "4111111111111111 4111111111111111", "4111  1111 1111 1111",
         "+1 (389) 555-5010", "+1 (389) 555-5010 4111111111111111", "+12", "+1234567", "+12345678", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++12345678)", "+1........2345678.",
         "+1 (389) 555-5010, a@b.co 10.0.0.1", "\U0001f600 a@b.co", "١٢٣٤ 1٢.3.4.5"]


@pytest.mark.parametrize("text", TEXTS)
def test_base(text):
    assert pii.base_spans(text or "") == brute_base(text or "")


def test_base_on_random_texts():
    draw = random.Random(7)
    for _ in range(3000):
        text = "".join(draw.choice(["4111111111111111", "1", "23", "256", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "\n"]) for _ in range(draw.randint(1, 30)))
        assert pii.base_spans(text) == brute_base(text), text


def test_long_runs_are_linear():
    for c in "1aA.@+- ":
        pii.base_spans(c * 300_000)
    pii.base_spans("1." * 150_000 + "+1 " * 50_000 + "a@" * 100_000)


def test_best_and_gradient_equal_enumeration():
    """Dynamic programming against all segmentations of a short window."""
    draw = np.random.default_rng(3)
    text = "+1 23.4"
    bounds, spans, features = pii.candidates(text, 0, len(text))
    n, field = len(bounds) - 1, pii.Field(draw.normal(size=(4, pii.BUCKETS)) * 0.3, draw.normal(size=(5, 5)))
    scores = field.scores(features)

    def ways(at, last):
        if at == n:
            yield (), 0.0
            return
        for rest, s in ways(at + 1, 0):
            yield rest, s + field.steps[last, 0]
        for r, (i, j) in enumerate(spans):
            if i == at:
                for y in range(1, 5):
                    for rest, s in ways(j, y):
                        yield ((i, j, y), *rest), s + field.steps[last, y] + scores[r, y - 1]
    every = list(ways(0, 0))
    assert field.best(n, spans, scores) == list(max(every, key=lambda x: x[1])[0])
    gold = {(spans[0][0], spans[0][1]): 4}
    likelihood = lambda: next(s for w, s in ways(0, 0) if w == ((*spans[0], 4),)) - np.logaddexp.reduce([s for _, s in ways(0, 0)])
    off, step_off = field.gradient(n, spans, features, gold)
    for y, r in ((3, 0), (0, 1), (2, len(spans) - 1)):
        old, here = scores[r, y], likelihood()
        scores[r, y] += 1e-6
        assert (likelihood() - here) / 1e-6 == pytest.approx(off[r, y], abs=1e-4)
        scores[r, y] = old
    for y, z in ((0, 0), (0, 4), (4, 0)):
        here = likelihood()
        field.steps[y, z] += 1e-6
        assert (likelihood() - here) / 1e-6 == pytest.approx(step_off[y, z], abs=1e-4)
        field.steps[y, z] -= 1e-6


def check(rows, texts):
    assert len(rows) == len(texts)
    want = sorted(((i, *[sum(s[0] == k for s in brute_base(t or "")) for k in pii.KINDS], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in brute_base(t or "")).encode()).hexdigest()) for i, t in texts), key=repr)
    assert sorted((tuple(r)[:-1] for r in rows), key=repr) == want
    base = {(i, t): {f"{k}:{s}:{e}" for k, s, e in brute_base(t or "")} for i, t in texts}
    for i, t in texts:
        assert any(base[i, t] <= set(r.spans.split(",")) | {""} for r in rows if r.doc_id == i)


def test_documents_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = queries.op8(spark, SF_SMALL).collect()
    assert rows[0].__fields__ == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    check(rows, texts)


def test_the_field_finds_what_a_failed_match_hides_and_little_else(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    field = pii.train(docs)
    hidden = [("pay 4465758382889437 4111111111111111 now", {("card", 4, 20), ("card", 21, 37)}), ("call +1 (663) 555-6869 4465758382889437 or", {("phone", 5, 22), ("card", 23, 39)})]
    for text, want in hidden:
        assert brute_base(text) == [] and set(pii.all_spans(text, field)[1]) == want
    for text in ("built in 1987, sold 12 of 345", "a version 300.1.2.3 here", "number 4465758382889438 is no card", "id 20240105-113 and 3.14159", "see 1.2.3 and @home"):
        assert pii.all_spans(text, field)[1] == []
    added = sum(len(b) - len(a) for a, b in (pii.all_spans(r.text or "", field) for r in docs.collect()))
    base = sum(len(pii.base_spans(r.text or "")) for r in docs.collect())
    assert added <= 0.2 * base


def test_odd_rows_and_redaction(spark):
    texts = [(k, t) for k, t in enumerate(TEXTS)] + [(3, "a@b.co twice"), (None, "+1 (389) 555-5010"), (90, "1" * 2_000), (91, "a " * 100_000 + "x@y.zz")]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in texts], "doc_id long, text string, spans string, n_ip int")
    field = pii.train(docs)
    check(pii.find(docs, field).collect(), texts)
    # The brute force is quadratic in a run of digits; what must hold of a long one is known.
    long = spark.createDataFrame([(1, "1" * 100_000, "x", 0)], docs.schema)
    assert tuple(pii.find(long, field).first()) == (1, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    assert pii.train(docs.limit(0)).weights.any() == False  # noqa: E712
    assert pii.find(docs.limit(0), field).collect() == []
    out = spark.createDataFrame([("to a@b.co, +1 (389) 555-5010.",), (None,), ("none",)], "text string")
    assert [r.t for r in out.select(pii.redact_column(pii.Field(), F.col("text"), spark).alias("t")).collect()] == ["to [EMAIL], [PHONE].", None, "none"]
