import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seclake.llm import phrases


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(docs, least, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            counts[lang].update(tuple(ws[i:i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
    out = set()
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in known.items():
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and known[q] >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in known):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out |= {(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)}
    return out


DOCS = [("en", "One two three, one TWO three one\ttwo  three four! one two"), ("en", "one two three four five six seven one two three four five six seven"), ("en", None), (None, "a b a b a b a a a a"), ("und", "a b\x0ba b"),
        ("fr", "été été été été; Été été"), ("fr", ""), ("de", "x y z x y z 😀 z"), ("en", "one two three" * 3), ("en", "one two three, one TWO three one\ttwo  three four! one two")]


@pytest.mark.parametrize("budget", [1, 3, 6, 1000])
def test_against_brute_force(spark, budget):
    """Small budgets open prefixes of all lengths."""
    docs = spark.createDataFrame([(k, lang, t, "x", 5) for k, (lang, t) in enumerate(DOCS)], "doc_id long, lang string, text string, phrase string, n int").repartition(3)
    for least, top in ((2, 3), (2, 1000), (3, 1000)):
        got = phrases.mine(docs, min_count=least, top=top, budget=budget, bits=1 << 17).collect()
        assert {tuple(r) for r in got} == brute(DOCS, least, top) and got


def test_hashes_that_collide_change_nothing(spark):
    docs = spark.createDataFrame([(lang, t) for lang, t in DOCS], "lang string, text string")
    got = phrases.mine(docs, min_count=2, budget=2, bits=64).collect()
    assert {tuple(r) for r in got} == brute(DOCS, 2, 2000)


def test_long_and_empty(spark):
    docs = [("en", "the cat sat on the mat " * 20_000), ("en", "word" * 50_000), ("en", "\n" * 10_000)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert {tuple(r) for r in phrases.mine(df, min_count=100).collect()} == brute(docs, 100, 2000)
    assert phrases.mine(df.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 2)] * 5), min_size=1, max_size=60))
def test_tree_counts(rows):
    rows = np.array([[*r[:2], 0, 0, 0] if r[2] == 0 else r for r in rows], dtype=np.int32) + 0
    rows = np.array([[v if all(r[:k + 1]) else 0 for k, v in enumerate(r)] for r in rows.tolist()], dtype=np.int32)
    distinct, numbers = phrases.distinct_rows(rows)
    assert Counter(map(tuple, rows.tolist())) == dict(zip(map(tuple, distinct.tolist()), numbers.tolist()))
    got = {tuple(node): n for nodes, totals in phrases.tree_counts(distinct, numbers, np.ones(len(distinct), dtype=np.uint8), 2) for node, n in zip(nodes.tolist(), totals.tolist())}
    want = Counter(tuple(r[:d]) for r in rows.tolist() for d in range(2, 6) if all(r[:d]))
    assert got == {p: n for p, n in want.items() if n >= 2}


def test_blocks_round_trip():
    rows = np.array([[1, 2, 0, 0, 0], [2, 1, 2, 3, 1]], dtype=np.int32)
    names, got, numbers, depth = phrases.unpack_block(phrases.pack_block([b"a", "é".encode(), b"c", b"d"], rows, np.array([5, 7]), np.array([1, 6], dtype=np.int8)))
    assert names == [b"a", "é".encode(), b"c"] and got.tolist() == rows.tolist() and numbers.tolist() == [5, 7] and depth.tolist() == [1, 6]


def test_groups_keep_to_the_budget():
    loads = {k: (k * 37) % 50 + 1 for k in range(1000)} | {5000: 500}
    group = phrases.best_fit(loads, 100)
    sums = Counter()
    for k, n in loads.items():
        sums[group[k]] += n
    assert sums[group[5000]] == 500 and all(n <= 100 for g, n in sums.items() if g != group[5000]) and len(sums) < sum(loads.values()) / 90
