import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seclake.llm import simhash


def brute_fingerprint(text, words=4):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    parts = [w for w in __import__("re").split("[ \t\n\x0b\x0c\r]+", t) if w]
    runs = [parts[i:i + words] for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, max_bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


TEXTS = [None, "", " \t\n", "one", "ONE", "a b c", "a b c d", "é É a\u00a0b c\u2003d e", "w " * 50_000, "w " * 50_000,
         " ".join(f"word{i}" for i in range(400)), " ".join(f"word{i}" for i in range(400)) + " tail",
         " ".join(f"Word{i}" for i in range(401)), "x" * 300_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text, 4) == brute_fingerprint(text)


def test_documents(spark):
    rows = [(i, t, "x", i, "y") for i, t in enumerate(TEXTS)] + [(3, "one", "x", 0, "y"), (None, "one", None, 0, None), (99, "b c d e f", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string, row long, component_id string")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    prints = [brute_fingerprint(rows[k][1]) for k in order]
    want = [(rows[k][0], f"{p:016x}", rows[order[g]][0]) for k, p, g in zip(order, prints, brute_groups(prints, 4))]
    assert got == sorted(want, key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.keep_one(docs).collect() == []


@pytest.mark.parametrize("node_rows", [2048, 60])
def test_links_equal_brute_force(spark, monkeypatch, node_rows):
    """Random chains, a dense cluster and strangers; with small nodes the cluster is cut into parts."""
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    draw = random.Random(node_rows)
    centres = [draw.getrandbits(64) for _ in range(30)]
    prints = [draw.getrandbits(64) for _ in range(300)] + [0]
    for c in centres:
        for _ in range(6):
            for b in draw.sample(range(64), draw.choice([1, 2, 4, 5])):
                c ^= 1 << b
            prints.append(c)
    for _ in range(400):
        c = centres[0]
        for b in draw.sample(range(64), 3):
            c ^= 1 << b
        prints.append(c)
    prints = list(dict.fromkeys(prints))
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(i, i, b) for i, b in enumerate(signed)], "row long, id long, bits long")
    got = {r.id: r.component_id for r in simhash.group_fingerprints(rows, 4).collect()}
    assert got == dict(enumerate(brute_groups(prints, 4)))


def test_gray_rank(spark):
    got = spark.range(16).select((F.col("id").bitwiseXOR(F.shiftright("id", 1))).alias("g"), "id").select(simhash.gray_rank(F.col("g")).alias("r"), "id").collect()
    assert all(r.r == r.id for r in got)
