import re
import zlib
from collections import Counter

from conftest import SF_SMALL

from seclake.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute_words(docs):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(words):
    """Near words by all deletions: of one word, or of both at the same place."""
    near = {w: set() for w in words}
    holes = {}
    for w in words:
        for k in range(len(w)):
            holes.setdefault((w[:k], w[k + 1:]), []).append(w)
            shorter = w[:k] + w[k + 1:]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def test_documents_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = queries.op13(spark, SF_SMALL).collect()
    want = brute(brute_words(docs))
    assert len(rows) == len(want) > 500 and {tuple(r) for r in rows} == want
    assert any(r.form for r in rows) and any(r.form and r.root != r.form for r in rows)


def test_anagrams_accents_and_chains(spark):
    counts = {"abcdef": 3, "abcdeg": 6, "abcdegg": 12, "xbcdegg": 24, "fedcba": 9, "été×é": 3, "été×éé": 6, "aaaaa": 5, "aaaaaa": 5, "aaaaab": 5, "banana": 4, "bananas": 4, "hbanana": 4, "abcdfe": 100}
    counts |= {f"aaaa{c}aaa": 7 for c in "bcdefgh"}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == brute(counts) and len(got) == len(counts)


def test_odd_rows(spark):
    texts = [(1, "Hello hello HELLO Étéstœuvre"), (1, "Hello hello HELLO"), (None, "hellos hellos hellos"), (2, None), (3, ""), (4, "helloo " * 50_000 + "x" * 100_000), (5, "İstan 😀abcde😀abcde😀abcde")]
    docs = spark.createDataFrame([(i, t, 7, "w") for i, t in texts], "doc_id long, text string, n int, word string")
    got = spelling.group(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == brute(brute_words(texts)) and got
    assert spelling.group(docs.limit(0)).collect() == []
