import math
from collections import Counter

import pytest
from conftest import SF_MID, SF_SMALL

from seclake.llm import langid, queries


def test_held_out_accuracy(spark):
    got = queries.op3(spark, SF_MID)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.98


def test_backoff_equals_the_rule():
    """Known words by their own frequency, unseen ones by the longest n-grams that are known."""
    model = langid.fit([("x", Counter(abc=3, abd=1)), ("y", Counter(xyz=2, abc=1))])
    assert model.languages == ["x", "y"]
    known = [math.log(3 / 4), math.log(1 / 3)]
    lang, score = model.predict("ABC")
    assert lang == "x" and score == pytest.approx(math.exp(known[0]) / (math.exp(known[0]) + math.exp(known[1])))
    # "abq": no 5-gram, no 4-gram of the marked word is known, but the 3-gram "^ab" is: x has it 4 times of 12, y once of 9
    want = [math.log(4 / 12), math.log(1 / 9)]
    assert model.unseen("abq") == pytest.approx(want)
    assert (model.unseen("中") == 0).all() and model.predict("中")[1] == pytest.approx(0.5)


def test_words():
    assert langid.words_of("Éa 12 _b_ ² c½2d A a") == Counter({"éa": 1, "b": 1, "c": 1, "d": 1, "a": 2})


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", 0), (2, "le chat et le chien", "fr", 0), (2, "le chat et le chien", "fr", 0), (None, None, "en", 0), (4, "", None, 0), (5, "12 !!", "fr", 0),
            (6, "le " * 100_000, None, 0), (7, "tle" * 100_000, None, 0), (8, "中文", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.train(docs)
    got = langid.predict(docs, model).collect()
    assert [r.lang_pred for r in got] == ["en", "fr", "fr", "und", "und", "und", "fr", got[7].lang_pred, "en"]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = langid.keep(docs, model)
    assert kept.schema == docs.schema and [(r.doc_id, r.lang, r.score) for r in kept.collect()] == [(1, "en", 0), (2, "fr", 0), (2, "fr", 0), (6, "fr", 0), (7, got[7].lang_pred, 0)]
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().executedPlan().toString()
    assert langid.keep(docs.limit(0), model).collect() == []


def brute_fit(texts):
    """Log frequencies of words and n-grams by the rule, from whole texts."""
    words = {lang: Counter(w for l, t in texts if l == lang for w in "".join(c if c.isalpha() else " " for c in t.lower()).split()) for lang in sorted({l for l, _ in texts})}
    grams = {lang: {n: Counter(g for w, k in c.items() for i in range(len(w) + 3 - n) if (g := f"\x02{w}\x03"[i:i + n]).strip("\x02\x03") for _ in range(k)) for n in (5, 4, 3, 2, 1)} for lang, c in words.items()}

    def log(table, total, x):
        return math.log(table[x] / total) if table[x] else math.log(1 / total) - langid.PENALTY

    def predict(text):
        ws = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        if not ws:
            return "und", 0.0
        sums = dict.fromkeys(words, 0.0)
        for w in ws:
            if any(c[w] for c in words.values()):
                for lang, c in words.items():
                    sums[lang] += log(c, c.total(), w)
                continue
            for n in (5, 4, 3, 2, 1):
                gs = [g for i in range(len(w) + 3 - n) if any(t[n][g := f"\x02{w}\x03"[i:i + n]] for t in grams.values())]
                if gs:
                    for lang, t in grams.items():
                        sums[lang] += sum(log(t[n], t[n].total(), g) for g in gs) / len(gs)
                    break
        mean = {lang: x / len(ws) for lang, x in sums.items()}
        best = max(sorted(mean), key=mean.get)
        return best, 1 / sum(math.exp(x - mean[best]) for x in mean.values())
    return predict


def test_predictions_equal_brute_force(spark):
    """Over documents: with all labelled rows drawn, every prediction is that of a second implementation of the rule."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 3000")
    rows = docs.collect()
    predict = brute_fit([(r.lang, r.text) for r in rows if r.doc_id % 2])
    model = langid.train(docs.where("doc_id % 2 = 1"), sample_docs=10**9)
    for r in langid.predict(docs, model).collect():
        lang, score = predict(r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, rel=1e-6)


def test_the_sample_is_bounded_with_null_and_repeated_ids(spark):
    rows = [(None, w + "".join("abcdefghij"[int(c)] for c in f"{k:03d}"), lang) for k in range(400) for w, lang in (("a", "en"), ("b", "fr"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=50)
    assert model.languages == ["en", "fr"] and 20 <= sum(w.startswith("b") for w in model.tables[0][0]) <= 120


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(none)
    assert langid.predict(none, model).collect() == []
    one = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert [tuple(r)[2:] for r in langid.predict(one, model).collect()] == [("und", 0.0)]
