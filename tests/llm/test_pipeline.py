import os

import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from seclake.llm import pii, simhash
from .test_packing import check


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output, as rows, over the smallest documents and planted ones."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long = " ".join(r.text for r in docs.where("lang = 'en'").limit(30).collect()).split()[:3000]
    planted = [(90_000, None, "en"), (90_001, "", "en"), (90_002, "12 34 !!", None), (90_003, " ".join(long[:400]), None), (90_004, " ".join(long[:400]), "en"), (90_005, " ".join(long[:399]) + " other", "en"),
               (90_006, "write to some.one@example.org or +1 (389) 555-5010 about the thing", "en"), (90_007, " ".join(long), "en"), (90_007, " ".join(long), "en"), (None, "the and of to is no id", "en")]
    more = spark.createDataFrame([(i, t, lang, None, len(t or "")) for i, t, lang in planted], docs.schema)
    now, out = docs.unionAll(more).withColumn("posterior", F.lit("extra")), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        path = os.path.join(folder, str(number))
        stage(spark, now, SF_SMALL).write.parquet(path)
        now = spark.read.parquet(path)
        out.append((before.columns, before.collect(), now.columns, now.collect()))
    return out


def test_stages_keep_the_columns(steps):
    for before, _, after, _ in steps[:-1]:
        assert after == before


def test_language(steps):
    _, before, _, after = steps[0]
    rejected = {90_000, 90_001, 90_002}
    assert sorted((r.doc_id or -1, r.text) for r in after) == sorted((r.doc_id or -1, r.text) for r in before if r.doc_id not in rejected)
    assert all(r.lang for r in after) and next(r.lang for r in after if r.doc_id == 90_003) == "en"


def test_near_duplicates(steps):
    _, before, _, after = steps[1]
    prints = [(r, simhash.fingerprint(r.text, 4)) for r in before]
    groups: list[list] = []
    for r, p in prints:
        linked = [g for g in groups if any(bin(p ^ q).count("1") <= 4 for _, q in g)]
        groups = [g for g in groups if g not in linked] + [[(r, p), *[x for g in linked for x in g]]]
    want = [min((r.doc_id is None, r.doc_id or 0) for r, _ in g) for g in groups]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == sorted(want)


def test_personal_data(steps):
    _, before, _, after = steps[2]
    texts = {r.doc_id: r.text for r in after}
    assert texts[90_006] == "write to [EMAIL] or [PHONE] about the thing"
    assert len(after) == len(before) and all(not pii.base_spans(r.text) for r in after) and all(r.n_chars == len(r.text) for r in after)
    clean = {r.doc_id: r.text for r in before if not any(c.isdigit() or c == "@" for c in r.text)}
    assert clean and all(texts[i] == t for i, t in clean.items())


def test_mixture(steps):
    _, before, _, after = steps[3]
    assert {(r.doc_id, r.text) for r in after} <= {(r.doc_id, r.text) for r in before} and len(after) <= len(before)
    assert len(after) > 0.7 * len(before)


def test_packing(steps):
    _, before, _, after = steps[4]
    check([tuple(r)[:7] for r in after], [(r.doc_id, r.text) for r in before], 2048)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert os.path.exists(public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_documents(spark):
    """Every stage returns its columns and no rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.collect() == [], name
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns


def test_language_scores_each_text_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = corpus_pipeline.language(spark, docs, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
