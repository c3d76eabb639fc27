"""The registered queries of the training-data operators, with their DuckDB SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seclake.llm import covertree, htmltext, langid, lm, mixing, packing, phrases, pii, secrets, simhash, spelling, topk, warc
from seclake.llm.common import id_remainder, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: Shares of the tokens by domain that the mix aims at. Clean documents set the total and are all taken; the shares of the last two are upper
#: ones where there is less of them, and no fewer than what the posteriors of clean documents add up to (with less, no rates could meet them).
TARGETS = {"clean": 0.90, "low": 0.04, "toxic": 0.06}
KEPT = "clean"


@register("op1_soft_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.labelled_domains(table(spark, sf_dir, "labels"))
    found = mixing.mix(table(spark, sf_dir, "documents"), labels, TARGETS, keep=KEPT)
    return found.select("doc_id", "tokens", *[F.col("posterior")[d].alias(f"p_{d}") for d in TARGETS], "rate", "copies")


@register("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@register("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (id_remainder("doc_id", 3) == 1).alias("held_out"))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@register("op4_log_bilinear")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (id_remainder("doc_id", 10) == 0).alias("held_out"))
    model, counts = lm.train(docs.where(~F.col("held_out")))
    found = lm.score(docs, model, counts)
    return found.select("doc_id", (id_remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op5_warc_index", """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(hex, 1 + CAST(i // 4 AS INT) * 5, 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_simhash_groups")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op7_cover_tree_join", """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS reached FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON node = vec_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op8_semi_markov_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@register("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op10_histogram_top_k", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
k AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op11_phrase_collocations", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, unnest(list_transform(range(0, least(5, len(ws) - i + 1)), lambda k: array_to_string(list_slice(ws, i, i + k), ' '))) AS phrase FROM s),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 100),
c AS (SELECT lang, phrase, ws, f AS a, unnest(range(1, len(ws))) AS k FROM f),
x AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * a * t.n) // (l.f::HUGEINT * r.f) AS score FROM c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.ws, 1, k), ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.ws, k + 1, len(c.ws)), ' ')
  JOIN t ON t.lang = c.lang),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, f, array_to_string(list_slice(ws, b, b + m - 1), ' ') AS phrase FROM (SELECT lang, f, ws, m, unnest(range(1, len(ws) - m + 2)) AS b FROM (SELECT lang, f, ws, unnest(range(2, len(ws))) AS m FROM f))),
o AS (SELECT lang, phrase, max(f) AS around FROM i GROUP BY lang, phrase),
z AS (SELECT y.* FROM y LEFT JOIN o ON o.lang = y.lang AND o.phrase = y.phrase WHERE around IS NULL OR 100 * around < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM z QUALIFY rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


@register("op12_secret_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.find(docs, secrets.train(docs))


@register("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
