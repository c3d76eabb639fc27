"""Mixing to target weights by soft membership.

1. A classifier fitted on the labelled table gives every document a posterior
   over the domains. It is a softmax regression on the presence of words and
   marks of style (what words end in; how many words are in capitals, how many
   lines are repeated) that depend on the domain (by the G test, at most ``FEATURES`` of them), fitted on
   about ``SAMPLE_DOCS`` labelled documents of each domain, drawn by a hash of
   the id. Whole texts of all documents are classified.
2. Each document gets a nonnegative rate (the number of times it is taken, on
   average), such that the expected tokens of each domain, summed over
   all documents by posterior, meet the targets. Projected gradient descent
   on the squared misses: a round is one aggregation of a number per
   domain, after which every document moves its rate by its own posterior and
   cuts it off at 0 (and at ``max_rate``). The rates are an expression of the posterior and
   the misses so far, so that nothing is gathered but those numbers.
3. A rate becomes copies: its whole part, and one more if a hash of the id
   falls below the rest.

Null text has no tokens and counts as a text without known words. Labels
that are null, or of unknown documents, aren't learned from; a document with several labels
is learned from with each. Without labels all domains are equally likely.
Repeated rows get equal rates and copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import unit_hash
from seclake.session import materialize

SAMPLE_DOCS = 2000
FEATURES = 2000
LEAST_DOCS = 3        # sampled documents that a feature stands in
LEAST_G = 30.0        # the G statistic (of independence) of a feature and the domain
ROUNDS = 60
TOLERANCE = 1e-3      # largest miss of a target, as a share of it
STALLED = 0.97        # share of the squared misses that a round has to go below; else no rates meet the targets better
FIT_ROUNDS = 300
DECAY = 3e-4
PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
USUAL = frozenset({"", ".", ",", ";", ":", "?", "!", ")", "\"", "'"})


class Classifier:
    def __init__(self, domains: list[str], words: dict[str, int], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.words, self.weights, self.bias = domains, words, weights, bias

    def posterior(self, features: set[str]) -> np.ndarray:
        get = self.words.get
        rows = [k for k in map(get, features) if k is not None]
        x = self.bias + self.weights[rows].sum(axis=0)
        x = np.exp(x - x.max())
        return x / x.sum()


def features_of(text: str | None) -> set[str]:
    """Words in lower case without the punctuation around them; and marks of style, which begin with a space."""
    out, capitals, marked = set(), 0, 0
    lines = [x for x in (text or "").split("\n") if x]
    distinct = set((text or "").split())
    for word in distinct:
        core = word.strip(PUNCTUATION)
        out.add(core.lower())
        capitals += len(core) > 1 and core.isupper()
        if core != word and (end := word[word.rfind(core) + len(core):] if core else word) not in USUAL:
            marked += 1
            out.add(f" {end[:5]}")
    if distinct:
        out.add(f" capitals {int(8 * capitals / len(distinct))}")
        out.add(f" marked {int(8 * marked / len(distinct))}")
        out.add(f" repeated {int(8 - 8 * len(set(lines)) / len(lines))}")
    out.discard("")
    return out


def softmax_regression(rows: list[np.ndarray], domain: np.ndarray, n_features: int, n_domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by accelerated gradient descent; domains count alike, whatever their sizes."""
    sizes = np.array([len(r) for r in rows])
    at = np.concatenate([*rows, np.zeros(0, dtype=np.int64)])
    doc = np.repeat(np.arange(len(rows)), sizes)
    truth = np.eye(n_domains)[domain]
    share = (1 / np.maximum(1, truth.sum(axis=0)))[domain][:, None] / n_domains
    weights, bias = np.zeros((n_features, n_domains)), np.zeros(n_domains)
    ahead, ahead_bias, momentum = weights, bias, 1.0
    rate = 4.0 / max(1.0, float(np.quantile(sizes, 0.9)) if len(sizes) else 1.0)
    for _ in range(FIT_ROUNDS):
        scores = np.stack([np.bincount(doc, ahead[at, d], len(rows)) for d in range(n_domains)], axis=1) + ahead_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        off = (scores / scores.sum(axis=1, keepdims=True) - truth) * share
        step = np.stack([np.bincount(at, off[doc, d], n_features) for d in range(n_domains)], axis=1) + DECAY * ahead
        new, new_bias = ahead - rate * step, ahead_bias - rate * off.sum(axis=0)
        grown = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        ahead, ahead_bias = new + (momentum - 1) / grown * (new - weights), new_bias + (momentum - 1) / grown * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain") -> Classifier:
    """A classifier of ``domains`` from ``labels(id, domain)``."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(domain_col).alias("domain")).where(F.col("domain").isin(domains) & F.col("id").isNotNull())
    sizes = {r["domain"]: r["n"] for r in marked.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    number = {d: k for k, d in enumerate(domains)}
    empty = Classifier(domains, {}, np.zeros((0, len(domains))), np.zeros(len(domains)))
    if not sizes:
        return empty
    rate = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, min(1.0, SAMPLE_DOCS / n))])
    drawn = marked.where(unit_hash("id", seed=11) < F.element_at(rate, F.col("domain")))

    def words(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            yield pd.DataFrame({"domain": frame["domain"], "words": [sorted(features_of(t)) for t in frame["text"]]})

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id")  # the sample's ids are few
    sample = materialize(texts.mapInPandas(words, "domain string, words array<string>"), "sample")
    found = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not found:
        return empty
    # Mutual information of a word's presence and the domain.
    total = float(sum(found.values()))
    n_of = [F.sum((F.col("domain") == d).cast("double")).alias(f"n{k}") for k, d in enumerate(domains)]
    counts = sample.select("domain", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), *n_of).where(F.col("n") >= LEAST_DOCS)
    told = F.lit(0.0)
    for k, d in enumerate(domains):
        if found.get(d):
            share = found[d] / total
            for part, whole in ((F.col(f"n{k}"), F.col("n")), (F.lit(float(found[d])) - F.col(f"n{k}"), F.lit(total) - F.col("n"))):
                told = told + F.when(part > 0, part / total * F.log(part / (whole * share))).otherwise(0.0)
    best = counts.select("word", told.alias("told")).where(F.col("told") > LEAST_G / (2 * total)).orderBy(F.desc("told"), "word").limit(FEATURES).collect()
    index = {r["word"]: k for k, r in enumerate(best)}
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def numbers(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = shared.value.get
        for frame in it:
            yield pd.DataFrame({"domain": frame["domain"], "rows": [sorted(k for k in map(get, w) if k is not None) for w in frame["words"]]})

    rows = sample.mapInPandas(numbers, "domain string, rows array<int>").collect()  # a bounded sample
    rows = sorted((number[r["domain"]], r["rows"]) for r in rows)
    weights, bias = softmax_regression([np.array(r, dtype=np.int64) for _, r in rows], np.array([d for d, _ in rows]), len(index), len(domains))
    prior = np.log(np.array([found.get(d, 0) * sizes.get(d, 0) / max(found.get(d, 0), 1) for d in domains]) + 0.5)
    return Classifier(domains, index, weights, bias + prior - prior.mean())


def classified(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> Column:
    """A struct of the text's ``tokens`` (words) and its ``posterior`` over the domains."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(texts: pd.Series) -> pd.DataFrame:
        posterior = shared.value.posterior
        return pd.DataFrame({"tokens": [len((t or "").split()) for t in texts], "posterior": [posterior(features_of(t)) for t in texts]})
    return F.pandas_udf(run, "tokens long, posterior array<double>")(F.col(text_col))


def rates(soft: DataFrame, weights: list[float], budget: float | None = None, max_rate: float | None = 1.0, posterior: str = "posterior", tokens: str = "tokens", keep: int | None = None) -> tuple[Column, list[float], list[float]]:
    """(rate as an expression of the posterior, expected tokens by domain, targets).

    ``budget``: tokens to take in all. Without one, as many as the domains
    can give at these weights without any document being taken more than once.
    ``keep``: number of a domain all of whose tokens are the target, if there is no
    budget. The weights of the others, against its own, are then upper shares: of a domain
    that has less the target is what is there, so that no lack of it costs the kept one."""
    p = [F.element_at(posterior, k + 1) for k in range(len(weights))]

    def expected(rate: Column) -> list[float]:
        return [x or 0.0 for x in soft.agg(*[F.sum(F.col(tokens) * rate * x).alias(f"a{k}") for k, x in enumerate(p)]).first()]

    there = expected(F.lit(1.0))
    weights = [w / sum(weights) for w in weights]
    if budget is None and keep is not None:
        if weights[keep] <= 0:
            raise ValueError("the domain to keep needs a weight")
        budget = there[keep] / weights[keep]
        targets = [min(m, budget * w) if k != keep else m for k, (m, w) in enumerate(zip(there, weights))]
    else:
        if budget is None:
            budget = min((m / w for m, w in zip(there, weights) if w > 0), default=0.0)
        targets = [budget * w for w in weights]
    rate, now, history, before = F.lit(1.0), there, [], np.inf
    for _ in range(ROUNDS):
        # In steps of a token count for each domain: no step then overshoots, as posteriors sum to 1.
        miss = [(a - t) / m if m > 0 else 0.0 for a, t, m in zip(now, targets, there)]
        squares = sum((a - t) * e for a, t, e in zip(now, targets, miss))
        if all(abs(a - t) <= TOLERANCE * max(t, 1e-3 * budget) for a, t in zip(now, targets)) or squares > STALLED * before:
            break
        before = squares
        history.append(F.array(*[F.lit(float(e)) for e in miss]))

        def moved(rate: Column, miss: Column) -> Column:
            step = sum((x * F.element_at(miss, k + 1) for k, x in enumerate(p)), F.lit(0.0))
            rate = F.greatest(F.lit(0.0), rate - step)
            return rate if max_rate is None else F.least(F.lit(float(max_rate)), rate)
        rate = F.aggregate(F.array(*history), F.lit(1.0), moved)
        now = expected(rate)
    return rate, now, targets


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", budget: float | None = None, max_rate: float | None = 1.0, keep: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``tokens``, ``posterior`` (a map), ``rate``, ``copies``. ``keep``: a domain, as in ``rates``."""
    domains = list(targets)
    classifier = train(docs, labels, domains, id_col, text_col)
    soft = docs.select(F.col(id_col).alias("id"), classified(docs, classifier, text_col).alias("x"))
    soft = materialize(soft.select("id", "x.tokens", "x.posterior"), "posteriors")
    rate, _, _ = rates(soft, list(targets.values()), budget, max_rate, keep=None if keep is None else domains.index(keep))
    found = soft.withColumn("rate", rate)
    posterior = F.map_from_arrays(F.array(*map(F.lit, domains)), F.col("posterior"))
    return found.select(F.col("id").alias(id_col), "tokens", posterior.alias("posterior"), "rate", copies(F.col("rate"), F.col("id")).alias("copies"))


def copies(rate: Column, id_column: Column) -> Column:
    whole = F.floor(rate)
    return (whole + (unit_hash(id_column, seed=12) < rate - whole).cast("long")).cast("long")


def labelled_domains(labels: DataFrame) -> DataFrame:
    """``labels(doc_id, quality, toxic)`` as domains: toxic, else low or clean by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))
