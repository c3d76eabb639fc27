"""Log-bilinear language model, trained with noise-contrastive estimation.

Tokens are the words (A-Z in lower case, split at ASCII white space) and one
end per text. Three parts make a normalised probability of every token:

* The *head*: the ``HEAD`` most frequent training tokens, the end and one class for
  all other words have vectors. From the vectors of the two tokens before,
  weighed by position, the model predicts a vector; its product with each
  head token's output vector, plus a bias, is that token's score.
* All scores of a context are normalised over the head. A context is two tokens
  of a bounded set, so that batched matrix products give the scores and log
  normalisers of all contexts once; a token then takes four look-ups.
* A word of the class "other" has its smoothed frequency among such words.

Training is noise-contrastive: a token against ``NOISE`` draws from the
unigram distribution, both in numpy mini-batches. Every task trains on its
partition's texts, all of them, from the same start; the parameters are then averaged
by number of tokens (``ROUNDS`` times), so the model sees the whole corpus
and what is gathered grows with it. The counts cover all training texts too.

Counts of the most frequent tokens (at most ``KNOWN``) go to the tasks;
all other words of a text meet their counts in a join on the word.

Null text is empty, an empty text is one end. Without training texts every
token is unknown and both scores follow from the smoothing alone. Repeated
rows are scored each for itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import batches
from seclake.session import materialize

HEAD = 2046           # tokens with vectors, besides the end and the class of the others
KNOWN = 60_000        # tokens whose counts every task holds
WIDTH = 24
NOISE = 32
BATCH = 256
RATE = 0.1
FIRST_SIZE = 1e-7     # AdaGrad's sums of squares at the start
ROUNDS = 1
SMOOTH = 0.1
COUNTED_AT_ONCE = 300_000
LOG10 = float(np.log(10.0))
END, OTHER = 0, 1     # numbers of the end (it also stands before the first word) and of the class


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_tokens(docs: DataFrame, text_col: str) -> DataFrame:
    """``word`` (bytes) and its number ``c`` over all texts; the end isn't among them."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in it:
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) > COUNTED_AT_ONCE:
                    yield from batches(counts.items(), schema)
                    counts.clear()
        yield from batches(counts.items(), schema)

    return docs.select(text_col).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Net:
    """Vectors of the head: ``seen`` before a token, ``made`` as the token; weights of the two places; biases."""

    def __init__(self, seen, made, place, bias):
        self.seen, self.made, self.place, self.bias = seen, made, place, bias

    @classmethod
    def start(cls, n: int, unigram: np.ndarray, seed: int = 4) -> "Net":
        draw = np.random.default_rng(seed)
        return cls(draw.normal(0, 0.1, (n, WIDTH)).astype(np.float32), draw.normal(0, 0.1, (n, WIDTH)).astype(np.float32),
                   np.full((2, WIDTH), 0.5, dtype=np.float32), np.log(unigram).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.seen, self.made, self.place, self.bias)])

    @classmethod
    def of(cls, flat: np.ndarray, n: int) -> "Net":
        cut = np.cumsum([n * WIDTH, n * WIDTH, 2 * WIDTH])
        a, b, c, d = np.split(flat.astype(np.float32), cut)
        return cls(a.reshape(n, WIDTH), b.reshape(n, WIDTH), c.reshape(2, WIDTH), d)

    def sizes(self) -> list[np.ndarray]:
        return [np.full(x.shape, FIRST_SIZE, dtype=np.float32) for x in (self.seen, self.made, self.place, self.bias[:, None])]

    def train(self, before2: np.ndarray, before1: np.ndarray, token: np.ndarray, unigram: np.ndarray, draw: np.random.Generator, size: list[np.ndarray]) -> None:
        """One pass over the examples in mini-batches. ``size``: AdaGrad's sum of squares of each parameter."""
        log_noise, total = np.log(NOISE * unigram).astype(np.float32), np.cumsum(unigram)
        for k in range(0, len(token), BATCH):
            w2, w1, w = before2[k:k + BATCH], before1[k:k + BATCH], token[k:k + BATCH]
            n = len(w)
            fake = np.minimum(np.searchsorted(total, draw.random(NOISE)), len(unigram) - 1)  # shared by the batch
            seen1, seen2, made, noise = self.seen[w1], self.seen[w2], self.made[w], self.made[fake]
            predicted = seen1 * self.place[0] + seen2 * self.place[1]
            off_true = 1 - _logistic(np.einsum("ij,ij->i", predicted, made) + self.bias[w] - log_noise[w])
            off_fake = -_logistic(predicted @ noise.T + self.bias[fake] - log_noise[fake])
            back = off_true[:, None] * made + off_fake @ noise
            self._step(0, np.concatenate([w1, w2]), np.concatenate([back * self.place[0], back * self.place[1]]), n, size)
            self._step(1, np.concatenate([w, fake]), np.concatenate([off_true[:, None] * predicted, off_fake.T @ predicted]), n, size)
            self._step(3, np.concatenate([w, fake]), np.concatenate([off_true, off_fake.sum(axis=0)])[:, None], n, size)
            place = np.stack([(back * seen1).sum(axis=0), (back * seen2).sum(axis=0)]) / n
            size[2] += place ** 2
            self.place += RATE * place / np.sqrt(size[2])

    def _step(self, which: int, rows: np.ndarray, change: np.ndarray, n: int, size: list[np.ndarray]) -> None:
        """Moves the rows of a table along the batch's mean gradient; a row may stand there several times."""
        table = (self.seen, self.made, self.place, self.bias[:, None])[which]
        order = np.argsort(rows, kind="stable")
        at = rows[order]
        first = np.nonzero(np.r_[True, at[1:] != at[:-1]])[0]
        at, change = at[first], np.add.reduceat(change[order], first, axis=0) / n
        size[which][at] += change ** 2
        table[at] += RATE * change / np.sqrt(size[which][at])

    def look_ups(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of (token before, token) and (token two before, token) pairs, without bias."""
        return (self.seen * self.place[0]) @ self.made.T, (self.seen * self.place[1]) @ self.made.T


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _numbers(text: str | None, head: dict[bytes, int]) -> np.ndarray:
    get = head.get
    return np.array([*[get(w, OTHER) for w in words_of(text)], END], dtype=np.int64)


def _trained(docs: DataFrame, text_col: str, head: dict[bytes, int], unigram: np.ndarray) -> Net:
    """The parameters after ``ROUNDS`` rounds of training on every partition and averaging."""
    spark, n = docs.sparkSession, len(unigram)
    net = Net.start(n, unigram)
    for number in range(ROUNDS):
        start = spark.sparkContext.broadcast((head, unigram, net.flat()))

        def run(it: Iterator[pa.RecordBatch], number: int = number, start=start) -> Iterator[pa.RecordBatch]:
            head, unigram, flat = start.value
            net, draw, seen = Net.of(flat, len(unigram)), np.random.default_rng(number), 0
            size = net.sizes()
            for batch in it:
                for k in range(0, batch.num_rows, 200):
                    parts = [_numbers(t.as_py(), head) for t in batch.column(0).slice(k, 200)]
                    lengths = np.array([len(p) for p in parts])
                    token = np.concatenate(parts)
                    before1, before2 = _before(token, lengths)
                    net.train(before2, before1, token, unigram, draw, size)
                    seen += len(token)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([net.flat().tobytes()], type=pa.binary())], names=["n", "net"])

        def add(frame: pd.DataFrame) -> pd.DataFrame:
            weighed = sum(np.frombuffer(x, dtype=np.float32).astype(np.float64) * (k / frame["n"].sum()) for k, x in zip(frame["n"], frame["net"]))
            return pd.DataFrame({"n": [int(frame["n"].sum())], "net": [weighed.astype(np.float32).tobytes()]})

        made = materialize(docs.select(text_col).mapInArrow(run, "n long, net binary"), "nets")
        groups = max(1, round(made.count() ** 0.5))  # two levels of averaging, neither of them wide
        rows = made.groupBy((F.monotonically_increasing_id() % groups).alias("g")).applyInPandas(add, "n long, net binary").collect()
        if rows:
            net = Net.of(np.frombuffer(add(pd.DataFrame([tuple(r) for r in rows], columns=["n", "net"]))["net"][0], dtype=np.float32), n)
    return net


def _before(token: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens one and two places before each, the end where the text begins."""
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    before1 = np.r_[END, token[:-1]]
    before1[first] = END
    before2 = np.r_[END, before1[:-1]]
    before2[first] = END
    return before1, before2


def normalisers(one: np.ndarray, two: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """log of the sum over all tokens of exp(one + two + bias), by (token before, token two before).
    The sum is a product of matrices; their largest entries are taken out first."""
    top1, top2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
    right, out = np.exp((two - top2).astype(np.float64)).T, np.empty((len(one), len(two)), dtype=np.float32)
    for k in range(0, len(one), 256):
        left = np.exp((one[k:k + 256] - top1[k:k + 256] + bias).astype(np.float64))
        out[k:k + 256] = np.log(left @ right) + top1[k:k + 256] + top2[:, 0]
    return out


class Model:
    """What the tasks need: counts of the known tokens, numbers of the head, and the tables of log-probabilities."""

    def __init__(self, counts: dict[bytes, int], ends: int, total: int, distinct: int, head: dict[bytes, int], tables: tuple):
        self.counts, self.ends, self.total, self.distinct, self.head, self.tables = counts, ends, total, distinct, head, tables
        self.log_all = float(np.log10(total + SMOOTH * (distinct + 1)))
        in_head = sum(counts[w] for w in head)
        self.log_other = float(np.log10(max(total - ends - in_head, 0) + SMOOTH * (max(distinct - (ends > 0) - len(head), 0) + 1)))


def most_frequent(counts: DataFrame) -> dict[bytes, int]:
    """The most frequent words, most frequent first: as many whole classes of
    frequency (a sixteenth of a natural logarithm wide) as fit ``KNOWN``. A
    few hundred numbers decide which; then only those words come to the
    driver, where a sort with a limit would send it that many from each task."""
    frequency = F.floor(16 * F.log("c"))
    total, least = 0, None
    for r in counts.groupBy(frequency.alias("f")).agg(F.count("*").alias("n")).orderBy(F.desc("f")).collect():
        total += r["n"]
        if total > KNOWN:
            break
        least = r["f"]
    if least is None:
        return {}
    rows = counts.where(frequency >= least).collect()
    return {w: c for w, c in sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))}


def train(docs: DataFrame, text_col: str = "text") -> tuple[Model, DataFrame]:
    """A model of all texts of ``docs`` and the counts of all their words."""
    counts = materialize(count_tokens(docs, text_col), "counts")
    ends = docs.count()
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    known = most_frequent(counts)
    head = {w: k for k, w in enumerate(list(known)[:HEAD], 2)}
    unigram = np.array([ends, 0, *[known[w] for w in head]], dtype=np.float64)
    unigram[OTHER] = words - unigram[2:].sum()
    unigram = (unigram + SMOOTH) / (unigram + SMOOTH).sum()
    net = _trained(docs, text_col, head, unigram)
    one, two = net.look_ups()
    tables = one, two, net.bias, normalisers(one, two, net.bias)
    return Model(known, ends, words + ends, distinct + (ends > 0), head, tables), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens, n_known, train_tokens, base_score, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("own", pa.float64()), ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        one, two, bias, normaliser = model.tables
        # By known word: its number in the head, its log-probability by count, that of the word if it is one of the others.
        place = {w: k for k, w in enumerate(model.counts)}
        head = np.array([model.head.get(w, OTHER) for w in model.counts] + [OTHER], dtype=np.int64)
        logs = np.log10(np.array([*model.counts.values(), 1.0]) + SMOOTH)
        base, inner = logs - model.log_all, np.where(head == OTHER, logs - model.log_other, 0.0)
        base[-1] = inner[-1] = 0.0  # of the words that the join looks up
        end = float(np.log10(model.ends + SMOOTH)) - model.log_all
        unknown, get = len(place), place.get

        def rows():
            for batch in it:
                for row, doc, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    words = words_of(text)
                    at = np.array([get(w, unknown) for w in words], dtype=np.int64)
                    token = np.append(head[at], END)
                    before1, before2 = _before(token, np.array([len(token)]))
                    logp = one[before1, token] + two[before2, token] + bias[token] - normaliser[before1, before2]
                    rare = Counter(w for w, k in zip(words, at.tolist()) if k == unknown)
                    yield (row, doc, len(token), len(words) - sum(rare.values()) + (model.ends > 0), float(base[at].sum()) + end,
                           float(logp.sum(dtype=np.float64)) / LOG10 + float(inner[at].sum()), list(rare), list(rare.values()))
        yield from batches(rows(), schema, 2000)

    ddl = "row long, id long, n_tokens long, n_known long, base double, own double, rare array<binary>, times array<long>"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, ddl)
    rows = materialize(rows, "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    log = F.log10(c + SMOOTH)
    found = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"), F.sum((log - model.log_all) * F.col("times")).alias("base_more"), F.sum((log - model.log_other) * F.col("times")).alias("own_more"))
    none = F.lit(0.0)
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", none)).alias("base_score"), (F.col("own") + F.coalesce("own_more", none)).alias("score"))
