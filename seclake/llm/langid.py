"""Language identification by words first, then by ever shorter character n-grams.

The model holds, for each known word and n-gram, its log frequency in every
language. A text's words are scored one by one: a known word by its own row; an
unseen one by its longest n-grams (of the word between two marks) that are
known, falling back to one character less while none is. A word's score is
the mean over the n-grams found; the text's is the mean over its words, and the
language with the largest one wins (ties: the smaller name).

The model is fitted on a bounded sample of the labelled rows: about
``SAMPLE_DOCS`` documents of each language, drawn by a hash of id and text. It keeps
all words and n-grams of the sample, which bounds its size, and is broadcast; every
other word takes the fallback. Prediction reads whole texts and nothing but the text.

Null texts, texts without a letter and all texts of a model without
languages get ``und`` with score 0; a text none of whose characters is known
scores alike in all languages. Repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import free_name, unit_hash

SAMPLE_DOCS = 1500    # labelled documents of a language that the model is fitted on, about
LENGTHS = (5, 4, 3, 2, 1)
#: What a language without the word or n-gram gets less than the rarest that it has (natural logarithm).
PENALTY = 2.0
MEMO_WORDS = 50_000
LONG_WORD = 60        # longer "words" aren't remembered
UNDETERMINED = "und"
SLICE = 500           # rows that a task holds as Python texts
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Runs of letters in lower case, with their number."""
    counts = Counter(WORD.findall((text or "").lower()))
    for w in [w for w in counts if not w.isalpha()]:  # numerals that aren't digits
        n = counts.pop(w)
        for part in "".join(c if c.isalpha() else " " for c in w).split():
            counts[part] += n
    return counts


def grams_of(word: str, n: int) -> list[str]:
    marked = f"\x02{word}\x03"
    return [g for g in (marked[i:i + n] for i in range(len(marked) - n + 1)) if g not in ("\x02", "\x03")]


class Model:
    def __init__(self, languages: list[str], tables: list[tuple[dict[str, int], np.ndarray]]):
        """``tables``: of the words, then of the n-grams of each of LENGTHS: row numbers and log frequencies by language."""
        self.languages, self.tables, self.memo = languages, tables, {}

    def __getstate__(self):
        # Each table's words as one string: that takes a fraction of the memory that pickled words take on the way.
        return self.languages, [("\n".join(rows), logs) for rows, logs in self.tables]

    def __setstate__(self, state):
        languages, tables = state
        self.__init__(languages, [({w: k for k, w in enumerate(words.split("\n"))} if len(logs) else {}, logs) for words, logs in tables])

    def unseen(self, word: str) -> np.ndarray:
        found = self.memo.get(word)
        if found is None:
            found = np.zeros(len(self.languages))
            for n, (rows, logs) in zip(LENGTHS, self.tables[1:]):
                known = [k for g in grams_of(word, n) if (k := rows.get(g)) is not None]
                if known:
                    found = logs[known].mean(axis=0)
                    break
            if len(word) <= LONG_WORD:
                if len(self.memo) >= MEMO_WORDS:
                    self.memo.clear()
                self.memo[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = words_of(text)
        if not counts or not self.languages:
            return UNDETERMINED, 0.0
        rows, logs = self.tables[0]
        known, times, total = [], [], np.zeros(len(self.languages))
        for word, n in counts.items():
            k = rows.get(word)
            if k is None:
                total += n * self.unseen(word)
            else:
                known.append(k)
                times.append(n)
        if known:
            total += np.array(times, dtype=np.float64) @ logs[known]
        total /= sum(counts.values())
        best = int(np.argmax(total))
        odds = np.exp(total - total[best])
        return self.languages[best], float(1.0 / odds.sum())


def fit(counts: list[tuple[str, Counter]]) -> Model:
    """The model of (language, word counts) pairs."""
    words: dict[str, Counter] = defaultdict(Counter)
    for language, c in counts:
        words[language].update(c)
    languages = sorted(x for x in words if words[x])
    tables = []
    for n in (0, *LENGTHS):
        kept, totals = [], []
        for language in languages:
            seen = words[language]
            if n:
                seen = Counter()
                for word, times in words[language].items():
                    for g in grams_of(word, n):
                        seen[g] += times
            totals.append(sum(seen.values()))
            kept.append(seen)
        rows = {w: k for k, w in enumerate(sorted(set().union(*kept)))} if kept else {}
        logs = np.empty((len(rows), len(languages)))
        for k, (seen, total) in enumerate(zip(kept, totals)):
            logs[:, k] = np.log(1.0 / max(total, 1)) - PENALTY
            for w, times in seen.items():
                logs[rows[w], k] = np.log(times / total)
        tables.append((rows, logs))
    return Model(languages, tables)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of the rows with text and language; see above for the sample."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return fit([])
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_docs / n))])
    drawn = rows.where(unit_hash("id", "text", seed=3) < F.element_at(rate, F.col("lang")))

    def count(it):
        for frame in it:
            sums: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(frame["lang"], frame["text"]):
                sums[lang].update(words_of(text))
            out = [(lang, w, n) for lang, c in sums.items() for w, n in c.items()]
            yield pd.DataFrame(out, columns=["lang", "word", "n"])

    counted = drawn.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words: dict[str, Counter] = defaultdict(Counter)
    for batch in counted.toArrow().to_batches():  # the sample's distinct words
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            words[lang][word] = n
    return fit(list(words.items()))


def predict_column(model: Model, text: Column, spark) -> Column:
    """A struct ``lang, score`` for each text."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.DataFrame:
        predict = shared.value.predict
        return pd.DataFrame([predict(t) for t in texts], columns=["lang", "score"])
    return F.pandas_udf(run, "lang string, score double")(text)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (other columns of these names are replaced)."""
    found = free_name(docs, "found")
    return docs.withColumn(found, predict_column(model, F.col(text_col), docs.sparkSession)).withColumns({"lang_pred": F.col(f"{found}.lang"), "score": F.col(f"{found}.score")}).drop(found)


def keep(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that have a language, with ``lang`` filled in where it is null; columns as they were. Without one are texts
    without a letter, and those in which nothing tells the model's languages apart. Each text is scored once, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, text_at = docs.columns.index(lang_col), docs.columns.index(text_col)

    def run(it):
        predict, languages = shared.value.predict, len(shared.value.languages)
        for batch in (b.slice(k, SLICE) for b in it for k in range(0, b.num_rows, SLICE)):
            found = [predict(t) for t in batch.column(text_at).to_pylist()]
            good = [lang != UNDETERMINED and not (languages > 1 and score <= 1.000001 / languages) for lang, score in found]
            old = batch.column(at)
            filled = pa.array([lang if o is None else o for (lang, _), o in zip(found, old.to_pylist())], type=old.type)
            yield pa.RecordBatch.from_arrays([filled if k == at else c for k, c in enumerate(batch.columns)], schema=batch.schema).filter(pa.array(good, type=pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
