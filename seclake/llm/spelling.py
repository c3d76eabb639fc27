"""Spelling variants: words one edit apart, found by PartEnum signatures.

1. Words are counted over all texts, partial counts per task, one sum per word.
2. A word's letter multiset is a binary vector: one place for each letter and
   the how-manieth one of it in the word. One inserted or deleted letter changes one place,
   a replaced one two, so near words have a Hamming distance of two at most.
   The places are dealt to ``PARTS`` parts by a hash; two differences leave ``PARTS`` - 2 parts equal, so
   near words agree in one of the signatures that enumerate all ways to leave two parts out.
3. Anagrams have all signatures in common. One edit also leaves either the first or the second half of the shorter word as it was, so that the length
   of the shorter word and one of its halves are part of each join key. That leaves out no near pair.
4. Words join on equal keys; the join verifies each pair by its edit distance, so only near pairs leave it.
5. A word's form follows from its near words; roots follow by doubling the steps, in about log2 of the longest chain's rounds. Forms grow at
   least twofold in number at each step, so chains are short and have no cycle.

Null texts hold no words; a null id is the empty text in the hash that deletes letters. Repeated rows count each time. An empty table gives no rows.
Words near many others are no hot group: a word has at most a few thousand possible neighbours.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import batches
from seclake.session import materialize

PARTS = 4
MIN_LENGTH = 5
MIN_COUNT = 3
#: A form's number is at least so many times its variant's.
TIMES = 2
#: Distinct words that a task holds before it hands its partial counts on.
HELD_WORDS = 200_000
#: Latin-1 bytes that make words, in lower case where they are A-Z; all other code points part words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
PART_ROWS = pa.schema([("word", pa.string()), ("n", pa.int64()), *[(f"p{k}", pa.int64()) for k in range(PARTS)]])


def runs_of(text: str | None) -> Counter:
    """The maximal runs of letters, A-Z in lower case, as Latin-1 bytes, with their number."""
    return Counter((text or "").encode("latin-1", "replace").translate(LETTERS).split())


def misspelt(run: bytes, prefix: int, every: int) -> bytes:
    """The run, without one letter if ``every`` divides its hash; ``prefix`` is the CRC-32 of the id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush():
            yield from batches(((w.decode("latin-1"), n) for w, n in held.items()), COUNTS)
            held.clear()

        for batch in it:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix = zlib.crc32(f"{doc}:".encode())
                for w, n in runs_of(text).items():
                    w = misspelt(w, prefix, every)
                    if len(w) >= min_length:
                        held[w] = held.get(w, 0) + n
                if len(held) >= HELD_WORDS:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def parts_of(word: str) -> list[int]:
    """A number for the letters of each part, equal for equal sets of places."""
    seen: Counter = Counter()
    parts: list[list[str]] = [[] for _ in range(PARTS)]
    for letter in word:
        seen[letter] += 1
        place = f"{letter}{seen[letter]}"
        parts[zlib.crc32(place.encode()) % PARTS].append(place)
    out = []
    for p in parts:
        name = "".join(sorted(p)).encode()
        out.append(zlib.crc32(name) << 31 ^ zlib.adler32(name))
    return out


def with_parts(words: DataFrame) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield from batches(((w, n, *parts_of(w)) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), PART_ROWS)
    return words.select("word", "n").mapInArrow(run, "word string, n long, " + ", ".join(f"p{k} long" for k in range(PARTS)))


def _keys(parts: DataFrame, shorter: Column) -> DataFrame:
    """``key, word, n`` for each signature and each half; ``shorter``: the length of the pair's shorter word. Equal keys by chance cost time only."""
    first = ((shorter - 1) / 2).cast("int")
    halves = [(0, F.substring("word", F.lit(1), first)), (1, F.substring("word", F.length("word") - (shorter - 1 - first) + 1, shorter - 1 - first))]
    keys = [F.xxhash64(shorter, F.lit(side), half, F.lit(k), *[F.col(f"p{p}") for p in range(PARTS) if p not in left_out])
            for side, half in halves for k, left_out in enumerate(combinations(range(PARTS), 2))]
    return parts.select(F.explode(F.array(*keys)).alias("key"), "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n`` for all pairs of words one edit apart, each once, the shorter word as ``a`` (of equal length: the smaller)."""
    parts = materialize(with_parts(words), "parts")
    size = F.length("word")
    left = _keys(parts, size).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = _keys(parts, size).unionAll(_keys(parts, size - 1)).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    one = (F.length("b") - F.length("a") == 1) | ((F.length("b") == F.length("a")) & (F.col("a") < F.col("b")))
    pairs = left.join(right, [left["key"] == right["key"], one, F.levenshtein(F.col("a"), F.col("b"), 1) == 1])
    return pairs.select("a", "a_n", "b", "b_n").distinct()


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each of ``words(word, n)``."""
    words = materialize(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    # Each pair is written once and read in both directions.
    pairs = materialize(pairs, "near")
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    far = (-F.col("best.less")) >= times * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best.other")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"))
    found = materialize(found, "forms")
    ends = roots(found.where("form is not null").select("word", F.col("form").alias("end")))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("end", "word").alias("root"))


def roots(steps: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``word, end`` with the last word reached from ``steps(word, end)``, which have no cycle; each round doubles the steps."""
    now = materialize(steps, "steps")
    for _ in range(max_rounds):
        on = now.select(F.col("word").alias("via"), F.col("end").alias("further"))
        moved = now.join(on, now["end"] == on["via"], "left").select("word", F.coalesce("further", "end").alias("end"), F.col("further").isNotNull().alias("moved"))
        moved = materialize(moved, "steps")
        now = moved.select("word", "end")
        if not moved.where("moved").limit(1).count():
            return now
    raise RuntimeError(f"forms go on after {max_rounds} rounds; do they have a cycle?")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spelling variants of all words of ``docs``."""
    return variants(count_words(docs, id_col, text_col))
