"""Collocations: frequent phrases, counted in depth-truncated suffix trees that are built apart from each other.

1. Words are counted by language: partial counts per task, one sum per word.
2. Vertical partitioning. Word prefixes of suffixes that occur more than ``BUDGET`` times are *open*: their extensions by one more word are counted (one scan for a
   length, partial counts per task), until no prefix is open or ``MAX_WORDS`` is reached. All others are closed, and are packed into groups
   of at most ``BUDGET`` suffixes (best fit on the loads of 65,536 hash buckets of prefixes, all that the driver sees of them).
3. One more scan emits each suffix, cut at the end of its piece, before a word too rare to be in any result, and at ``MAX_WORDS``. Equal ones of a
   batch become one row with their number, so that a suffix that a third of all rows share stays small; they leave as a compressed block for each group.
4. Each group builds its tree by itself: its suffixes sorted by word are the leaves, and a node's count is the total of the leaves below it.
   Nodes above a group's prefix are shared among groups, whose partial counts are added up.
5. Scores of the cuts come from joins of the phrases with each other; all arithmetic is exact.

Which words are rare and which prefixes are open is told to tasks by bit sets of a fixed size (``BITS`` bits). A wrong yes by equal hashes lets a rare word into the trees, where
its count drops it, or opens a prefix without need; neither changes a result.

Null languages are ``und``, null texts empty. Repeated rows count each time; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seclake.llm.common import batches
from seclake.session import materialize

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: Suffixes of a group; a group's task needs about 150 bytes for each.
BUDGET = 2_000_000
BITS = 1 << 23
BUCKETS = 1 << 16
#: Distinct words that a task counts before it hands its partial counts on.
HELD_WORDS = 200_000
#: Words that a task turns into suffixes at once.
BLOCK_WORDS = 1_000_000
BREAK = 10
#: Bytes as the splitting sees them: A-Z in lower case, marks that end a piece as line feeds, tabs as spaces.
BYTES = bytes(c + 32 if 65 <= c <= 90 else BREAK if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
UNDETERMINED = "und"
COUNTS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
PREFIXES = pa.schema([("prefix", pa.int64()), ("n", pa.int64())])
BLOCKS = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("block", pa.binary())])


def texts_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def words_in(texts: list[bytes]) -> list[bytes]:
    """The words of the texts in order; pieces end at line feeds, which stand as words. Empty strings mean nothing."""
    return b"\n".join(texts).translate(BYTES).replace(b"\n", b" \n ").split(b" ")


def by_language(it: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a task in lists of one language, of about so many bytes."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in it:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            sizes[lang] += len(text) + 64
            if sizes[lang] >= most_bytes or sizes.total() >= 2 * most_bytes:
                lang = max(sizes, key=sizes.get)
                yield lang, held.pop(lang)
                del sizes[lang]
    yield from held.items()


def count_words(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            yield from batches(((lang, w, n) for lang, c in held.items() for w, n in c.items() if w and w != b"\n"), COUNTS)
            held.clear()

        for lang, some in by_language(it, 4 << 20):
            held.setdefault(lang, Counter()).update(words_in(some))
            if sum(map(len, held.values())) >= HELD_WORDS:
                yield from flush()
        yield from flush()
    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


# Hashes of prefixes: of the first word XXH64 (as Spark's xxhash64 of language and word), of each further one mixed in.

def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=xxhash.xxh64_intdigest(lang.encode(), seed=42))


def mixed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of prefixes with one more word."""
    x = (prefix ^ (prefix >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(31))


def bit_set(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """A byte of eight bits for each eight numbers below ``bits``; set are those of ``hashes(prefix)``. Packed in pieces, so that the driver gets ``bits`` / 8 bytes at most."""
    piece = min(bits, 1 << 16)

    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(piece, dtype=bool)
        on[frame["place"].to_numpy() % piece] = True
        return pd.DataFrame({"piece": [key[0]], "packed": [np.packbits(on, bitorder="little").tobytes()]})

    places = hashes.select(F.col("prefix").bitwiseAND(bits - 1).alias("place")).distinct()
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in places.withColumn("piece", (F.col("place") / piece).cast("long")).groupBy("piece").applyInPandas(pack, "piece long, packed binary").collect():
        out[r["piece"] * piece // 8:(r["piece"] + 1) * piece // 8] = np.frombuffer(r["packed"], dtype=np.uint8)
    return out


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


class Suffixes:
    """Turns the words of one language into the distinct suffixes with their numbers. ``vocabulary[id - 1]`` is a word; id 0 ends a suffix."""

    def __init__(self, lang: str, frequent: np.ndarray):
        self.lang, self.frequent = lang, frequent
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {b"": -1, b"\n": 0}
        self.vocabulary: list[bytes] = []
        self.hashes = np.zeros(1, dtype=np.uint64)

    def learn(self, words: set[bytes]) -> None:
        new = sorted(words)
        hashes = np.array([word_hash(self.lang, w) for w in new], dtype=np.uint64)
        good = holds(self.frequent, hashes)
        for w, g in zip(new, good.tolist()):
            if g:
                self.vocabulary.append(w)
            self.ids[w] = len(self.vocabulary) if g else 0
        self.hashes = np.concatenate([self.hashes, hashes[good]])

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``MAX_WORDS`` ids, their numbers) of the suffixes of two or more words, equal ones once in a block."""
        words = words_in(texts)
        start = 0
        while start < len(words):
            end = min(len(words), start + BLOCK_WORDS)
            while end < len(words) and words[end] != b"\n":  # blocks end between pieces
                end += 1
            block = words[start:end]
            start = end
            if len(self.ids) > 2 * HELD_WORDS:
                self.clear()
            if new := set(block) - self.ids.keys():
                self.learn(new)
            ids = np.array(list(map(self.ids.__getitem__, block)), dtype=np.int32)
            ids = np.concatenate([ids[ids >= 0], np.zeros(MAX_WORDS, dtype=np.int32)])
            first = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            rows = np.empty((len(first), MAX_WORDS), dtype=np.int32)
            going = np.ones(len(first), dtype=bool)
            for k in range(MAX_WORDS):
                at = ids[first + k]
                going &= at > 0
                rows[:, k] = at * going
            yield distinct_rows(rows)


def distinct_rows(rows: np.ndarray, numbers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and how often each occurs. Rows are brought together by a hash and compared whole; should two rows share a hash, all are sorted."""
    if not len(rows):
        return rows, np.zeros(0, dtype=np.int64)
    h = np.zeros(len(rows), dtype=np.uint64)
    for k in range(rows.shape[1]):
        h = mixed(h, rows[:, k].astype(np.uint64))
    order = np.argsort(h)
    ordered = rows[order]
    new = np.r_[True, np.diff(h[order]) != 0]
    if (ordered[1:] != ordered[:-1])[~new[1:]].any():
        order = np.lexsort(rows.T[::-1])
        ordered = rows[order]
        new = np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)]
    starts = np.flatnonzero(new)
    if numbers is None:
        return ordered[starts], np.diff(np.r_[starts, len(rows)])
    return ordered[starts], np.add.reduceat(numbers[order], starts)


def closing(rows: np.ndarray, hashes: np.ndarray, opened: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the hash of its closed prefix and the prefix's length; a suffix that ends while its prefix is open has length ``MAX_WORDS`` + 1."""
    h = hashes[rows[:, 0]]
    depth = np.ones(len(rows), dtype=np.int8)
    going = np.ones(len(rows), dtype=bool)
    for k, bits in enumerate(opened, 1):
        going &= holds(bits, h) & (depth == k)
        ends = going & (rows[:, k] == 0) if k < MAX_WORDS else going
        depth[ends] = MAX_WORDS + 1
        going &= ~ends
        if not going.any():
            break
        h[going] = mixed(h[going], hashes[rows[going, k]])
        depth[going] = k + 1
    return h, depth


def pack_block(vocabulary: list[bytes], rows: np.ndarray, numbers: np.ndarray, depth: np.ndarray) -> bytes:
    used, local = np.unique(rows, return_inverse=True)
    words = b" ".join(vocabulary[k - 1] for k in used.tolist() if k)
    local = local.reshape(rows.shape) + (used[0] != 0)
    kind = np.uint16 if len(used) < 65_000 else np.uint32
    body = words + b"".join(np.ascontiguousarray(local[:, k].astype(kind)).tobytes() for k in range(MAX_WORDS)) + numbers.astype(np.uint32).tobytes() + depth.astype(np.uint8).tobytes()
    return struct.pack("<IIB", len(words), len(rows), np.dtype(kind).itemsize) + zstandard.compress(body, 1)


def unpack_block(block: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words (ids from 1), rows, numbers, lengths of the closed prefixes."""
    size, n, width = struct.unpack_from("<IIB", block)
    body = zstandard.decompress(block[9:])
    at = size
    rows = np.frombuffer(body, dtype=f"<u{width}", count=n * MAX_WORDS, offset=at).reshape(MAX_WORDS, n).T.astype(np.int32)
    at += n * MAX_WORDS * width
    return body[:size].split(b" "), rows, np.frombuffer(body, dtype="<u4", count=n, offset=at).astype(np.int64), np.frombuffer(body, dtype=np.uint8, count=n, offset=at + 4 * n)


def tree_counts(rows: np.ndarray, numbers: np.ndarray, depth: np.ndarray, min_count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each depth from two on (the first words' ids, count) of the suffix tree's nodes that are frequent, or shared with other groups."""
    order = np.lexsort(rows.T[::-1])
    rows, numbers, depth = rows[order], numbers[order], depth[order]
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for d in range(1, MAX_WORDS + 1):
        new[1:] |= rows[1:, d - 1] != rows[:-1, d - 1]
        if d < 2:
            continue
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(numbers, starts)
        good = (rows[starts, d - 1] > 0) & ((totals >= min_count) | (depth[starts] > d))
        yield rows[starts[good], :d], totals[good]


def best_fit(loads: dict[int, int], room: int) -> np.ndarray:
    """The group of each bucket: from the largest load down, each into the fullest group with room for it; a load beyond the room has a group of its own."""
    group, free = np.zeros(BUCKETS, dtype=np.int32), []
    groups = 0
    for bucket, load in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        k = bisect_left(free, (load, -1))
        if k < len(free):
            left, number = free.pop(k)
        else:
            left, number, groups = max(room, load), groups, groups + 1
        group[bucket] = number
        if left > load:
            insort(free, (left - load, number))
    return group


def phrase_counts(texts: DataFrame, words: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET, bits: int = BITS) -> DataFrame:
    """``lang, phrase, f`` for the phrases of two to ``MAX_WORDS`` words that occur ``min_count`` times or more."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    first = words.where(F.col("n") >= min_count).select(F.xxhash64("lang", "word").alias("prefix"), "n")
    frequent = sc.broadcast(bit_set(first, bits))

    def loads(prefixes: DataFrame) -> DataFrame:
        return prefixes.select(F.shiftrightunsigned("prefix", 48).alias("bucket"), "n").groupBy("bucket").agg(F.sum("n").alias("n"))

    histogram: Counter = Counter()
    opened: list = []
    prefixes = first
    for length in range(1, MAX_WORDS + 1):
        hot = prefixes.where(F.col("n") > budget)
        closed = prefixes if length == MAX_WORDS else prefixes.where(F.col("n") <= budget)
        for r in loads(closed).collect():  # at most BUCKETS
            histogram[r["bucket"]] += r["n"]
        if length == MAX_WORDS or not hot.limit(1).count():
            break
        opened.append(sc.broadcast(bit_set(hot, bits)))
        prefixes = materialize(extended(texts, frequent, list(opened), budget), "prefixes")
    groups = sc.broadcast(best_fit(histogram, budget))

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Suffixes] = {}

        def rows():
            for lang, some in by_language(it, 8 << 20):
                makers = known.setdefault(lang, Suffixes(lang, frequent.value))
                for suffixes, numbers in makers.of(some):
                    if not len(suffixes):
                        continue
                    h, depth = closing(suffixes, makers.hashes, [o.value for o in opened])
                    part = groups.value[bucket_of(h)]
                    order = np.argsort(part, kind="stable")
                    cuts = np.flatnonzero(np.diff(part[order])) + 1
                    for own in np.split(order, cuts):
                        yield lang, int(part[own[0]]), pack_block(makers.vocabulary, suffixes[own], numbers[own], depth[own])
                if len(known) > 8:
                    known.clear()
        yield from batches(rows(), BLOCKS, 64)

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        ids: dict[bytes, int] = {}
        parts = []
        for block in frame["block"]:
            names, rows, numbers, depth = unpack_block(block)
            place = np.array([0, *[ids.setdefault(w, len(ids) + 1) for w in names]], dtype=np.int32)
            parts.append((place[rows], numbers, depth))
        names = [b"", *ids]
        rows, numbers, depth = (np.concatenate(x) for x in zip(*parts))
        del parts
        out, counts = [], []
        for nodes, totals in tree_counts(rows, numbers, depth, min_count):
            out += [b" ".join([names[k] for k in node]).decode() for node in nodes.tolist()]
            counts.append(totals)
        return pd.DataFrame({"lang": key[0], "phrase": pd.Series(out, dtype=object), "f": np.concatenate(counts)})

    blocks = texts.mapInArrow(emit, "lang string, part int, block binary")
    nodes = blocks.groupBy("lang", "part").applyInPandas(build, "lang string, phrase string, f long")
    return nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def extended(texts: DataFrame, frequent, opened: list, budget: int) -> DataFrame:
    """``prefix, n`` of the prefixes one word longer than the open ones, by one scan."""
    length = len(opened) + 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Suffixes] = {}
        for lang, some in by_language(it, 8 << 20):
            makers = known.setdefault(lang, Suffixes(lang, frequent.value))
            for suffixes, numbers in makers.of(some):
                h, depth = closing(suffixes, makers.hashes, [o.value for o in opened])
                here = depth == length
                prefixes, place = np.unique(h[here], return_inverse=True)
                sums = np.bincount(place, weights=numbers[here]).astype(np.int64) if len(prefixes) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(prefixes.view(np.int64)), pa.array(sums)], schema=PREFIXES)
            if len(known) > 8:
                known.clear()
    return texts.mapInArrow(run, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))


def exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def scored(phrases: DataFrame, words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of each phrase by its lowest-scoring cut."""
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    counts = phrases.select("lang", F.col("phrase").alias("part"), "f").unionAll(words.where(F.col("n") >= min_count).select("lang", F.col("word").alias("part"), F.col("n").alias("f")))
    ws = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), ws.alias("ws")).select("lang", "phrase", "a", "ws", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k")), " ").alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").cast("long")
    low = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    return low.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def whole(phrases: DataFrame) -> DataFrame:
    """The phrases of which not all occurrences lie inside one longer phrase. One word more is enough to look at: what
    lies inside a longer phrase as often also lies inside the phrases between both, which are as frequent."""
    ws = F.split("phrase", " ")
    inner = F.array(F.array_join(F.slice(ws, F.lit(1), F.size(ws) - 1), " "), F.array_join(F.slice(ws, F.lit(2), F.size(ws) - 1), " "))
    around = phrases.where(F.size(ws) > 2).select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    return phrases.join(around, ["lang", "phrase"], "left").where("around is null or around < f").select("lang", "phrase", "f")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first rows with their rank; a salted cut first, so that no task sees all rows of a language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, budget: int = BUDGET, bits: int = BITS) -> DataFrame:
    """The collocations of each language, best first."""
    texts = texts_of(docs, text_col, lang_col)
    words = materialize(count_words(texts), "words")
    phrases = materialize(phrase_counts(texts, words, min_count, budget, bits), "phrases")
    found = scored(phrases, words, min_count).join(whole(phrases).select("lang", "phrase"), ["lang", "phrase"], "left_semi")
    return best(found, top)
