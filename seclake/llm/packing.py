"""Best-fit packing planned on the histogram of lengths.

1. Every text becomes token ids plus the end id, cut into pieces of at most
   ``room`` tokens; only the first piece of a cut document may be shorter.
2. The number of pieces of each length (at most ``room`` numbers, whatever the
   input) is all that the planner sees. From the longest length down, it
   puts all pieces of a length at once into the fullest open kind of sequence
   that they fit; a *kind* is a content (lengths with multiplicities) with the
   number of sequences that have it.
3. The plan gives each length a list of slots. Pieces are ranked within their
   length (by salted partial counts, so no length is ranked in one task) and
   join the slot with their rank.

Null text is empty: its only piece is the end id. Repeated rows are documents
of their own, each with its own pieces. Empty input gives no rows.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seclake.llm.common import batches, unit_hash
from seclake.session import materialize, partitions_for

ROOM = 2048
END = 0
MEMO_WORDS = 500_000
MEMO_BYTES = 64 << 20
#: Characters that a task turns into ids at once, about.
BLOCK_CHARS = 3_000_000
NUL = "\0"
#: A line break between two words, as three parts.
LINE = f" {NUL}\n {NUL}"
SPLIT = re.compile(r"(?<=\S) (?=\S)")
PIECES = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])


#: The letters that stand for a space and a line break in a byte-level vocabulary.
SPACE, BREAK = chr(256 + 32), chr(256 + 10)


class Encoder:
    """Token ids of texts. No merge of the byte-level tokenizer crosses a space
    between two words (it begins the next token) or a single line break between
    words. So the ids of such parts are put together, and the tokenizer sees each new part once.
    Texts that hold the string of a special token go to the tokenizer whole.

    A part's key is its word if a space stands before it, else NUL and the part."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        # Whether a token begins with a space, and whether it is a line break (in the letters that stand for bytes).
        self.spaced, self.broken = (np.zeros(max(words.values(), default=0) + 1, dtype=bool) for _ in range(2))
        self.spaced[[k for w, k in words.items() if w.startswith(SPACE)]] = True
        self.broken[[k for w, k in words.items() if w == BREAK]] = True
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        """Forgets all parts. A part's number is its place in ``known``; its ids are the ``sizes`` ones of ``pool`` from ``starts``."""
        self.known = pa.array([], type=pa.large_string())
        self.pool, self.starts, self.sizes = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> int:
        """Appends parts; returns the number of the first one."""
        first = len(self.known)
        self.known = pa.concat_arrays([self.known, pa.array(keys, type=pa.large_string())])
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, ids])
        return first

    def numbers(self, keys: pa.Array) -> np.ndarray:
        """The parts' numbers; -1 for unknown ones."""
        return pc.fill_null(pc.index_in(keys, value_set=self.known), -1).to_numpy()

    def ids(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered parts in a row, and where each part ends (from 0 on)."""
        sizes = self.sizes[part]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.pool[np.arange(ends[-1]) + np.repeat(self.starts[part] - ends[:-1], sizes)], ends

    @staticmethod
    def plain(text: str) -> bool:
        """Whether all its whitespace is single spaces and line breaks between words."""
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or NUL in text or text[:1].isspace() or text[-1:].isspace():
            return False
        rest = text.replace(" ", "").replace("\n", "")
        return not rest or rest.split(None, 1) == [rest]

    def learn(self, keys: list[str]) -> np.ndarray:
        """Adds new parts; returns their numbers. Parts without whitespace are encoded many at once, put together by the
        space or line break before them; the first token of each shows where it begins."""
        number = np.zeros(len(keys), dtype=np.int64)
        groups: dict[str | None, list[int]] = {" ": [], "\n": [], None: []}
        for k, key in enumerate(keys):
            word = key[1:] if key[:1] == NUL else key
            groups[None if word.split() != [word] else " " if word is key else "\n"].append(k)
        for mark, starts in ((" ", self.spaced), ("\n", self.broken)):
            for at in range(0, len(groups[mark]), 10_000):
                some = groups[mark][at:at + 10_000]
                words = [keys[k] for k in some] if mark == " " else [keys[k][1:] for k in some]
                ids = np.array(self.tokenizer.encode_batch_fast([mark + mark.join(words)], add_special_tokens=False)[0].ids, dtype=np.int32)
                first = starts[ids]
                sizes = np.diff(np.flatnonzero(first), append=len(ids))
                if mark == "\n":  # the line break itself is a part of its own
                    ids, sizes = ids[~first], sizes - 1
                number[some] = self.add([keys[k] for k in some], ids, sizes) + np.arange(len(some))
        some = groups[None]
        found = self.tokenizer.encode_batch_fast([keys[k][1:] if keys[k][:1] == NUL else " " + keys[k] for k in some], add_special_tokens=False)
        sizes = np.array([len(e.ids) for e in found], dtype=np.int64)
        number[some] = self.add([keys[k] for k in some], np.array([i for e in found for i in e.ids], dtype=np.int32), sizes) + np.arange(len(some))
        return number

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit numbers. The texts' parts are numbered by Arrow, looked up once each, and put together by position."""
        out: list[bytes] = [b""] * len(texts)
        keyed, places = [], []
        for k, text in enumerate(texts):
            if any(s in text for s in self.specials) or NUL in text:
                out[k] = self.whole(text)
            elif self.plain(text):
                keyed.append(NUL + text.replace("\n", LINE))
                places.append(k)
            else:
                keyed.append(NUL + SPLIT.sub(NUL + NUL, text))
                places.append(-1 - k)
        for chosen, mark in (([x for x, k in zip(keyed, places) if k >= 0], " "), ([x for x, k in zip(keyed, places) if k < 0], NUL + NUL)):
            if not chosen:
                continue
            if len(self.known) > MEMO_WORDS or self.known.nbytes > MEMO_BYTES:
                self.clear()
            lists = pc.split_pattern(pa.array(chosen, type=pa.large_string()), mark)
            numbered = lists.flatten().dictionary_encode()
            part = self.numbers(numbered.dictionary).astype(np.int64)
            if (unknown := np.flatnonzero(part < 0)).size:
                part[unknown] = self.learn(numbered.dictionary.take(pa.array(unknown)).to_pylist())
            ids, ends = self.ids(part[numbered.indices.to_numpy()])
            ids = ids.astype("<u4")
            bounds = ends[lists.offsets.to_numpy()].tolist()
            at = [k for k in places if k >= 0] if mark == " " else [-1 - k for k in places if k < 0]
            for k, low, high in zip(at, bounds, bounds[1:]):
                out[k] = ids[low:high].tobytes()
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    return Encoder(path)


def pieces_of(n: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % room or room
    return [(0, n)] if n <= room else [(0, first), *[(s, room) for s in range(first, n, room)]]


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BLOCK_CHARS`` bytes of text (a longer text by itself)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    start = 0
    while start < batch.num_rows:
        done = int(size[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + BLOCK_CHARS)))
        yield batch.slice(start, end - start)
        start = end


def cut(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: ``row, id, piece, start, length, ids_crc32, ids`` (null unless asked for)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).many

        def rows():
            for batch in it:
                for part in blocks(batch):
                    texts = [t or "" for t in part.column(2).to_pylist()]
                    for row, doc, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), encode(texts)):
                        ids += struct.pack("<I", END)
                        for number, (start, length) in enumerate(pieces_of(len(ids) // 4, room)):
                            piece = ids[4 * start:4 * (start + length)]
                            yield row, doc, number, start, length, zlib.crc32(piece), np.frombuffer(piece, dtype="<i4") if with_ids else None
        yield from batches(rows(), PIECES, 500 if with_ids else 20_000)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row long, id long, piece int, start long, length long, ids_crc32 long, ids array<int>")


def plan(histogram: dict[int, int], room: int = ROOM) -> list[tuple[list[tuple[int, int]], int]]:
    """Kinds of sequences as ([(length, multiplicity)], number of sequences),
    best fit from the longest length down, on counts."""
    open_kinds: dict[int, list] = {}  # free room: [(content, number)]
    frees: list[int] = []             # the keys, sorted
    done = []

    def put(free: int, content, number: int) -> None:
        if not free:
            done.append((content, number))
            return
        if free not in open_kinds:
            open_kinds[free] = []
            insort(frees, free)
        open_kinds[free].append((content, number))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(frees, length)
            if at == len(frees):  # nothing open has the room: new sequences, as full of this length as they get
                each = min(room // length, left)
                put(room - each * length, [(length, each)], left // each)
                left %= each
                continue
            free = frees[at]
            content, number = open_kinds[free].pop()
            if not open_kinds[free]:
                del open_kinds[free], frees[at]
            each = min(free // length, left)
            used = min(number, left // each)
            if used < number:
                put(free, content, number - used)
            put(free - each * length, [*content, (length, each)], used)
            left -= used * each
    return done + [x for free in frees for x in open_kinds[free]]


def slots(kinds: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces of this length in each sequence, offset of the first of them)."""
    out, sequence, rank = [], 0, {}
    for content, number in kinds:
        offset = 0
        for length, each in content:
            first = rank.get(length, 0)
            rank[length] = first + number * each
            out.append((length, first, rank[length], sequence, each, offset))
            offset += length * each
        sequence += number
    return out


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``rank``, from 0 within each length."""
    salts = partitions_for(pieces)
    salted = pieces.withColumn("salt", F.floor(unit_hash("row", "piece", seed=9) * salts).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row", "piece"))
    return salted.withColumn("rank", inner).join(before, ["length", "salt"]).withColumn("rank", F.col("rank") - 1 + F.col("before")).drop("salt", "before")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids``."""
    spark = docs.sparkSession
    pieces = materialize(cut(docs, tokenizer_path, id_col, text_col, room, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `room` rows
    table = slots(plan(histogram, room))  # a few rows per length
    places = spark.createDataFrame(table, "length long, first long, until long, sequence long, each long, place long")
    at = F.col("rank") - F.col("first")
    found = ranked(pieces.drop("ids")).join(F.broadcast(places), "length").where("rank >= first and rank < until")
    found = found.select("row", F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
                         (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("place") + at % F.col("each") * F.col("length")).alias("offset"))
    if with_ids:
        found = found.join(pieces.select("row", "piece", "ids"), ["row", "piece"])
    return found.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
