"""SimHash near-duplicate groups over a Gray-order hierarchical index.

1. A fingerprint per document (a Pandas UDF over whole texts); equal
   fingerprints fall together in one grouped row, so copies cost nothing more.
2. Top nodes of the index: the 64 bits are cut into ``max_bits + 2`` blocks
   and each node holds the fingerprints that share the bits of two of them.
   Two fingerprints within ``max_bits`` bits agree on at least two blocks, so
   they meet in at least one node: nothing is lost, and no two nodes are compared.
3. A node with more than ``NODE_ROWS`` fingerprints is cut along the Gray order
   into parts. A part's shared bit pattern (``bit_and`` and ``bit_or``) rules out
   whole pairs of parts; each pair left is a task of its own, so a hot node
   (a large group of near copies) is spread.
4. In a task the fingerprints, sorted by Gray rank, get a tree: each node
   holds the bits that all below it share and that its parent does not hold
   yet. A query walks down and adds up the differing bits; a node beyond
   ``max_bits`` drops everything below it. What arrives at the lowest level
   is the exact distance.
5. A task sends on a spanning forest of its links, never the pairs;
   ``components`` joins the forests.

Null text counts as empty; texts without words have fingerprint zero and link
like any other. Repeated rows are rows of their own and fall into one
component. A null id takes part, but is not the smallest id unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import components, free_name, local_components
from seclake.session import materialize

NODE_ROWS = 2048  # fingerprints in a task's node
LEAF = 16         # fingerprints in a lowest node
FANOUT = 8        # children of an upper node
CUTS = 1024       # most parts of a hot node
HASHES_AT_ONCE = 1 << 16
QUERIES_AT_ONCE = 128
EDGES_AT_ONCE = 400_000
EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> list[int]:
    """XXH64 of each run of ``words`` words, A-Z in lower case, joined by one space."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not parts:
        return []
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [digest(joined, seed)]
    ends = list(accumulate(len(p) + 1 for p in parts))
    return [digest(joined[s:e - 1], seed) for s, e in zip([0, *ends], ends[words - 1:])]


def fingerprint(text: str | None, words: int) -> int:
    hashes = shingle_hashes(text, words)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), HASHES_AT_ONCE):
        block = np.array(hashes[k:k + HASHES_AT_ONCE], dtype=np.uint64)
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, words: int) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))
    return F.pandas_udf(run, "long")(text)


def gray_rank(bits: Column) -> Column:
    """Position of a 64-bit pattern in the Gray code's order."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def block_masks(max_bits: int) -> list[int]:
    """A mask for each two of ``max_bits + 2`` blocks of the 64 bits, as signed numbers."""
    n = max_bits + 2
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(blocks, 2))]


class GrayIndex:
    """Tree over fingerprints that are sorted by Gray rank."""

    def __init__(self, sorted_bits: np.ndarray):
        self.levels = []  # from the top: shared bits, mask of those the parent doesn't hold
        shared, mask, step = sorted_bits, np.full(len(sorted_bits), ~np.uint64(0)), LEAF
        levels, any_bit, all_bit = [(shared, mask)], sorted_bits, sorted_bits
        self.steps = []
        while len(any_bit) > 1:
            starts = np.arange(0, len(any_bit), step)
            all_bit, any_bit = np.bitwise_and.reduceat(all_bit, starts), np.bitwise_or.reduceat(any_bit, starts)
            levels.append((all_bit, ~(all_bit ^ any_bit)))
            self.steps.append(step)
            step = FANOUT
        levels.reverse()
        self.steps.reverse()
        for k, (bits, mask) in enumerate(levels):
            if k:
                mask = mask & ~np.repeat(levels[k - 1][1], self.steps[k - 1])[:len(mask)]
            self.levels.append((bits, mask))

    def search(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) positions of all pairs within ``max_bits`` bits."""
        bits, mask = self.levels[0]
        apart = np.bitwise_count((queries[:, None] ^ bits[None, :]) & mask[None, :]).astype(np.int16)
        who, node = np.nonzero(apart <= max_bits)
        apart = apart[who, node]
        for step, (bits, mask) in zip(self.steps, self.levels[1:]):
            child = (node[:, None] * step + np.arange(step)[None, :]).ravel()
            who, apart = np.repeat(who, step), np.repeat(apart, step)
            real = child < len(bits)
            who, apart, child = who[real], apart[real], child[real]
            apart = apart + np.bitwise_count((queries[who] ^ bits[child]) & mask[child])
            near = apart <= max_bits
            who, node, apart = who[near], child[near], apart[near]
        return who, node


def forest(index_bits: np.ndarray, query_bits: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among ``index_bits`` (sorted by
    Gray rank), or between them and ``query_bits``."""
    index, n = GrayIndex(index_bits), len(index_bits)
    queries = index_bits if query_bits is None else query_bits
    everyone = index_bits if query_bits is None else np.concatenate([index_bits, query_bits])
    first = 0 if query_bits is None else n
    label = np.arange(len(everyone))
    for k in range(0, len(queries), QUERIES_AT_ONCE):
        who, entry = index.search(queries[k:k + QUERIES_AT_ONCE], max_bits)
        label = local_components(len(label), who + k + first, entry, label)
    member = np.nonzero(label != np.arange(len(label)))[0]
    return everyone[label[member]], everyone[member]


def _task_edges(it: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Spanning edges of each task's links. Rows come ordered by task and Gray rank."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        a, b = (np.concatenate(x) for x in zip(*held))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = local_components(len(nodes), at[:len(a)], at[len(a):])
        member = np.nonzero(label != np.arange(len(nodes)))[0]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(nodes[label[member]].view(np.int64)), pa.array(nodes[member].view(np.int64))], schema=EDGE)

    def tasks(task: np.ndarray, bits: np.ndarray, side: np.ndarray):
        """All links of complete tasks."""
        starts = np.nonzero(np.r_[True, task[1:] != task[:-1]])[0]
        sizes = np.diff(np.r_[starts, len(task)])
        for k in np.nonzero(sizes > LEAF)[0]:
            part = slice(starts[k], starts[k] + sizes[k])
            far = side[part] == 1
            b = bits[part]
            held.append(forest(b[~far], b[far] if far.any() else None, max_bits))
        small = np.repeat(sizes <= LEAF, sizes)
        task, bits = task[small], bits[small]
        for shift in range(1, LEAF):  # lowest nodes: entry against entry, for all of them at once
            x, y = bits[:-shift], bits[shift:]
            near = (task[shift:] == task[:-shift]) & (np.bitwise_count(x ^ y) <= max_bits)
            held.append((x[near], y[near]))

    rest = None
    for batch in it:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        cols = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols)]
        task = cols[0]
        cut = int(np.searchsorted(task, task[-1])) if len(task) else 0  # the last task may go on in the next batch
        rest = [c[cut:] for c in cols]
        if cut:
            tasks(task[:cut], cols[1][:cut].view(np.uint64), cols[2][:cut])
        if sum(len(a) for a, _ in held) > EDGES_AT_ONCE:
            yield flush()
    if rest is not None and len(rest[0]):
        tasks(rest[0], rest[1].view(np.uint64), rest[2])
    if held:
        yield flush()


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """A set of edges ``(a, b)`` that joins exactly the distinct fingerprints
    ``prints(bits)`` that a chain of distances of at most ``max_bits`` connects."""
    masks = block_masks(max_bits)
    entry = prints.select(F.explode(F.array(*[F.struct(F.lit(k).alias("mask"), F.col("bits").bitwiseAND(F.lit(m).cast("long")).alias("shared")) for k, m in enumerate(masks)])).alias("n"), "bits")
    entry = entry.select("n.mask", "n.shared", "bits")
    key = ["mask", "shared"]
    nodes = entry.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    entry = materialize(entry.join(nodes, key).withColumn("rank", gray_rank(F.col("bits"))), "nodes")
    small = entry.where(F.col("n") <= NODE_ROWS).select(*key, F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "bits", "rank")

    hot = entry.where(F.col("n") > NODE_ROWS)
    points = hot.groupBy(*key).agg(F.percentile_approx("rank", [k / CUTS for k in range(1, CUTS)], 10_000).alias("at"), F.first("n").alias("n"))
    parts = F.least(F.lit(CUTS), F.ceil(F.col("n") / NODE_ROWS)).cast("int")
    points = points.withColumn("parts", parts).select(*key, F.expr(f"transform(sequence(1, parts - 1), k -> at[cast(k * {CUTS} / parts as int) - 1])").alias("at"))
    hot = hot.drop("n").join(points, key).withColumn("part", F.expr("size(filter(at, x -> x < rank))")).drop("at")
    upper = hot.groupBy(*key, "part").agg(F.bit_and("bits").alias("all_bit"), F.bit_or("bits").alias("any_bit"))
    left, right = (upper.select(*key, F.col("part").alias(p), F.col("all_bit").alias(f"{p}_bits"), F.bitwise_not(F.col("all_bit").bitwiseXOR(F.col("any_bit"))).alias(f"{p}_mask")) for p in "ij")
    apart = F.bit_count(F.col("i_bits").bitwiseXOR(F.col("j_bits")).bitwiseAND(F.col("i_mask")).bitwiseAND(F.col("j_mask")))
    pairs = left.join(right, key).where((F.col("i") <= F.col("j")) & (apart <= max_bits)).select(*key, "i", "j")
    wide = (hot.join(pairs.withColumn("part", F.col("i")), [*key, "part"]).select(*key, "i", "j", F.lit(0).alias("side"), "bits", "rank")
            .unionAll(hot.join(pairs.where("i < j").withColumn("part", F.col("j")), [*key, "part"]).select(*key, "i", "j", F.lit(1).alias("side"), "bits", "rank")))

    task = F.xxhash64(*key, "i", "j").alias("task")  # equal hashes of two tasks only add comparisons
    tasks = small.unionAll(wide).select(task, "bits", "side", "rank")
    return (tasks.repartition("task").sortWithinPartitions("task", "side", "rank").select("task", "bits", "side")
            .mapInArrow(lambda it: _task_edges(it, max_bits), "a long, b long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` rows as ``row`` (a row number), ``id_col``, ``bits`` (the
    fingerprint as a signed number), ``root`` (names the component) and
    ``component_id`` (smallest id that links reach)."""
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), words).alias("bits")), "fingerprints")
    return group_fingerprints(rows, max_bits).withColumnRenamed("id", id_col)


def group_fingerprints(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows(row, id, bits)`` with ``root`` and ``component_id``."""
    prints = materialize(rows.groupBy("bits").agg(F.min("id").alias("id")), "prints")
    member = components(links(prints.select("bits"), max_bits))
    named = prints.join(member.withColumnRenamed("node", "bits"), "bits", "left").select("bits", "id", F.coalesce("root", "bits").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.join(named.select("bits", "root").join(least, "root"), "bits").select("row", "id", "bits", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` in 16 hex digits, ``component_id``."""
    found = simhash_groups(docs, id_col, text_col, words, max_bits)
    return found.select(id_col, F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with
    the smallest ``doc_id`` stays, null ids last and of repeated ids the first row."""
    row, bits = free_name(docs, "row"), free_name(docs, "bits")
    hashed = materialize(docs.withColumns({row: F.monotonically_increasing_id(), bits: fingerprint_column(F.col("text"), words)}), "hashed")
    found = group_fingerprints(hashed.select(F.col(row).alias("row"), F.col("doc_id").alias("id"), F.col(bits).alias("bits")), max_bits)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")).select(F.col("first.row").alias(row))
    return hashed.join(first, row, "left_semi").select(*docs.columns)
