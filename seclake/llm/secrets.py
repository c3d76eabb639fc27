"""Secrets: fixed patterns, and strings that look drawn at random.

Only built-in functions run over the texts, in one narrow projection without a shuffle.

* The three fixed kinds (``assign``, ``access``, ``hex``) are matched by regular expressions. A text is split at the matches, and the running sum of the lengths
  of gaps and matches gives the places, in blocks of the square root of their number, so that a text of many matches costs no square.
* Beyond them, runs of ``RUN_LENGTH`` or more characters that a key could be made of are compared under two character Markov models, of random strings and of ordinary
  identifiers. A run whose log-likelihood ratio reaches ``THRESHOLD`` for each of its characters is a span of kind ``random``. Runs inside an ``assign`` match, and those that hold a ``hex`` or ``access`` match, aren't looked at again.

The models are counts of character pairs in labelled strings, from a sample of about ``SAMPLE_DOCS`` documents drawn by a hash of id and text. Labelled random: the values of the
fixed kinds there, and digests of the ids in hexadecimal and base64 letters, which are random by construction. Labelled ordinary: all other runs of ``ORDINARY_LENGTH`` or more, and the texts' words put together as names are (``a_b-c/d`` and ``AbCd``).
What reaches the driver is at most one count for each pair of letters and class. Ratios are whole thousandths, so that sums don't depend on their order.

Null texts are empty and have no spans. Repeated rows are scanned alike; an empty table trains an all-zero model and gives no rows. Offsets are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seclake.llm.common import unit_hash

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a shorter run after the first AKIA holds no longer match, so the length may stand in the pattern
HEX = r"[0-9a-f]{24,}"
VALUE_LENGTH = 6
RUN_LENGTH = 16
ORDINARY_LENGTH = 6
#: Characters of runs, in the order that the model numbers them from 1; 0 is the start.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN = r"[A-Za-z0-9+/_-]"
#: Thousandths of the natural logarithm for each character: at 16 characters e^19 times likelier as a random string.
THRESHOLD = 1_200
SAMPLE_DOCS = 20_000
SMOOTHING = 0.5


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)


def before(lengths: Column) -> Column:
    """For each of a non-empty array's numbers the sum of those before it."""
    def in_blocks(s):
        xs, b = s["xs"], s["b"]
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / b).cast("int")), lambda i: F.slice(xs, i * b + 1, b))

        def within(block, start):
            return F.transform(block, lambda x, j: start + total(F.slice(block, F.lit(1), j)))
        return let(F.struct(blocks.alias("blocks"), F.transform(blocks, total).alias("sums")),
                   lambda t: F.flatten(F.transform(t["blocks"], lambda block, i: let(total(F.slice(t["sums"], F.lit(1), i)), lambda start: within(block, start)))))
    return let(F.struct(lengths.alias("xs"), F.ceil(F.sqrt(F.size(lengths))).cast("int").alias("b")), in_blocks)


NO_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def placed(text: Column, pattern: str, offset: Column | None = None, group: int = 0) -> Column:
    """All matches as ``start, end, value``, in order; ``value`` is a group of the pattern. Matches have at least one character."""
    offset = F.lit(0).cast("long") if offset is None else offset

    def places(s):
        def one(whole, i):
            start = offset + F.element_at(s["at"], i + 1) + F.length(F.element_at(s["gaps"], i + 1))
            return F.struct(start.alias("start"), (start + F.length(whole)).alias("end"), (F.element_at(s["values"], i + 1) if group else whole).alias("value"))
        return F.transform(s["found"], one)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = [found.alias("found"), gaps.alias("gaps")] + ([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values")] if group else [])

    def sums(s):
        both = F.zip_with(s["found"], F.slice(s["gaps"], F.lit(1), F.size(s["found"])), lambda m, g: (F.length(m) + F.length(g)).cast("long"))
        kept = [s[k].alias(k) for k in (["found", "gaps", "values"] if group else ["found", "gaps"])]
        return let(F.struct(*kept, before(both).alias("at")), places)
    return F.when(F.regexp_like(text, F.lit(pattern)), let(F.struct(*parts), sums)).otherwise(F.array().cast(NO_SPANS))


def gaps_of(text: Column, pattern: str) -> Column:
    """What lies between the matches, as ``start, gap``."""
    def with_start(s):
        sizes = F.zip_with(s["gaps"], F.concat(s["found"], F.array(F.lit(""))), lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        return let(before(sizes), lambda at: F.transform(s["gaps"], lambda g, i: F.struct(F.element_at(at, i + 1).alias("start"), g.alias("gap"))))
    cut = let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")), with_start)
    return F.when(F.regexp_like(text, F.lit(pattern)), cut).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("start"), text.alias("gap"))))


def numbers(run: Column) -> Column:
    """The number of each character of a run."""
    return F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.instr(F.lit(LETTERS), c))


class Model:
    """Log-likelihood ratios in thousandths, by the numbers of a character and of the one before it."""

    def __init__(self, ratios: list[int] | None = None):
        self.ratios = ratios or [0] * (len(LETTERS) + 1) ** 2

    def column(self, run: Column) -> Column:
        """The ratio of a run's characters."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")  # a constant, which Spark folds
        start = F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("sum"))
        step = lambda a, c: F.struct(c.alias("last"), (a["sum"] + F.element_at(table, a["last"] * (len(LETTERS) + 1) + c + 1)).alias("sum"))
        return F.aggregate(numbers(run), start, step, lambda a: a["sum"])

    def ratio(self, run: str) -> int:
        """The same of one string, for tests and inspection."""
        codes = [0, *[LETTERS.index(c) + 1 for c in run]]
        return sum(self.ratios[a * (len(LETTERS) + 1) + b] for a, b in zip(codes, codes[1:]))


def fit(counts: dict[tuple[bool, int, int], int]) -> Model:
    """The model of the numbers of (random?, character before, character)."""
    size = len(LETTERS) + 1
    sums: dict[tuple[bool, int], int] = {}
    for (random, a, _), n in counts.items():
        sums[random, a] = sums.get((random, a), 0) + n

    def log(random, a, b):
        return math.log((counts.get((random, a, b), 0) + SMOOTHING) / (sums.get((random, a), 0) + SMOOTHING * len(LETTERS)))
    return Model([round(1000 * (log(True, a, b) - log(False, a, b))) if b else 0 for a in range(size) for b in range(size)])


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``random, run``: the labelled strings of the sample."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    n = rows.count()
    rows = rows.where(unit_hash("id", "text", seed=12) < min(1.0, sample_docs / max(n, 1)))
    values = F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    drawn = F.transform(F.filter(values, lambda v: F.length(v) >= RUN_LENGTH), lambda v: F.regexp_replace(v, "[^A-Za-z0-9+/_-]", ""))
    digest = F.sha2(F.col("id").cast("binary"), 256)
    made = F.array(digest, F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.regexp_replace(F.base64(F.unhex(F.sha2(digest.cast("binary"), 512))), "[^A-Za-z0-9]", ""))
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    words = F.regexp_extract_all(rest, F.lit("[A-Za-z]{2,}"), F.lit(0))
    names = F.array(*[F.array_join(words, mark) for mark in "_-/"], F.array_join(F.transform(words, F.initcap), ""))
    plain = F.concat(F.regexp_extract_all(rest, F.lit(RUN + f"{{{ORDINARY_LENGTH},}}"), F.lit(0)), names)
    return rows.select(F.lit(True).alias("random"), F.explode(F.concat(drawn, made)).alias("run")).unionAll(rows.select(F.lit(False).alias("random"), F.explode(plain).alias("run")))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    runs = labelled(docs, id_col, text_col, sample_docs).groupBy("random", "run").agg(F.count("*").alias("n"))
    pairs = let(numbers(F.col("run")), lambda xs: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(xs, F.lit(1), F.greatest(F.size(xs) - 1, F.lit(0)))), xs, lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    counts = runs.select("random", "n", F.explode(pairs).alias("p")).groupBy("random", "p.a", "p.b").agg(F.sum("n").alias("n"))
    return fit({(r["random"], r["a"], r["b"]): r["n"] for r in counts.collect()})  # at most one for each pair of letters and class


def spans(text: Column, model: Model, threshold: int = THRESHOLD) -> list[tuple[str, Column]]:
    """For each kind its spans, as ``start, end, value``."""
    assign = F.filter(placed(text, ASSIGN, group=2), lambda s: F.length(s["value"]) >= VALUE_LENGTH)
    runs = F.flatten(F.transform(gaps_of(text, ASSIGN), lambda g: placed(g["gap"], RUN + f"{{{RUN_LENGTH},}}", g["start"])))
    new = F.filter(runs, lambda s: F.when(F.regexp_like(s["value"], F.lit(f"{ACCESS}|{HEX}")), False).otherwise(model.column(s["value"]) >= threshold * F.length(s["value"])))
    return list(zip(KINDS, (assign, placed(text, ACCESS), placed(text, HEX), F.when(F.regexp_like(text, F.lit(RUN + f"{{{RUN_LENGTH},}}")), new).otherwise(F.array().cast(NO_SPANS)))))


def written(found: list[tuple[int, str, Column]]) -> Column:
    """``kind:start:end`` of all spans by start, then kind."""
    def named(k: int, kind: str):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("name"))
    rows = F.concat(*[F.transform(c, named(k, kind)) for k, kind, c in found])
    return F.array_join(F.transform(F.array_sort(rows), lambda s: s["name"]), ",")


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, the numbers of the fixed kinds, the digest of their spans, and all spans."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in spans(text, model, threshold)])
    names = [(k, kind, F.col(kind)) for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
                        F.sha2(written(names[:3]).cast("binary"), 256).alias("base_sha256"), written(names).alias("spans"))
