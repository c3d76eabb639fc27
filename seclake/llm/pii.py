"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

Base spans are the leftmost matches of four patterns that pass their tests
(``base_spans``). A greedy match that fails its test hides what lies inside:
two card numbers in a row are one run of 32 digits and no card. The random
field chooses boundaries and kinds jointly. Its segments are whole candidate
spans, each scored by features of the entire span (shape, digit groups,
checksum, neighbours) and of its predecessor's kind; dynamic programming over
spans of at most ``MAX_TOKENS`` tokens finds the best segmentation. Its spans
that touch no base span are added.

Only text near a digit or an ``@`` can hold a candidate, so that
everything else is a segment of kind "none" without being looked at. The field
is fitted on a bounded sample: at most ``SAMPLE_WINDOWS`` windows around base
matches and other numbers, out of documents drawn by a hash of the id; whole
texts of all documents are searched. Windows whose failed match could hide real
data aren't learned from.

Null text is empty. Offsets are code points, ends exclusive. Repeated rows give
equal results. Without a window to learn from, nothing is added.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seclake.llm.common import unit_hash

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 20_000     # documents that are looked through for windows, about
SAMPLE_WINDOWS = 800     # windows that the field is fitted on, at most
WINDOW_TOKENS = 300      # of a window that is learned from
MAX_TOKENS = 16          # of a candidate span
MAX_CHARS = 64
CONTEXT = 12             # characters around a number that belong to its window
BUCKETS = 1 << 13
EPOCHS = 8
MARGIN = 1.0             # what an added span has to gain
Span = tuple[str, int, int]

# Fixed patterns. Where a plain match could take time with the square of a run, an equal form is used:
# an address or number can only begin where its run of characters begins.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TRIGGER = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, m.start() + 1)


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Every match of the four patterns, and whether it passes its test."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, True
    for m in IP.finditer(text):
        yield "ip", *m.span(), all(map(octet, m.groups()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) >= 16:
                yield "card", *m.span(), len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield "phone", *m.span(), 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by kind, then start."""
    return [(kind, start, end) for kind, start, end, good in matches(text) if good]


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text around digits and @, not overlapping, in order."""
    first = last = None
    for m in TRIGGER.finditer(text):
        if first is not None and m.start() - last > 2 * CONTEXT:
            yield max(0, first - CONTEXT), min(len(text), last + CONTEXT)
            first = None
        first, last = m.start() if first is None else first, m.end()
    if first is not None:
        yield max(0, first - CONTEXT), min(len(text), last + CONTEXT)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _char_class(c: str) -> str:
    return "a" if c.isalpha() else "0" if c.isdigit() else "_" if c.isspace() else c


def span_features(text: str, start: int, end: int, tokens: list[str]) -> list[int]:
    """Buckets of the features of a whole candidate span."""
    runs = [t for t in tokens if t[0] in "0123456789"]
    digits = "".join(runs)
    shape = "".join(str(len(t)) if t[0] in "0123456789" else "a" if t.isalpha() else t for t in tokens)
    coarse = "".join("0" if t[0] in "0123456789" else "a" if t.isalpha() else t for t in tokens)
    before, after = text[start - 1] if start else "^", text[end] if end < len(text) else "$"
    marks = "".join(sorted(set(coarse) - {"a", "0"}))
    checks = f"{16 <= len(digits) <= 19 and luhn(digits)}"
    dotted = f"{coarse == '0.0.0.0' and all(map(octet, runs))}"
    letters = any(t.isalpha() for t in tokens)
    names = (
        "bias", "shape " + shape, "coarse " + coarse, "marks " + marks, f"digits {min(len(digits), 25)} {letters}", f"groups {len(runs)} {max(map(len, runs), default=0)}",
        f"card {checks} {len(digits)} {marks.strip(' -') == '' and not letters}", f"dotted {dotted}", f"mail {coarse.count('@')} {'.' in coarse.partition('@')[2]} {coarse[:1]}",
        "edge " + _char_class(before) + _char_class(text[start]), "edge' " + _char_class(text[end - 1]) + _char_class(after), f"plus {tokens[0] == '+'} {min(len(digits), 16)}")
    return [_bucket(n) for n in names]


def candidates(text: str, low: int, high: int) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """Token bounds of a window, its candidate spans as (first token, end token), and their features."""
    tokens = TOKEN.findall(text[low:high])
    bounds = [low]
    for t in tokens:
        bounds.append(bounds[-1] + len(t))
    holds = [0]  # numbers and @ before each token
    for t in tokens:
        holds.append(holds[-1] + (t[0] in "0123456789@"))
    spans, features = [], []
    for i, t in enumerate(tokens):
        if not (t.isascii() and t.isalnum() or t in ("+", "(")):
            continue
        for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
            end = tokens[j - 1]
            if end in "\r\n" or bounds[j] - bounds[i] > MAX_CHARS:
                break
            if holds[j] > holds[i] and end.isascii() and end.isalnum():
                spans.append((i, j))
                features.append(span_features(text, bounds[i], bounds[j], tokens[i:j]))
    return bounds, spans, np.array(features, dtype=np.int64) if spans else np.zeros((0, 1), dtype=np.int64)


class Field:
    """A semi-Markov field: weights of (kind, feature) and of (kind, next kind); kind 0 is none, one token long."""

    def __init__(self, weights: np.ndarray | None = None, steps: np.ndarray | None = None):
        self.weights = np.zeros((len(KINDS), BUCKETS)) if weights is None else weights
        self.steps = np.zeros((len(KINDS) + 1, len(KINDS) + 1)) if steps is None else steps

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.weights[:, features].sum(axis=2).T if len(features) else np.zeros((0, len(KINDS)))

    def best(self, n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> list[tuple[int, int, int]]:
        """The best segmentation's (first token, end token, kind) segments that aren't none."""
        ending = _by_end(n, spans)
        total = np.full((n + 1, len(KINDS) + 1), -np.inf)
        total[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        into = np.full((n + 1, len(KINDS) + 1), -np.inf)
        came = np.zeros((n + 1, len(KINDS) + 1), dtype=int)
        for j in range(n + 1):
            if j:
                total[j, 0] = into[j - 1, 0]
                if ending[j]:
                    rows = ending[j]
                    ways = into[[spans[r][0] for r in rows], 1:] + scores[rows]
                    top = ways.argmax(axis=0)
                    total[j, 1:] = ways[top, range(len(KINDS))]
                    for kind, r in enumerate(top, 1):
                        back[j, kind] = (spans[rows[r]][0], 0)
            ways = total[j][:, None] + self.steps
            came[j] = ways.argmax(axis=0)
            into[j] = ways.max(axis=0)
        out, j, kind = [], n, int(total[n].argmax())
        while j:
            i = back[j, kind][0] if kind else j - 1
            if kind:
                out.append((i, j, kind))
            j, kind = i, int(came[i, kind])
        return out[::-1]

    def gradient(self, n: int, spans: list[tuple[int, int]], features: np.ndarray, gold: dict[tuple[int, int], int]):
        """Of the log-likelihood: (kind, span row) expectations off the gold ones, and the same for steps."""
        scores, ending, k = self.scores(features), _by_end(n, spans), len(KINDS) + 1
        ahead, into = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
        ahead[0, 0] = 0.0
        for j in range(n + 1):
            if j:
                ahead[j, 0] = into[j - 1, 0]
                if rows := ending[j]:
                    ahead[j, 1:] = np.logaddexp.reduce(into[[spans[r][0] for r in rows], 1:] + scores[rows], axis=0)
            into[j] = np.logaddexp.reduce(ahead[j][:, None] + self.steps, axis=0)
        whole = np.logaddexp.reduce(ahead[n])
        # behind[j, y]: what can follow position j after a segment of kind y; out[j, y]: what a segment of kind y that begins at j is worth.
        behind, out = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
        behind[n] = 0.0
        beginning = _by_start(n, spans)
        for j in range(n - 1, -1, -1):
            out[j, 0] = behind[j + 1, 0]
            if rows := beginning[j]:
                out[j, 1:] = np.logaddexp.reduce(behind[[spans[r][1] for r in rows], 1:] + scores[rows], axis=0)
            behind[j] = np.logaddexp.reduce(self.steps + out[j][None, :], axis=1)
        first, last = [s[0] for s in spans], [s[1] for s in spans]
        off = -np.exp(into[first, 1:] + scores + behind[last, 1:] - whole) if spans else np.zeros((0, k - 1))
        step_off = -np.exp(ahead[:n, :, None] + self.steps[None] + out[:n, None, :] - whole).sum(axis=0)
        at, kind = 0, 0
        by_start = {s: (e, y) for (s, e), y in gold.items()}
        row_of = {s: r for r, s in enumerate(spans)}
        while at < n:
            end, y = by_start.get(at, (at + 1, 0))
            if y:
                off[row_of[at, end], y - 1] += 1
            step_off[kind, y] += 1
            at, kind = end, y
        return off, step_off

    def fit(self, examples: list, epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> "Field":
        """AdaGrad over (text, low, high, gold spans) examples, one at a time in a fixed order."""
        prepared = []
        for text, low, high, gold in examples:
            bounds, spans, features = candidates(text, low, high)
            at = {b: k for k, b in enumerate(bounds)}
            known = set(spans)
            marked = {(at[s], at[e]): KINDS.index(kind) + 1 for kind, s, e in gold if s in at and e in at and (at[s], at[e]) in known}
            prepared.append((len(bounds) - 1, spans, features, marked))
        size, step_size = np.full_like(self.weights, 1e-8), np.full_like(self.steps, 1e-8)
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(prepared)):
                n, spans, features, gold = prepared[k]
                off, step_off = self.gradient(n, spans, features, gold)
                used, where = np.unique(features, return_inverse=True)
                if len(used):
                    where, change = where.reshape(features.shape), np.zeros((len(KINDS), len(used)))
                    for y in range(len(KINDS)):
                        change[y] = np.bincount(where.ravel(), np.repeat(off[:, y], features.shape[1]), len(used))
                    change -= decay * self.weights[:, used]
                    size[:, used] += change ** 2
                    self.weights[:, used] += rate * change / np.sqrt(size[:, used])
                step_off -= decay * self.steps
                step_size += step_off ** 2
                self.steps += rate * step_off / np.sqrt(step_size)
        return self

    def spans(self, text: str) -> list[Span]:
        """Spans of the best segmentation of every window."""
        out = []
        for low, high in windows(text):
            bounds, spans, features = candidates(text, low, high)
            if spans:
                scores = self.scores(features) - MARGIN
                out += [(KINDS[y - 1], bounds[i], bounds[j]) for i, j, y in self.best(len(bounds) - 1, spans, scores)]
        return out


def _by_end(n: int, spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(n + 1)]
    for r, (_, j) in enumerate(spans):
        out[j].append(r)
    return out


def _by_start(n: int, spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(n + 1)]
    for r, (i, _) in enumerate(spans):
        out[i].append(r)
    return out


def examples_of(text: str) -> Iterator[tuple[str, int, int, list[Span]]]:
    """Windows to learn from, cut out of the text: (window text, 0, its length, gold spans)."""
    found = sorted(matches(text), key=lambda m: (m[1], KINDS.index(m[0])))
    for low, high in windows(text):
        inside = [m for m in found if m[1] >= low and m[2] <= high]
        hides = any(not good and sum(c.isdigit() for c in text[s:e]) > (15 if kind == "phone" else 19) for kind, s, e, good in inside)
        if hides or high - low > 4 * WINDOW_TOKENS or len(TOKEN.findall(text[low:high])) > WINDOW_TOKENS:
            continue
        gold, last = [], low
        for kind, s, e, good in inside:
            if good and s >= last:
                gold.append((kind, s - low, e - low))
                last = e
        yield text[low:high], 0, high - low, gold


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field fitted on a sample of the windows of ``docs``; see above."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    n = rows.count()

    def find(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            out = [(w, ",".join(f"{k}:{s}:{e}" for k, s, e in gold)) for text in frame["text"] for w, _, _, gold in examples_of(text)]
            yield pd.DataFrame(out, columns=["window", "gold"])

    drawn = rows.where(unit_hash("id", seed=8) < min(1.0, SAMPLE_DOCS / max(n, 1)))
    found = drawn.select("text").mapInPandas(find, "window string, gold string").distinct()
    found = found.orderBy(F.xxhash64("window"), "window", "gold").limit(SAMPLE_WINDOWS).collect()
    examples = []
    for window, gold in found:
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in gold.split(",") if x)]
        examples.append((window, 0, len(window), spans))
    return Field().fit(examples) if examples else Field()


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), both by kind, then start."""
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else None
    added = []
    for kind, start, end in field.spans(text):
        k = int(np.searchsorted(starts, end))  # base spans that begin before this one ends
        if not k or reach[k - 1] <= start:
            added.append((kind, start, end))
    return base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_column(field: Field, text: Column, spark: SparkSession) -> Column:
    """A struct of the numbers of base spans by kind, their digest and all spans."""
    shared = spark.sparkContext.broadcast(field)
    names = [f"n_{k}" for k in KINDS]

    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            base, spans = all_spans(text or "", shared.value)
            counts = [sum(b[0] == k for b in base) for k in KINDS]
            out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        return pd.DataFrame(out, columns=[*names, "base_sha256", "spans"])
    return F.pandas_udf(run, ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string")(text)


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_email, n_ip, n_card, n_phone``, ``base_sha256``, ``spans``."""
    found = docs.select(F.col(id_col).alias("id"), find_column(field, F.col(text_col), docs.sparkSession).alias("found"))
    return found.select(F.col("id").alias(id_col), "found.*")


def redact_column(field: Field, text: Column, spark: SparkSession) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans, the stretch by the first one's kind. Null stays null."""
    shared = spark.sparkContext.broadcast(field)

    def redacted(text: str) -> str:
        spans = sorted(all_spans(text, shared.value)[1], key=lambda x: (x[1], -x[2]))
        out, last = [], 0
        for kind, start, end in spans:
            if start >= last:
                out += [text[last:start], f"[{kind.upper()}]"]
            last = max(last, end)
        return "".join(out) + text[last:]

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(redacted, na_action="ignore")
    return F.pandas_udf(run, "string")(text)
