"""Text guardrails (G1–G13) as column expressions over report tables
``(id, text, allowed ARRAY<STRING>)``.

Everything is built-in string/array/higher-order functions, so checking
and sanitising a billion report rows is one narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prompt-scrub, technique-id and sanitising patterns.
SPECIAL_TOKEN = r"<\|[^\n]*?\|>"
INJECTION_WORDS = r"(?iU)\b(ignore|system\s+prompt|new\s+instructions|sysprompt)\b"
REDACTED = "[REDACTED]"
SCRUB_MAX = 200
TECHNIQUE_ID = r"(?U)\bT\d{4,5}(?:\.\d{3})?\b"
NO_ID_SORT_KEY = "ZZZZZ"
VERIFY_NOTE = r"(?is)\[VERIFY before finishing.*?\]\.?"
CLOSING_PATTERNS = (
    r"By following these recommendations[^\n]*",
    r"By implementing these[^\n]*",
    r"These measures will[^\n]*",
    r"In summary[,\.][^\n]*",
)
SOFTEN_REPLACEMENTS = (
    (r"\bknown compromised\b", "suspicious"),
    (r"\bcompromised ip(?: addresses?)?\b", "suspicious IP addresses"),
    (r"\bknown compromised accounts?\b", "suspicious accounts"),
)
STUFFING = "credential stuffing"
STUFFING_PATTERN = r"\bcredential stuffing\b"
STUFFING_REPLACEMENT = "brute force"
REASON_COMPROMISED = "Output claims 'known compromised' / 'compromised IP' without explicit evidence labeling."
REASON_ID = "Output mentions technique id not in allowed list: "
REASON_STUFFING = "Output mentions 'credential stuffing' but it is not present in allowed MITRE techniques."
MITRE_HEADING = r"###\s+MITRE ATT&CK OBSERVATIONS\s*\n"
MITRE_LINE_PREFIX = "- **"
MITRE_LINE_SUFFIX = "** — observed in incident data."
NO_MITRE_LINE = "No MITRE techniques observed in evidence."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Texts are in several languages: white space, digits, letters and word
# boundaries follow Unicode ((?U)), as in the rules being reproduced.

def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def scrub(text, max_chars: int | None = SCRUB_MAX) -> Column:
    """G1: null → N/A; drop special tokens; redact injection words; cap at
    ``max_chars`` characters (the last three are dots; None: no cap, for whole
    texts); newlines → spaces; strip."""
    t = _c(text).cast("string")
    s = F.regexp_replace(t, SPECIAL_TOKEN, "")
    s = F.regexp_replace(s, INJECTION_WORDS, REDACTED)
    if max_chars is not None:
        s = F.when(F.length(s) > max_chars, F.concat(F.substring(s, 1, max_chars - 3), F.lit("..."))).otherwise(s)
    s = strip_ws(F.translate(s, "\n\r", "  "))
    return F.when(t.isNull(), F.lit("N/A")).otherwise(s)


def split_techniques(field) -> Column:
    """Split on newline, ``|``, ``;``; a part holding both ``,`` and ``T``
    is split on ``,`` too; parts trimmed, blanks dropped."""
    s = F.coalesce(_c(field).cast("string"), F.lit(""))
    parts = F.filter(F.transform(F.split(F.translate(s, "\n|", ";;"), ";"), strip_ws), lambda p: p != "")
    nested = F.transform(parts, lambda p: F.when(
        F.contains(p, F.lit(",")) & F.contains(p, F.lit("T")),
        F.filter(F.transform(F.split(p, ","), strip_ws), lambda y: y != "")).otherwise(F.array(p)))
    return F.flatten(nested)


def technique_ids(text) -> Column:
    """Technique ids in first-seen order, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(TECHNIQUE_ID), 0))


def allowed_ids(allowed) -> Column:
    """Every id named in the allowed labels."""
    return F.array_distinct(F.flatten(F.transform(F.coalesce(_c(allowed), F.array().cast("array<string>")),
                                                  lambda a: F.regexp_extract_all(a, F.lit(TECHNIQUE_ID), 0))))


def allowed_labels(texts: Column) -> Column:
    """G3 for an array of technique texts: their distinct labels (split, squeezed, scrubbed), ordered by id (no id → ZZZZZ) then text."""
    labels = F.transform(F.flatten(F.transform(texts, split_techniques)), lambda t: scrub(strip_ws(F.regexp_replace(t, r"(?U)\s+", " "))))

    def keyed(t):
        sort_id = F.regexp_extract(t, r"(?U)\b(T\d{4,5}(?:\.\d{3})?)\b", 1)
        return F.struct(F.when(sort_id == "", F.lit(NO_ID_SORT_KEY)).otherwise(sort_id).alias("sort_id"), t.alias("technique"))
    kept = F.array_distinct(F.filter(labels, lambda t: (t != "") & (t != "N/A")))
    return F.transform(F.array_sort(F.transform(kept, keyed)), lambda s: s["technique"])


def allowed_techniques(analyzed: DataFrame, high_levels=("CRITICAL", "HIGH"), scope: tuple = ()) -> DataFrame:
    """Distinct technique labels of high-risk rows (split, squeezed,
    scrubbed), ordered by their id (no id → ZZZZZ) then text; adds ``rank``.
    With ``scope`` columns the labels are listed and ranked per scope. Texts are made distinct before they are split and scrubbed, so the patterns run once for each text, not once for each row."""
    from pyspark.sql import Window

    from .indexing import row_numbers
    texts = analyzed.where(F.col("final_risk_level").isin(*high_levels)).select(*scope, F.coalesce(F.col("mitre_techniques"), F.lit("")).alias("texts")).distinct()
    parts = texts.select(*scope, F.explode(split_techniques("texts")).alias("t"))
    labels = (parts.select(*scope, scrub(strip_ws(F.regexp_replace("t", r"(?U)\s+", " "))).alias("technique"))
              .where((F.col("technique") != "") & (F.col("technique") != "N/A")).distinct())
    sort_id = F.regexp_extract("technique", r"(?U)\b(T\d{4,5}(?:\.\d{3})?)\b", 1)
    labels = labels.withColumn("sort_id", F.when(sort_id == "", F.lit(NO_ID_SORT_KEY)).otherwise(sort_id))
    order = [F.col("sort_id").asc(), F.col("technique").asc()]
    if scope:  # a window per scope holds one scope's distinct labels
        return labels.withColumn("rank", F.row_number().over(Window.partitionBy(*scope).orderBy(*order)).cast("int"))
    return row_numbers(labels, order, "rank").withColumn("rank", F.col("rank").cast("int"))


def validate(text, allowed) -> Column:
    """struct(ok, reasons)."""
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    ids = technique_ids(text)
    ok_ids = allowed_ids(allowed)
    allowed_text = F.lower(F.array_join(F.coalesce(_c(allowed), F.array().cast("array<string>")), " "))
    r1 = F.when(F.contains(low, F.lit("known compromised")) | F.contains(low, F.lit("compromised ip")),
                F.lit(REASON_COMPROMISED))
    r2 = F.transform(F.filter(ids, lambda i: ~F.array_contains(ok_ids, i)), lambda i: F.concat(F.lit(REASON_ID), i))
    r3 = F.when(F.contains(low, F.lit(STUFFING)) & ~F.contains(allowed_text, F.lit(STUFFING)),
                F.lit(REASON_STUFFING))
    reasons = F.concat(F.array_compact(F.array(r1)), r2, F.array_compact(F.array(r3)))
    return F.struct((F.size(reasons) == 0).alias("ok"), reasons.alias("reasons"))


def stuffing_allowed(allowed) -> Column:
    return F.contains(F.lower(F.array_join(F.coalesce(_c(allowed), F.array().cast("array<string>")), " ")),
                      F.lit(STUFFING))


def soften(text, allowed) -> Column:
    """G7 + G8: drop the verify note and closing sentences, soften claims,
    and call credential stuffing brute force unless it is allowed."""
    t = F.regexp_replace(F.coalesce(_c(text), F.lit("")), VERIFY_NOTE, "")
    for pat in CLOSING_PATTERNS:
        t = F.regexp_replace(t, "(?i)" + pat, "")
    for pat, repl in SOFTEN_REPLACEMENTS:
        t = F.regexp_replace(t, "(?i)" + pat, repl)
    return F.when(stuffing_allowed(allowed), t) \
        .otherwise(F.regexp_replace(t, "(?i)" + STUFFING_PATTERN, STUFFING_REPLACEMENT))


def drop_disallowed_list_lines(text, allowed) -> Column:
    """Remove list lines (-, *, •, ``1.``/``1)``) whose ids are all disallowed."""
    ok_ids = allowed_ids(allowed)

    def keep(line: Column) -> Column:
        lead = F.regexp_replace(line, r"(?U)^\s+", "")
        is_list = lead.startswith("-") | lead.startswith("*") | lead.startswith("•") | lead.rlike(r"^\d+[.)]")
        ids = technique_ids(line)
        only_bad = (F.size(ids) > 0) & F.forall(ids, lambda i: ~F.array_contains(ok_ids, i))
        return ~(is_list & only_bad)

    return F.array_join(F.filter(F.split(_c(text), "\n", -1), keep), "\n")


def strip_disallowed_ids(text, allowed) -> Column:
    """Blank out every technique id that is not allowed. An allowed
    sub-technique (``T1110.003``) survives when its parent is removed."""
    ok_ids = allowed_ids(allowed)
    bad = F.filter(technique_ids(text), lambda i: ~F.array_contains(ok_ids, i))
    return F.aggregate(bad, F.coalesce(_c(text), F.lit("")), lambda acc, i: F.regexp_replace(
        acc, F.concat(F.lit(r"(?U)\b"), F.regexp_replace(i, r"\.", r"\\."), F.lit(r"\b(?!\.\d{3}\b)")), F.lit("")))


def rewrite_mitre_section(text, allowed) -> Column:
    """Replace the body of the MITRE section with one line per allowed
    technique (or a fixed line when none is allowed)."""
    t = F.coalesce(_c(text), F.lit(""))
    head = F.regexp_extract(t, r"(?is)^(.*?" + MITRE_HEADING + ")", 1)
    rest = F.substring(t, F.length(head) + 1, 1 << 30)
    tail = F.regexp_extract(rest, r"(?s)^.*?(\n###\s+.*)$", 1)
    ok_ids = allowed_ids(allowed)
    al = F.coalesce(_c(allowed), F.array().cast("array<string>"))
    keep = F.filter(al, lambda item: F.exists(technique_ids(item), lambda i: F.array_contains(ok_ids, i))
                    | (F.size(technique_ids(item)) == 0))
    lines = F.transform(keep, lambda item: F.concat(F.lit(MITRE_LINE_PREFIX), item, F.lit(MITRE_LINE_SUFFIX)))
    block = F.when(F.size(al) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))) \
        .otherwise(F.lit(NO_MITRE_LINE + "\n"))
    return F.when(head == "", t).otherwise(F.concat(head, block, tail))


def squeeze(text) -> Column:
    """Collapse blanks, at most one empty line, drop empty brackets,
    strip, end with a newline."""
    t = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"[ \t]+", " ")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, r"\(\s*\)", "")
    return F.concat(strip_ws(t), F.lit("\n"))


def sanitize(text, allowed) -> Column:
    """G7–G12 in order."""
    t = soften(text, allowed)
    t = drop_disallowed_list_lines(t, allowed)
    t = strip_disallowed_ids(t, allowed)
    t = rewrite_mitre_section(t, allowed)
    return squeeze(t)
