"""Anomaly offset and flag (M4, M5) from any score column.

The score follows the isolation-forest convention: lower is more
abnormal. ``offset`` is the ``contamination`` quantile (linear
interpolation); a row is an anomaly when ``score - offset < 0``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, DetectionConfig
from ..session import materialize


BINS = 1 << 16


def order_statistics(values: DataFrame, rank: int, low: float, high: float, bins: int = BINS) -> tuple[float, float | None]:
    """The values of 0-based ``rank`` and of the rank behind it (none behind the last)
    among the non-null ``values(v)`` between ``low`` and ``high``, exactly: count the values per
    equal-width bin, go on inside the bin that holds the rank, until that holds one value. Every round is one grouped
    count; at most ``bins`` rows come back, whatever the number of values."""
    after, n = None, None
    while low < high:
        width = (high - low) / bins
        if not width or low + width == low:  # neighbours in floating point: bins would be empty
            width = high - low
        found = (values.where((F.col("v") >= low) & (F.col("v") <= high))
                 .groupBy(F.floor((F.col("v") - F.lit(low)) / F.lit(width)).alias("bin"))
                 .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
        found.sort(key=lambda r: r["bin"])
        for k, r in enumerate(found):
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high, n = r["low"], r["high"], r["n"]
        if k + 1 < len(found):
            after = found[k + 1]["low"]
    if n is None:  # all values are equal
        n = values.count()
    return low, low if rank + 1 < n else after


def score_offset(df: DataFrame, score_col: str, cfg: DetectionConfig = DEFAULT,
                 rows: int | None = None) -> float | None:
    """The ``contamination`` quantile with linear interpolation, exact at every
    size (see ``order_statistics``). The score column is written once, so that its passes
    don't run the plan of ``df`` again. ``rows``: the number of non-null scores, if known (and ``df`` is cheap to read)."""
    values = df.select(F.col(score_col).cast("double").alias("v")).where("v is not null")
    if rows is None:
        values = materialize(values, "scores")
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if n == 0:
        return None
    at = (n - 1) * cfg.contamination
    rank = int(at)
    value, following = order_statistics(values, rank, low, high)
    return value if at == rank else value + (at - rank) * (following - value)


def with_anomaly(df: DataFrame, score_col: str, offset: float | None) -> DataFrame:
    """M5 (+ the raw decision value): ``anomaly_score_raw`` = score − offset."""
    raw = F.col(score_col) - F.lit(offset) if offset is not None else F.lit(None).cast("double")
    return df.withColumns({
        "anomaly_score_raw": raw,
        "is_anomaly": F.coalesce(raw < 0, F.lit(False)).cast("int"),
    })
