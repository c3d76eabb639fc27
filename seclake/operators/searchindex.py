"""Substring search over incident rows through an index of their distinct values (R15 at scale).

``reports.incident_search`` looks into four fields of every row. The fields repeat few values (users, addresses, levels, technique texts), so the
index holds each distinct value once, in lower case, with its trigrams as postings:

* a term of three characters or more takes the values that hold all its trigrams, and verifies them; a shorter
  one looks into all distinct values;
* rows follow by joins on the four fields with the values found (broadcast by AQE while small, else by shuffle). Values
  that occur in a third of the rows are one entry in the index, and no row is read before its values are known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FIELDS = ("username", "source_ip", "final_risk_level", "mitre_techniques")
GRAM = 3


@dataclass
class SearchIndex:
    values: DataFrame    # field, value (as stored; null never matches), lower
    postings: DataFrame  # gram, field, value


def grams(text: Column) -> Column:
    """The distinct runs of ``GRAM`` characters; none of a shorter text."""
    places = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def build(rows: DataFrame, fields: tuple = FIELDS) -> SearchIndex:
    """The index of ``rows``, written once. One aggregation with map-side partial sets."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("v")
    values = rows.select(each).select("v.*").where("value is not null").distinct().withColumn("lower", F.lower("value"))
    values = materialize(values, "search-values")
    postings = values.select(F.explode(grams(F.col("lower"))).alias("gram"), "field", "value")
    # Sorted by gram within files, so that a term's filter skips row groups.
    return SearchIndex(values, materialize(postings.repartition("gram").sortWithinPartitions("gram"), "search-postings"))


def matching(index: SearchIndex, term: str) -> DataFrame:
    """``field, value`` of the distinct values that hold ``term``, in any case."""
    q = term.lower()
    wanted = sorted({q[i:i + GRAM] for i in range(len(q) - GRAM + 1)})
    if not wanted:
        return index.values.where(F.contains("lower", F.lit(q))).select("field", "value")
    held = index.postings.where(F.col("gram").isin(wanted)).groupBy("field", "value").agg(F.count("*").alias("n")).where(F.col("n") == len(wanted))
    return held.where(F.contains(F.lower("value"), F.lit(q))).select("field", "value")


def search(rows: DataFrame, index: SearchIndex, term: str, fields: tuple = FIELDS) -> DataFrame:
    """The rows that ``reports.incident_search`` gives."""
    if not term:  # every row holds the empty text, rows of nulls too
        return rows
    found = materialize(matching(index, term), "search-found")
    out = rows
    for f in fields:
        hit = found.where(F.col("field") == f).select(F.col("value").alias(f), F.lit(True).alias(f"_{f}"))
        out = out.join(hit, f, "left")
    return out.where(F.coalesce(*[F.col(f"_{f}") for f in fields], F.lit(False))).select(*rows.columns)
