"""The corpus pipeline: documents through five of the training-data operators.

A stage takes all rows that its predecessor kept. All but the last return the
columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seclake.llm import langid, mixing, packing, pii, queries, simhash
from seclake.llm.common import free_name, table
from seclake.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; a missing ``lang`` is filled in. Null texts have none; repeated rows are judged alike."""
    return langid.keep(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return simhash.keep_one(docs, words=4, max_bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    field = pii.train(docs)
    docs = docs.withColumn("text", pii.redact_column(field, F.col("text"), spark))
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn at the rates that meet the target weights, none more than once; a lack of low or toxic ones costs no clean one."""
    labels = mixing.labelled_domains(table(spark, sf_dir, "labels"))
    classifier = mixing.train(docs, labels, list(queries.TARGETS))
    name = free_name(docs, "soft")
    soft = materialize(docs.withColumn(name, mixing.classified(docs, classifier)), "soft")
    kept = list(queries.TARGETS).index(queries.KEPT)
    rate, _, _ = mixing.rates(soft, list(queries.TARGETS.values()), max_rate=1.0, posterior=f"{name}.posterior", tokens=f"{name}.tokens", keep=kept)
    return soft.where(mixing.copies(rate, F.col("doc_id")) > 0).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("PII", personal_data),
          ("mixing to target weights", mixture), ("best-fit packing", packed)]

#: No stage can be put in SQL (models, XXH64, a tokenizer); the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
