"""A commit log: which numbered batches of a folder count.

A batch writes its parts under its number, which may be repeated after a
failure, and is committed by one row appended last. Readers keep to committed numbers.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "kind string, id long"


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # nothing is committed yet
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def newest(self) -> dict[str, int]:
        """The largest committed number by kind."""
        return {r["kind"]: r["id"] for r in self.rows().groupBy("kind").agg(F.max("id").alias("id")).collect()}

    def add(self, kind: str, number: int) -> None:
        row = self.spark.range(1).select(F.lit(kind).alias("kind"), F.lit(number).cast("long").alias("id"))
        row.coalesce(1).write.mode("append").parquet(self.path)
