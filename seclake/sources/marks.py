"""Collecting with a persisted mark per host.

A run takes the records beyond each host's mark, writes their rows and the new marks under the next
batch number, and commits the number last. Rows and marks therefore count together or not at all: a run that breaks off at
any point leaves the old marks in force, and the next one collects the same records again into the same folders.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import winevents
from .commits import CommitLog


class Collector:
    """The tables ``rows`` and ``marks`` and the commit log below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path, CommitLog(spark, os.path.join(path, "log"))

    def _folder(self, table: str, number: int | None = None) -> str:
        return os.path.join(self.path, table, *([f"batch={number}"] if number is not None else []))

    def last(self) -> int:
        """The last committed batch; -1 for none."""
        return self.log.newest().get("batch", -1)

    def marks(self) -> DataFrame | None:
        """``host, mark`` as last committed. Each batch's folder holds all hosts' marks, so that one folder is read."""
        last = self.last()
        return None if last < 0 else self.spark.read.parquet(self._folder("marks", last))

    def rows(self) -> DataFrame:
        """All committed rows."""
        last = self.last()
        if last < 0:
            raise ValueError(f"no batch is committed in {self.path}")
        return self.spark.read.parquet(self._folder("rows")).where(F.col("batch") <= last).drop("batch")

    def append(self, records: DataFrame, number: int, marks: DataFrame | None) -> None:
        new = winevents.incremental(records, marks)
        winevents.to_raw_logs(new).write.mode("overwrite").parquet(self._folder("rows", number))
        # All ids count for the mark, those that the projection leaves out as well.
        winevents.new_high_water(new, marks).write.mode("overwrite").parquet(self._folder("marks", number))

    def commit(self, number: int) -> None:
        self.log.add("batch", number)

    def collect(self, records: DataFrame) -> int:
        """Adds the records beyond the marks; returns the number of the batch."""
        number, marks = self.last() + 1, self.marks()
        self.append(records, number, marks)
        self.commit(number)
        return number
