"""Versions of a table that readers can hold on to.

``publish`` writes a whole version and commits it; readers take the newest committed one. ``pin`` keeps a version for a
reader until it is released or its lease ends, so that a reader that died holds nothing for good. The owner's ``clean`` removes the versions
that are neither among the newest nor pinned, and what broken-off runs left below the newest.
"""

from __future__ import annotations

import os
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_path
from .commits import CommitLog

PINS = "at long, reader string, version long, until long"
LEASE_SECONDS = 3600


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path, CommitLog(spark, os.path.join(path, "log"))

    def folder(self, version: int) -> str:
        return os.path.join(self.path, f"v-{version:020d}")

    def newest(self) -> int:
        """The newest committed version; -1 for none."""
        return self.log.newest().get("version", -1)

    def publish(self, df: DataFrame, version: int | None = None) -> int:
        """Writes ``df`` as a version (by default the next one; a repeated number replaces itself) and commits it."""
        version = self.newest() + 1 if version is None else version
        df.write.mode("overwrite").parquet(self.folder(version))
        self.log.add("version", version)
        return version

    def read(self, version: int | None = None) -> DataFrame:
        version = self.newest() if version is None else version
        if version < 0:
            raise ValueError(f"no version is committed in {self.path}")
        return self.spark.read.parquet(self.folder(version))

    # ------------------------------------------------------------ pins

    def _note(self, reader: str, version: int | None, until: int) -> None:
        row = self.spark.range(1).select(F.lit(time.time_ns()).alias("at"), F.lit(reader).alias("reader"), F.lit(version).cast("long").alias("version"), F.lit(until).cast("long").alias("until"))
        row.coalesce(1).write.mode("append").parquet(os.path.join(self.path, "pins"))

    def pins(self) -> dict[str, int]:
        """The version that each reader holds now: its last note, while the lease runs."""
        try:
            notes = self.spark.read.schema(PINS).parquet(os.path.join(self.path, "pins"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # nobody has pinned yet
                raise
            return {}
        last = notes.groupBy("reader").agg(F.max(F.struct("at", "version", "until")).alias("n")).select("reader", "n.version", "n.until")
        return {r["reader"]: r["version"] for r in last.where(F.col("version").isNotNull() & (F.col("until") > time.time_ns())).collect()}

    def pin(self, reader: str, version: int | None = None, seconds: float = LEASE_SECONDS) -> int:
        """Holds a version (by default the newest) for ``reader``, in place of the one it held. The note comes first and the look whether
        the version is still there second, so that a clean-up in between is seen; then the newest is tried again."""
        while True:
            wanted = self.newest() if version is None else version
            self._note(reader, wanted, time.time_ns() + int(seconds * 1e9))
            if os.path.basename(self.folder(wanted)) in list_path(self.spark, self.path):
                return wanted
            if version is not None:
                self.release(reader)
                raise ValueError(f"version {version} is gone")

    def release(self, reader: str) -> None:
        self._note(reader, None, 0)

    def clean(self, keep: int = 1) -> list[int]:
        """Removes all versions but the ``keep`` newest committed ones and the pinned ones; returns their numbers."""
        committed = sorted({r["id"] for r in self.log.rows().where("kind = 'version'").select("id").distinct().collect()})
        if not committed:
            return []
        kept = {*committed[-keep:], *self.pins().values()}
        there = [int(name[2:]) for name in list_path(self.spark, self.path) if name.startswith("v-")]
        gone = sorted(v for v in there if v not in kept and v < committed[-1])
        for v in gone:
            delete_path(self.spark, self.folder(v))
        return gone
