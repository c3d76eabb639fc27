"""Detection on a stream that reads new rows and aggregates only (K4).

What the features of a row need beyond the row itself adds up: counts per user and address, sets of
(user, machine), (user, address) and (address, failed user) pairs, and failures within ten minutes. So each
micro-batch leaves its own part of them under its batch id, and nothing that is there is written again:

* ``rows``: the new rows with their flags and the failures known when they came, by date;
* ``window_adds``: for older rows, how many failures in their window came late;
* ``deltas``: partial sums and distinct pairs of the new rows, by kind.

A batch reads its own rows and, for the window, the rows of the dates that the ten minutes around them touch (partition pruning; three columns).
For the alerts on its own rows it reads the aggregates of the users and addresses in it.

A batch counts once its id stands in the commit log, which is written last. A replayed id that is committed
is left alone; one whose run broke off rewrites its own parts. So rows are neither lost nor counted twice.

``analyzed`` gives all rows with the scores that the aggregates of *now* give them, as one run over everything would: rows joined with
merged aggregates (broadcast by AQE while small). ``compact`` merges deltas into a base; ``process`` does so every ``compact_every`` batches.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, DetectionConfig
from ..functions.ipcols import subnet24
from ..operators import anomaly, features, forest, normalize, rules, scoring
from ..operators.indexing import dense_index
from ..session import materialize
from ..sources.commits import CommitLog


#: What is kept per (kind, key, value). Numbers of equal ones are added up when parts are merged; for the pairs it only matters that they are there.
NUMBERS = {"events": "int(event_id is not null)", "failed": "is_failed_login", "succeeded": "is_successful_login", "tgs": "is_kerberos_tgs", "hours": "login_hour", "hour_rows": "int(login_hour is not null)"}


def merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("kind", "key", "value").agg(*[F.sum(c).cast("long").alias(c) for c in NUMBERS])


def part_of(rows: DataFrame) -> DataFrame:
    """What rows add to the aggregates: counts per user and address, and (user, machine), (user, address) and (address, failed user) pairs, and subnets. One aggregation."""
    user, ip, machine = F.col("username"), F.col("source_ip"), features.machine_key(rows.columns)
    failed_user = F.when(F.col("is_failed_login") == 1, user)
    kinds = (("user", user, F.lit("")), ("user_machine", user, machine), ("user_ip", user, ip), ("ip", ip, F.lit("")), ("ip_failed_user", ip, failed_user), ("subnet", F.col("ip_subnet"), F.lit("")))
    each = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key"), value.alias("value")) for kind, key, value in kinds])).alias("k")
    return merged(rows.select(*[F.expr(c).cast("long").alias(name) for name, c in NUMBERS.items()], each).select("k.*", *NUMBERS).where("key is not null and value is not null"))


@dataclass
class Store:
    """The tables of one detection stream below ``path``."""

    spark: SparkSession
    path: str
    cfg: DetectionConfig = DEFAULT
    compact_every: int = 100

    def _at(self, *names: str) -> str:
        return os.path.join(self.path, *names)

    # ------------------------------------------------------------ commit log

    def _log(self) -> CommitLog:
        return CommitLog(self.spark, self._at("log"))

    def _commit(self, kind: str, number: int) -> None:
        self._log().add(kind, number)

    def newest(self) -> tuple[int, int]:
        """The last committed batch and the last one that a base holds; -1 for none. Batches commit in order."""
        found = self._log().newest()
        return found.get("batch", -1), found.get("base", -1)

    # ------------------------------------------------------------ reading

    def _parts(self, table: str, above: int, upto: int) -> DataFrame | None:
        """A table's parts of the batches in (above, upto], or none."""
        if upto <= above:
            return None
        # One folder per batch, listed as partitions: the filter prunes folders.
        return self.spark.read.parquet(self._at(table)).where((F.col("batch") > above) & (F.col("batch") <= upto)).drop("batch")

    def state(self, last: int, base: int, only: DataFrame | None = None) -> DataFrame:
        """The aggregates as of batch ``last``: the newest base and the parts since. ``only``: the keys wanted."""
        parts = self._parts("deltas", base, last)
        if base >= 0:
            old = self.spark.read.parquet(self._at("base", f"{base:020d}"))
            parts = old if parts is None else parts.unionByName(old)
        return merged(parts if only is None else parts.join(only, "key", "left_semi"))

    def profiles(self, last: int, base: int, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """A1–A9 per user and per address; ``only``: rows whose users and addresses are wanted."""
        keys = None if only is None else only.select(F.explode(F.array("username", "source_ip")).alias("key")).where("key is not null").distinct()
        state, kind = self.state(last, base, keys), F.col("kind")

        def of(name: str, column: str):
            return F.max(F.when(kind == name, F.col(column)))

        def pairs(name: str):
            return F.count(F.when(kind == name, 1))
        users = state.where(kind.isin("user", "user_machine", "user_ip")).groupBy(F.col("key").alias("username")).agg(
            of("user", "events").alias("user_event_count"), of("user", "failed").alias("user_failed_count"), of("user", "succeeded").alias("user_success_count"),
            pairs("user_machine").alias("user_unique_machines"), pairs("user_ip").alias("user_unique_ips"),
            F.try_divide(of("user", "hours"), of("user", "hour_rows")).alias("user_avg_hour"), of("user", "tgs").alias("user_tgs_count"))
        ips = state.where(kind.isin("ip", "ip_failed_user")).groupBy(F.col("key").alias("source_ip")).agg(
            of("ip", "events").alias("ip_event_count"), pairs("ip_failed_user").alias("ip_unique_failed_users"))
        return users, ips

    def _scored(self, rows: DataFrame, users: DataFrame, ips: DataFrame, subnets: DataFrame | None, saved=None) -> DataFrame:
        found = features.attach(rows, users, ips, subnets)
        if saved is None:
            found = found.withColumns({"anomaly_score_raw": F.lit(None).cast("double"), "is_anomaly": F.lit(0)})
        else:
            found = anomaly.with_anomaly(forest.score(found, saved.forest, out="_forest_score"), "_forest_score", saved.offset).drop("_forest_score")
        return scoring.with_scores(rules.with_rules(found, self.cfg), self.cfg)

    def analyzed(self, saved=None) -> DataFrame:
        """All committed rows with the scores that hold now. ``saved``: a model (``forest.load``); without one ``is_anomaly`` is 0."""
        last, base = self.newest()
        if last < 0:
            raise ValueError(f"no batch is committed in {self.path}")
        rows = self._parts("rows", -1, last)
        adds = self._parts("window_adds", -1, last).groupBy("log_id").agg(F.sum("late").alias("late"))
        rows = rows.join(adds, "log_id", "left").withColumn("failed_last_10min", F.col("failed_last_10min") + F.coalesce("late", F.lit(0))).drop("late", "event_date")
        users, ips = self.profiles(last, base)
        subnets = self.state(last, base).where("kind = 'subnet'").select(F.col("key").alias("ip_subnet"))
        return self._scored(rows, users, ips, dense_index(subnets, "ip_subnet", "ip_subnet_enc"), saved)

    def alerts(self) -> DataFrame:
        """The new rows that were CRITICAL or HIGH when their batch came, with its id."""
        last, _ = self.newest()
        return self.spark.read.parquet(self._at("alerts")).where(F.col("batch") <= last)

    # ------------------------------------------------------------ writing

    def _write(self, df: DataFrame, table: str, batch_id: int, by: str | None = None) -> None:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self._at(table, f"batch={batch_id}"))

    def _around(self, new: DataFrame, last: int) -> DataFrame | None:
        """``log_id, username, timestamp, is_failed_login`` of the committed rows within a window's reach of the new ones."""
        span = new.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
        if last < 0 or span["low"] is None:
            return None
        reach = F.expr(f"interval {int(self.cfg.window_seconds)} seconds")
        low, high = F.lit(span["low"]).cast("timestamp_ntz") - reach, F.lit(span["high"]).cast("timestamp_ntz") + reach
        old = self.spark.read.parquet(self._at("rows")).where((F.col("batch") <= last) & (F.col("event_date") >= F.to_date(low)) & (F.col("event_date") <= F.to_date(high)))
        return old.where((F.col("timestamp") >= low) & (F.col("timestamp") <= high)).select("log_id", "username", "timestamp", "is_failed_login")

    def _with_window(self, rows: DataFrame, others: DataFrame) -> DataFrame:
        """W1 of ``rows`` over their own failures and those of ``others``."""
        empty = [F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c not in others.columns]
        both = rows.withColumn("_own", F.lit(True)).unionByName(others.select("*", *empty).withColumn("_own", F.lit(False)))
        return features.with_failed_window(both, self.cfg).where("_own").drop("_own")

    def process(self, batch: DataFrame, batch_id: int) -> bool:
        """Adds one micro-batch of ``raw_logs`` rows; False if its id is committed already."""
        last, base = self.newest()
        if batch_id <= last:
            return False
        new = materialize(normalize.with_flags(normalize.normalize(batch.drop("event_date")), self.cfg).withColumn("ip_subnet", subnet24("source_ip", "N/A")), "batch")
        if not new.limit(1).count():
            return True  # nothing to add, nothing to remember
        old = self._around(new, last)
        narrow = new.select("log_id", "username", "timestamp", "is_failed_login")
        if old is None:
            rows, late = features.with_failed_window(new, self.cfg), narrow.limit(0).select("log_id", F.lit(0).cast("long").alias("late"))
        else:
            rows = self._with_window(new, old.where("is_failed_login = 1"))
            unset = old.withColumn("is_failed_login", F.lit(0))
            late = self._with_window(unset, narrow.where("is_failed_login = 1")).where("failed_last_10min > 0").select("log_id", F.col("failed_last_10min").alias("late"))
        self._write(rows.withColumn("event_date", F.to_date("timestamp")), "rows", batch_id, by="event_date")
        self._write(late, "window_adds", batch_id)
        self._write(part_of(new), "deltas", batch_id, by="kind")
        written = self.spark.read.parquet(self._at("rows", f"batch={batch_id}")).drop("event_date")
        users, ips = self.profiles(batch_id, base, only=new)
        scored = self._scored(written, users, ips, None)
        self._write(scored.where(F.col("final_risk_level").isin("CRITICAL", "HIGH")), "alerts", batch_id)
        self._commit("batch", batch_id)
        if self.compact_every and batch_id - base >= self.compact_every:
            self.compact()
        return True

    def compact(self) -> None:
        """Merges the aggregates of all committed batches into a new base, which readers use once it is in the log."""
        last, base = self.newest()
        if last <= base:
            return
        self.state(last, base).write.mode("overwrite").partitionBy("kind").parquet(self._at("base", f"{last:020d}"))
        self._commit("base", last)


def start(raw_stream: DataFrame, path: str, checkpoint: str, cfg: DetectionConfig = DEFAULT, available_now: bool = True, interval: str = "60 seconds"):
    """Runs ``Store.process`` on each micro-batch of a stream of ``raw_logs`` rows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        Store(batch.sparkSession, path, cfg).process(batch.drop("event_time"), batch_id)
    writer = raw_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
