"""Behavioural features.

Plan shape, chosen for skewed security data (service accounts, ``N/A``
and loopback addresses can own a large share of all rows):

* one ``groupBy(username)`` computes every per-user aggregate, one
  ``groupBy(source_ip)`` every per-IP aggregate; partial (map-side)
  aggregation collapses hot keys before the shuffle;
* the aggregates are attached with left joins. AQE measures the
  aggregated side at runtime and broadcasts it when it is under the
  threshold, otherwise keeps a sort-merge join with skew splitting;
* the trailing 10-minute window is a running sum, split by time (see
  ``with_failed_window``), so no group holds more than one user's
  20 minutes of rows and a burst costs time in proportion to its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, DetectionConfig
from ..functions.ipcols import subnet24
from ..functions.timecols import MICROS_PER_SECOND, micros
from .indexing import dense_index

USER_FEATURES = ("user_event_count", "user_failed_count", "user_success_count", "user_unique_machines",
                 "user_unique_ips", "user_tgs_count")
IP_FEATURES = ("ip_event_count", "ip_unique_failed_users")


def machine_key(columns) -> Column:
    """What tells machines apart (A4, D3): the host where rows have one, else the collector's tag."""
    return F.coalesce("host", "machine") if "host" in columns else F.col("machine")


def user_profile(df: DataFrame, scope: tuple = ()) -> DataFrame:
    """A1–A5, A7, A9 in one aggregation; null users are excluded."""
    return (df.where(F.col("username").isNotNull())
            .groupBy(*scope, "username")
            .agg(F.count("event_id").alias("user_event_count"),
                 F.sum("is_failed_login").cast("bigint").alias("user_failed_count"),
                 F.sum("is_successful_login").cast("bigint").alias("user_success_count"),
                 F.countDistinct(machine_key(df.columns)).alias("user_unique_machines"),
                 F.countDistinct("source_ip").alias("user_unique_ips"),
                 F.avg("login_hour").alias("user_avg_hour"),
                 F.sum("is_kerberos_tgs").cast("bigint").alias("user_tgs_count")))


def ip_profile(df: DataFrame, scope: tuple = ()) -> DataFrame:
    """A6 and A8 in one aggregation (``source_ip`` is already filled, N2)."""
    failed_user = F.when(F.col("is_failed_login") == 1, F.col("username"))
    return (df.groupBy(*scope, "source_ip")
            .agg(F.count("event_id").alias("ip_event_count"),
                 F.countDistinct(failed_user).alias("ip_unique_failed_users")))


def with_failed_window(df: DataFrame, cfg: DetectionConfig = DEFAULT) -> DataFrame:
    """Failures of the same user in ``(t - window, t]`` (peers included).

    Linear in a burst: a failure adds 1 at its own time and takes 1 away at
    ``t + window``, and a running sum over ``(username, bucket)`` gives every
    row its count (a sliding frame would add the same rows up again for
    each row). Split by time: a row goes to its bucket (``window /
    window_salt`` wide); a failure also leaves narrow copies (key, time and
    change only) in the next ``window_salt`` buckets, the last of which gets its
    expiry as well. The sums equal the plain per-user window, while no group
    holds more than two windows of one user; a larger salt makes them smaller.
    Rows with a null user or time get 0. ``window_ties="row"`` counts rows of
    equal time only up to the current one in ``log_id`` order.

    With ``priv_esc_mode="correlated"`` the same groups also give the last
    successful logon within ``priv_esc_seconds`` (D2 correlated), as a running maximum.
    """
    width = cfg.window_seconds * MICROS_PER_SECOND
    salt = max(1, int(cfg.window_salt))
    correlated = cfg.priv_esc_mode == "correlated"
    base = df.withColumns({"_us": micros("timestamp"), "_bucket": F.floor(micros("timestamp") * salt / width)})
    valid = F.col("username").isNotNull() & F.col("_us").isNotNull()
    failed = valid & (F.col("is_failed_login") == 1)
    success = valid & (F.col("is_successful_login") == 1) if correlated else F.lit(False)

    def mark(shift, us, change, copy):
        return F.struct(F.lit(shift).alias("shift"), us.alias("us"), change.cast("bigint").alias("change"), F.lit(copy).alias("copy"))

    own = mark(0, F.col("_us"), F.coalesce(failed.cast("int"), F.lit(0)), False)
    copies = [mark(s, F.col("_us"), F.coalesce(failed.cast("int"), F.lit(0)), True) for s in range(1, salt + 1)]
    expiry = mark(salt, F.col("_us") + F.lit(width), F.lit(-1), True)
    marks = F.when(failed, F.array(own, *copies, expiry)).when(success, F.array(own, *copies)).otherwise(F.array(own))
    tagged = base.withColumn("_m", F.explode(marks))
    copy = F.col("_m.copy")
    both = tagged.select(
        *[F.col(c) if c in ("username", "log_id") else F.when(~copy, F.col(c)).alias(c) for c in df.columns],
        (F.col("_bucket") + F.col("_m.shift")).alias("_bucket"), F.col("_m.us").alias("_us"), F.col("_m.change").alias("_change"), copy.alias("_copy"),
        *([F.when(success & (F.col("_m.change") >= 0), F.col("_us")).alias("_success_us")] if correlated else []))
    # Rows without a user or time need no neighbours: each is a group of its own.
    row_id = [F.col("log_id")] if "log_id" in both.columns else [F.col(c) for c in df.columns]
    both = both.withColumn("_spread", F.when(F.col("username").isNull() | F.col("_us").isNull(), F.xxhash64(*row_id)).otherwise(F.lit(0)))
    running = Window.partitionBy("username", "_bucket", "_spread").orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    cols = {"failed_last_10min": F.sum("_change").over(running)}
    if correlated:
        cols["_last_success_us"] = F.max("_success_us").over(running)
    if cfg.window_ties == "row":
        # Rows of equal time count only up to themselves (order by log_id):
        # take away the failures among later peers.
        peers = Window.partitionBy("username", "_bucket", "_spread", "_us")
        own_fail = F.when(~F.col("_copy"), F.col("_change")).otherwise(0)
        cols["_later_peer_fails"] = F.sum(own_fail).over(peers) - F.sum(own_fail).over(
            peers.orderBy(F.col("_copy").cast("int"), "log_id").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumns(cols).where(~F.col("_copy"))
    if cfg.window_ties == "row":
        out = out.withColumn("failed_last_10min", F.col("failed_last_10min") - F.col("_later_peer_fails")).drop("_later_peer_fails")
    valid = F.col("username").isNotNull() & F.col("_us").isNotNull()
    out = out.withColumn("failed_last_10min",
                         F.when(valid, F.col("failed_last_10min")).otherwise(F.lit(0)).cast("bigint"))
    if correlated:
        reach = min(cfg.priv_esc_seconds, cfg.window_seconds) * MICROS_PER_SECOND
        recent = F.coalesce(F.col("_us") - F.col("_last_success_us") < reach, F.lit(False))
        out = out.withColumn("recent_success", F.when(valid, recent).otherwise(F.lit(False)).cast("int")) \
            .drop("_last_success_us", "_success_us")
    return out.drop("_us", "_bucket", "_copy", "_spread", "_change")


def subnet_index(df: DataFrame) -> DataFrame:
    """Sorted distinct subnets → 0..n-1 (label encoding)."""
    return dense_index(df, "ip_subnet", "ip_subnet_enc")


def with_features(df: DataFrame, cfg: DetectionConfig = DEFAULT, scope: tuple = ()) -> DataFrame:
    """Normalised + flagged rows → rows with all behavioural features."""
    df = df.withColumn("ip_subnet", subnet24("source_ip", "N/A"))
    users = user_profile(df, scope)
    ips = ip_profile(df, scope)
    subnets = subnet_index(df)
    return attach(with_failed_window(df, cfg), users, ips, subnets, scope)


def attach(rows: DataFrame, users: DataFrame, ips: DataFrame, subnets: DataFrame | None, scope: tuple = ()) -> DataFrame:
    """Rows with the profiles of their user and address, and the number of their subnet (0 without ``subnets``)."""
    # Null users never match; giving them distinct never-matching keys keeps
    # them from hashing into one partition if the join falls back to
    # sort-merge (no user name starts with NUL).
    row_id = [F.col("log_id")] if "log_id" in rows.columns else [F.col(c) for c in rows.columns if c != "failed_last_10min"]
    ukey = F.coalesce(F.col("username"), F.concat(F.lit("\u0000"), F.xxhash64(*row_id).cast("string")))
    out = (rows.withColumn("_ukey", ukey)
           .join(users.withColumnRenamed("username", "_ukey"), [*scope, "_ukey"], "left").drop("_ukey")
           .join(ips, [*scope, "source_ip"], "left"))
    out = out.withColumn("ip_subnet_enc", F.lit(0)) if subnets is None else out.join(subnets, "ip_subnet", "left")
    fills = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in (*USER_FEATURES, *IP_FEATURES)}
    fills["hour_deviation"] = F.coalesce(F.abs(F.col("login_hour") - F.col("user_avg_hour")), F.lit(0.0))
    fills["ip_subnet_enc"] = F.coalesce(F.col("ip_subnet_enc"), F.lit(0))
    return out.withColumns(fills).drop("user_avg_hour")
