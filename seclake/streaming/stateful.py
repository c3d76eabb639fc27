"""Exact trailing-window failure counts on a stream (K5).

Row-frame and range windows are not supported on streams, so state keeps
(a) rows whose time is still above the watermark (earlier rows may still
arrive) and (b) failure times that can still fall inside a later row's
window. A row comes out as soon as the watermark passes its time, with the
count of that user's failures in ``(t - window, t]``: the number that the
batch window gives, whatever the arrival order within the watermark delay.

The state is keyed by a part of the users and a time bucket (one window wide), and a failure is
copied into the next bucket, so that a busy user is many small states
that end with their buckets. Users are dealt to ``PARTS`` parts by a hash: one call
counts for all users of its part at once, since a call costs as much as thousands of rows and most users have
few rows in a window. The timer stands at the *oldest* pending
row, so an idle part's rows come out as well; rows above the final
watermark wait in the checkpointed state for more data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.timecols import micros

OUTPUT_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("log_id", T.LongType()),
    T.StructField("event_us", T.LongType()),
    T.StructField("failed_last_10min", T.LongType()),
])
STATE_SCHEMA = T.StructType([
    T.StructField("pend_user", T.ArrayType(T.StringType())),
    T.StructField("pend_us", T.ArrayType(T.LongType())),
    T.StructField("pend_id", T.ArrayType(T.LongType())),
    T.StructField("fail_user", T.ArrayType(T.StringType())),
    T.StructField("fail_us", T.ArrayType(T.LongType())),
])
#: Parts of the users. A group holds what one part does in a window; a checkpoint goes with its number of parts.
PARTS = 4


def _counts(users: np.ndarray, us: np.ndarray, fail_users: np.ndarray, fail_us: np.ndarray, start_us: int, window_us: int) -> np.ndarray:
    """Per row, the failures of its user in ``(t - window, t]``. ``start_us``: no time and no window begins earlier."""
    codes = pd.factorize(np.concatenate([users, fail_users]))[0].astype(np.int64)
    bits = (2 * window_us).bit_length()  # user above time: one sorted array for all users
    fails = np.sort((codes[len(users):] << bits) + (fail_us - start_us))
    t = (codes[:len(users)] << bits) + (us - start_us)
    return np.searchsorted(fails, t, side="right") - np.searchsorted(fails, t - window_us, side="right")


def _counter(window_us: int):
    def step(key, batches, state):
        bucket = int(key[1])
        kept = state.get if state.exists else ([], [], [], [], [])
        users, p_us, p_id, f_users, f_us = ([np.asarray(x, dtype=kind)] for x, kind in zip(kept, (object, np.int64, np.int64, object, np.int64)))
        for pdf in batches:
            us, who = pdf["event_us"].to_numpy(dtype=np.int64), pdf["username"].to_numpy(dtype=object)
            own, failed = ~pdf["copy"].to_numpy(dtype=bool), pdf["is_failed_login"].to_numpy() == 1
            users.append(who[own])
            p_us.append(us[own])
            p_id.append(pdf["log_id"].to_numpy()[own].astype(np.int64))
            f_users.append(who[failed])
            f_us.append(us[failed])
        users, p_us, p_id, f_users, f_us = (np.concatenate(x) for x in (users, p_us, p_id, f_users, f_us))
        wm_us = state.getCurrentWatermarkMs() * 1000
        ready = p_us <= wm_us
        t, who = p_us[ready], users[ready]
        counts = _counts(who, t, f_users, f_us, (bucket - 1) * window_us, window_us) if t.size else None
        left = p_us[~ready]
        still = f_us > wm_us - window_us  # what a row above the watermark can still count
        end_us = (bucket + 1) * window_us  # no row of this bucket is later
        if left.size or end_us > wm_us:
            state.update((users[~ready].tolist(), left.tolist(), p_id[~ready].tolist(), f_users[still].tolist(), f_us[still].tolist()))
            until_us = int(left.min()) if left.size else end_us
            state.setTimeoutTimestamp(max(until_us // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if t.size:
            yield pd.DataFrame({"username": who, "log_id": p_id[ready], "event_us": t, "failed_last_10min": counts.astype(np.int64)})
    return step


def failed_window_stream(rows: DataFrame, window_seconds: int = 600, parts: int = PARTS) -> DataFrame:
    """``rows``: stream with ``username, log_id, timestamp, is_failed_login``
    and a watermark on ``event_time``. Null users are not keyed (their
    count is 0 by definition) and are left out of this output. ``parts``: more
    of them for streams with millions of rows in a window."""
    width = window_seconds * 1_000_000
    failed = F.col("is_failed_login") == 1
    prepared = (rows.where(F.col("username").isNotNull() & F.col("timestamp").isNotNull())
                .select("username", "log_id", "event_time", micros("timestamp").alias("event_us"), "is_failed_login",
                        F.explode(F.when(failed, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("shift"))
                .withColumns({"bucket": F.floor(F.col("event_us") / width) + F.col("shift"), "copy": F.col("shift") > 0, "part": F.pmod(F.xxhash64("username"), F.lit(parts))}))
    return prepared.groupBy("part", "bucket").applyInPandasWithState(
        _counter(width), OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
