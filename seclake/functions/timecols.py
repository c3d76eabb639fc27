"""Time helpers that never depend on the session time zone.

Event times are TIMESTAMP_NTZ (wall clock, as stored by the collectors);
microsecond arithmetic goes through ``timestampdiff``/``timestampadd``
so a cluster in any zone computes the same buckets and windows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ (or TIMESTAMP) column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c.cast("timestamp_ntz"))


def from_micros(us: Column | str) -> Column:
    """TIMESTAMP_NTZ from microseconds since the epoch."""
    c = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", c, F.expr(EPOCH_NTZ))


_TIME = r"(?:[T\s]+(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"
ISO_TIME = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})" + _TIME
US_TIME = r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME
C_TIME = r"^[A-Za-z]{3}\s+([A-Za-z]{3})\s+(\d{1,2})\s+(\d{1,2}):(\d{2}):(\d{2})\s+(\d{4})$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
#: The two forms that collectors write, in full width: the first is cast as it stands, the second is cut by places.
ISO_FULL = r"\A\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?\z"
C_FULL = r"\A[A-Za-z]{3} [A-Za-z]{3} \d{2} \d{2}:\d{2}:\d{2} \d{4}\z"


def parse_mixed_timestamp(s: Column | str) -> Column:
    """Text → TIMESTAMP_NTZ; unparseable → null.

    Accepts ISO-like forms (date alone, or with ``T`` or blanks a time with
    or without seconds and up to nine decimals, which are cut to six),
    the same with slashes, the month-first ``01/15/2024``, and the ctime form
    ``Mon Jan 15 08:00:00 2024`` (its weekday is not checked). A time with ``Z`` or an
    offset is converted to UTC. The parts become one canonical text, which
    is cast without any session time zone. Texts in one of the two forms in full
    width skip the trimming and the search for parts, which cost many regular expressions a row.
    """
    c = F.col(s) if isinstance(s, str) else s
    whole = c.cast("string")
    place = F.instr(F.lit(MONTHS), F.lower(F.substring(whole, 5, 3)))
    full = F.concat(F.substring(whole, 21, 4), F.lit("-"), F.lpad(((place + 2) / 3).cast("int").cast("string"), 2, "0"), F.lit("-"), F.substring(whole, 9, 2), F.lit(" "), F.substring(whole, 12, 8))
    return (F.when(whole.rlike(ISO_FULL), whole.try_cast("timestamp_ntz")).when(whole.rlike(C_FULL), F.when(place % 3 == 1, full.try_cast("timestamp_ntz")))
            .otherwise(parse_any_timestamp(c)))


def parse_any_timestamp(c: Column) -> Column:
    """``parse_mixed_timestamp`` for every form, by the parts that patterns find."""
    t = F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")

    def build(pattern: str, date: tuple[int, int, int]) -> Column:
        part = lambda k: F.regexp_extract(t, pattern, k)
        two = lambda x: F.lpad(x, 2, "0")
        or_zero = lambda x: F.when(x == "", "00").otherwise(two(x))
        text = F.concat(part(date[0]), F.lit("-"), two(part(date[1])), F.lit("-"), two(part(date[2])), F.lit(" "),
                        or_zero(part(4)), F.lit(":"), or_zero(part(5)), F.lit(":"), or_zero(part(6)), F.lit("."), F.rpad(F.substring(part(7), 1, 6), 6, "0"))
        zone = part(8)
        minutes = (F.when(zone.rlike("^[+-]"), F.concat(F.substring(zone, 1, 1), F.lit("1")).cast("int")
                          * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(F.regexp_replace(zone, ":", ""), 4, 2).cast("int")))
                   .otherwise(0))
        return F.when(t.rlike(pattern), F.timestamp_add("MINUTE", -minutes, text.try_cast("timestamp_ntz")))

    c_part = lambda k: F.regexp_extract(t, C_TIME, k)
    month = F.instr(F.lit(MONTHS), F.lower(c_part(1)))
    c_text = F.concat(c_part(6), F.lit("-"), F.lpad(((month + 2) / 3).cast("int").cast("string"), 2, "0"), F.lit("-"), F.lpad(c_part(2), 2, "0"),
                      F.lit(" "), F.lpad(c_part(3), 2, "0"), F.lit(":"), c_part(4), F.lit(":"), c_part(5))
    ctime = F.when(t.rlike(C_TIME) & (month % 3 == 1), c_text.try_cast("timestamp_ntz"))
    return F.coalesce(build(ISO_TIME, (1, 2, 3)), build(US_TIME, (3, 1, 2)), ctime)


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a Python datetime or text, built from
    its text so neither the Python process zone nor the session zone moves it."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")
