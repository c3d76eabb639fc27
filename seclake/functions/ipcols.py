"""IP address column functions (P5–P8) as built-in expressions.

The two collector profiles clean addresses differently; both are kept so
rows from either agent come out exactly as that agent would write them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LOOPBACK

# Address shapes recognised by the collectors.
IPV4_SHAPE = r"^\d{1,3}(\.\d{1,3}){3}$"
IPV6_LIKE = r"^([0-9a-fA-F]{0,4}:){2,}[0-9a-fA-F]{0,4}$"
DC_LOOPBACK_FORMS = ("-", "", "::1", "0.0.0.0", "::")
CLIENT_LOOPBACK_FORMS = ("-", "", "::1", "0.0.0.0", "::", "0:0:0:0:0:0:0:1")
CLIENT_IPV4 = r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"
# The client agent's IPv6 expression. It is applied with a start anchor
# only; the trailing "$" belongs to the last alternative alone, so a
# mapped "::ffff:a.b.c.d" or a scoped "fe80::1%eth0" is accepted as IPv6.
CLIENT_IPV6_ALTERNATIVES = (
    r"([0-9a-fA-F]{1,4}:){7,7}[0-9a-fA-F]{1,4}|([0-9a-fA-F]{1,4}:){1,7}:|"
    r"([0-9a-fA-F]{1,4}:){1,6}:[0-9a-fA-F]{1,4}|([0-9a-fA-F]{1,4}:){1,5}(:[0-9a-fA-F]{1,4}){1,2}|"
    r"([0-9a-fA-F]{1,4}:){1,4}(:[0-9a-fA-F]{1,4}){1,3}|([0-9a-fA-F]{1,4}:){1,3}(:[0-9a-fA-F]{1,4}){1,4}|"
    r"([0-9a-fA-F]{1,4}:){1,2}(:[0-9a-fA-F]{1,4}){1,5}|[0-9a-fA-F]{1,4}:((:[0-9a-fA-F]{1,4}){1,6})|"
    r":((:[0-9a-fA-F]{1,4}){1,7}|:)|fe80:(:[0-9a-fA-F]{0,4}){0,4}%[0-9a-zA-Z]{1,}|"
    r"::(ffff(:0{1,4}){0,1}:){0,1}((25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])\.){3,3}(25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])|"
    r"([0-9a-fA-F]{1,4}:){1,4}:((25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])\.){3,3}(25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])$"
)
CLIENT_IPV6 = "^(?:" + CLIENT_IPV6_ALTERNATIVES + ")"
MAPPED_PREFIX = "::ffff:"

_WS = r"(?U)^\s+|\s+$"  # all Unicode white space


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x: Column | str) -> Column:
    """Python-style ``str.strip()`` (all white space, both ends)."""
    return F.regexp_replace(_c(x), _WS, "")


def looks_like_ip(x: Column | str) -> Column:
    """IPv4 shape (octets unchecked) after an optional ``::ffff:``, or IPv6-like."""
    return looks_like_stripped_ip(strip_ws(_c(x)))


def looks_like_stripped_ip(s: Column) -> Column:
    """P7 of a text without white space at its ends. As in the other functions of stripped texts, ``s`` stands here several times: give a column."""
    unmapped = F.when(F.lower(s).startswith(MAPPED_PREFIX), F.substring(s, 8, 1 << 30)).otherwise(s)
    return F.coalesce((unmapped.rlike(IPV4_SHAPE) | s.rlike(IPV6_LIKE)) & (s != ""), F.lit(False))


def sanitize_ip_dc(x: Column | str) -> Column:
    """P5: domain-controller profile."""
    return sanitize_stripped_dc(strip_ws(_c(x)))


def sanitize_stripped_dc(s: Column) -> Column:
    return (
        F.when(s.isNull(), F.lit(LOOPBACK))
        .when(s.isin(*DC_LOOPBACK_FORMS), F.lit(LOOPBACK))
        .when(F.lower(s).startswith(MAPPED_PREFIX), F.substring(s, 8, 1 << 30))
        .when(s.rlike(IPV4_SHAPE), s)
        .when(s.startswith("::") | (s == "0:0:0:0:0:0:0:1"), F.lit(LOOPBACK))
        .when(F.length(s) > 1, s)
        .otherwise(F.lit(LOOPBACK))
    )


def sanitize_ip_client(x: Column | str, unify_mapped: bool = False) -> Column:
    """Workstation profile. ``unify_mapped`` also strips ``::ffff:`` so
    both profiles produce one form for IPv4-mapped addresses."""
    s = strip_ws(_c(x))
    if unify_mapped:
        s = F.when(F.lower(s).startswith(MAPPED_PREFIX) & F.substring(s, 8, 1 << 30).rlike(CLIENT_IPV4),
                   F.substring(s, 8, 1 << 30)).otherwise(s)
    return sanitize_stripped_client(s)


def sanitize_stripped_client(s: Column) -> Column:
    return (
        F.when(s.isNull(), F.lit(LOOPBACK))
        .when(s.isin(*CLIENT_LOOPBACK_FORMS), F.lit(LOOPBACK))
        .when(s.rlike(CLIENT_IPV4), s)
        .when(s.rlike(CLIENT_IPV6) & s.startswith("fe80"), F.lit(LOOPBACK))
        .when(s.rlike(CLIENT_IPV6), s)
        .otherwise(F.lit(LOOPBACK))
    )


def first_ip_in(arr: Column | str) -> Column:
    """First element that looks like an IP, DC-sanitised; else loopback."""
    return first_stripped_ip_in(F.transform(_c(arr), strip_ws))


def first_stripped_ip_in(arr: Column) -> Column:
    return F.coalesce(F.get(F.transform(F.slice(F.filter(arr, lambda e: e.isNotNull() & looks_like_stripped_ip(e)), 1, 1), sanitize_stripped_dc), 0), F.lit(LOOPBACK))


def subnet24(ip: Column | str, unknown: str = "N/A") -> Column:
    """``a.b.c`` of a dotted address, else ``unknown``."""
    sub = F.regexp_extract(_c(ip), r"^(\d+\.\d+\.\d+)\.", 1)
    return F.when(sub == "", F.lit(unknown)).otherwise(sub)
