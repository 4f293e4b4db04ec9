"""Platform date strings, unix seconds and ISO strings.

Parsing never guesses: a string that does not fit the supported shapes gives
null.  The time zone is an explicit argument (the reference used whatever zone
its process ran in).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dom import bind
from .text import JS_WS_CLASS, _c

# German month names mapped to English, in this order, each
# matched as a whole word, case-insensitively.
GERMAN_MONTHS = [
    ("januar", "January"), ("februar", "February"), ("märz", "March"), ("april", "April"),
    ("mai", "May"), ("juni", "June"), ("juli", "July"), ("august", "August"),
    ("september", "September"), ("oktober", "October"), ("november", "November"), ("dezember", "December"),
    ("jan", "Jan"), ("feb", "Feb"), ("mär", "Mar"), ("apr", "Apr"),
    ("jun", "Jun"), ("jul", "Jul"), ("aug", "Aug"), ("sep", "Sep"), ("okt", "Oct"), ("nov", "Nov"), ("dez", "Dec"),
]
ENGLISH_MONTHS = [
    ("january", 1), ("february", 2), ("march", 3), ("april", 4), ("may", 5), ("june", 6),
    ("july", 7), ("august", 8), ("september", 9), ("october", 10), ("november", 11), ("december", 12),
    ("jan", 1), ("feb", 2), ("mar", 3), ("apr", 4), ("jun", 6), ("jul", 7), ("aug", 8), ("sep", 9),
    ("oct", 10), ("nov", 11), ("dec", 12),
]

_WS = "[" + JS_WS_CLASS + "]"
_MONTH = r"(\p{L}{3,9})\.?"
_TIME = r"(?:," + _WS + r"*|" + _WS + r"+)(\d{1,2}):(\d{2})(?::(\d{2}))?(?:" + _WS + r"*([AaPp][Mm]))?"
_ZONE = r"(?:" + _WS + r"*(GMT|UTC|UT|Z|[+-]\d{2}:?\d{2}))?"
# "1 April 2026[, 12:20 PM]"  and  "April 1, 2026[, 12:20 PM]", each with an optional zone as in mail headers
DMY_RE = r"^(\d{1,2})\.?" + _WS + r"+" + _MONTH + _WS + r"+(\d{4})(?:" + _TIME + _ZONE + r")?" + _WS + r"*$"
MDY_RE = r"^" + _MONTH + _WS + r"+(\d{1,2})," + _WS + r"*(\d{4})(?:" + _TIME + _ZONE + r")?" + _WS + r"*$"
# "2026-04-01" (midnight UTC) and "2026-04-01T12:20[:00[.0]][zone]"
ISO_DAY_RE = r"^\d{4}-\d{2}-\d{2}$"
ISO_LOCAL_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
ISO_ZONE_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"
WEEKDAY_RE = r"^[^\d,]*\p{L}+\.?," + _WS + r"*"


def _month_lookup() -> Column:
    """Lower-case month word (German or English, full or short) -> month number."""
    pairs: dict[str, int] = dict(ENGLISH_MONTHS)
    for de, en in GERMAN_MONTHS:
        pairs[de] = pairs[en.lower()]
    args = []
    for k, v in pairs.items():
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


SEP = "\u0001"


def parse_lms_date(x, tz: str = "Europe/Berlin") -> Column:
    """F8: a display date ('Mittwoch, 1. April 2026, 12:20' or 'Wednesday, 1 April
    2026, 12:20 PM') -> TIMESTAMP, the wall time read in ``tz`` unless the text
    names a zone; ISO 8601 and mail-header dates too; null if invalid.

    Two ``regexp_replace`` calls rewrite either shape into eight fields
    (day, month word, year, hour, minute, second, am/pm, zone) joined by a control
    character; a literal map turns the month word (German or English) into its
    number.  The split fields are bound once and read by position."""
    return bind(F.trim(_c(x)), lambda v: _parsed_date(v, tz))


def _parsed_date(iso: Column, tz: str) -> Column:
    s = F.regexp_replace(iso, WEEKDAY_RE, "")
    canon = F.regexp_replace(s, DMY_RE, SEP.join(f"${i}" for i in range(1, 9)))
    canon = F.regexp_replace(canon, MDY_RE, SEP.join(f"${i}" for i in (2, 1, 3, 4, 5, 6, 7, 8)))
    months = _month_lookup()

    def build(p):
        day, mon, year, hh, mm, ss, ampm, zone = [F.get(p, i) for i in range(8)]
        h = F.coalesce(F.nullif(hh, F.lit("")).try_cast("int"), F.lit(0))
        ap = F.upper(ampm)
        h24 = F.when(ap == "PM", F.when(h < 12, h + 12).when(h == 12, h).otherwise(F.lit(99))).when(
            ap == "AM", F.when(h == 12, F.lit(0)).when(h < 12, h).otherwise(F.lit(99))
        ).otherwise(h)
        ts = F.try_make_timestamp(
            year.try_cast("int"), months[F.lower(mon)], day.try_cast("int"), h24,
            F.coalesce(F.nullif(mm, F.lit("")).try_cast("int"), F.lit(0)),
            F.coalesce(F.nullif(ss, F.lit("")).try_cast("int"), F.lit(0)).cast("decimal(16,6)"),
            F.when(zone == "", F.lit(tz)).when(zone.rlike("^[A-Z]"), F.lit("UTC")).otherwise(F.regexp_replace(zone, r"^(.\d\d):?", "$1:")),
        )
        return F.when(F.size(p) == 8, ts)

    iso_text = (
        F.when(iso.rlike(ISO_DAY_RE), F.concat(iso, F.lit("T00:00:00Z")))
        .when(iso.rlike(ISO_LOCAL_RE), F.concat(iso, F.when(F.length(iso) == 16, F.lit(":00")).otherwise(F.lit("")), F.lit(" " + tz)))
        .when(iso.rlike(ISO_ZONE_RE), F.regexp_replace(iso, r"([+-]\d{2}):?(\d{2})$", "$1:$2"))
    )
    return F.coalesce(bind(F.split(canon, SEP), build), iso_text.try_cast("timestamp"))


def lms_date_unix(x, tz: str = "Europe/Berlin") -> Column:
    return F.unix_seconds(parse_lms_date(x, tz))


def unix_guard(x) -> Column:
    """F9 guard: non-finite or <= 0 -> null; else whole seconds."""
    return bind(_c(x).cast("double"), lambda v: F.when(~F.isnan(v) & (v > 0) & (v < 1e15), F.floor(v).cast("bigint")))


def unix_to_iso(x) -> Column:
    """seconds -> 'YYYY-MM-DDTHH:MM:SS.sssZ' in UTC, independent of the session zone."""
    def iso(secs):
        ts = F.to_utc_timestamp(F.timestamp_seconds(secs), F.current_timezone())
        return F.when(secs.isNotNull(), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))

    return bind(unix_guard(x), iso)


def ymd_to_unix(y, m, d) -> Column:
    """UTC midnight of year/month/day attributes; an impossible date -> null."""
    ts = F.try_make_timestamp(
        F.nullif(_c(y), F.lit("")).try_cast("int"), F.nullif(_c(m), F.lit("")).try_cast("int"),
        F.nullif(_c(d), F.lit("")).try_cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"), F.lit("UTC"),
    )
    return F.unix_seconds(ts)


def ntz_to_unix(ts) -> Column:
    """Seconds since the epoch for a TIMESTAMP_NTZ read as UTC wall time."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))
