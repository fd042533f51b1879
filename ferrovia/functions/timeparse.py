"""Date, timestamp and service-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES — snapshot stamp formats: compact ``yyyyMMdd'T'HHmmss'Z'`` (poller
# file names) and ISO ``yyyy-MM-dd'T'HH:mm:ss'Z'``.
COMPACT_STAMP_RE = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z$"
COMPACT_TO_ISO = "$1-$2-$3T$4:$5:$6Z"
STAMP_IN_NAME = r"(\d{8}T\d{6}Z)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_snapshot_ts(stamp) -> Column:
    """Compact ``20250101T083500Z`` or ISO ``2025-01-01T08:35:00Z`` -> timestamp.

    Anything else gives NULL (never an error, also under ANSI mode).  The
    compact form is rewritten to ISO by a regex and both go through one
    ``try_cast`` — no per-row formatter and no exception path for the form
    that does not match, which a pattern-based ``try_to_timestamp`` pays.
    """
    iso = F.regexp_replace(_col(stamp), COMPACT_STAMP_RE, COMPACT_TO_ISO)
    return iso.try_cast("timestamp")


def date_key(d) -> Column:
    """YYYYMMDD integer surrogate key of a date or timestamp (arithmetic only, no
    per-row formatter)."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(k) -> Column:
    return F.to_date(_col(k).cast("string"), "yyyyMMdd")


def service_time_part(t, part: int) -> Column:
    """Integer field of a ``H:MM:SS`` service time (hours may exceed 23).

    Service times are not timestamps; malformed parts give NULL.
    """
    return F.split_part(_col(t), F.lit(":"), F.lit(part)).try_cast("int")


def trimmed_length(s) -> Column:
    """Length ignoring trailing blanks."""
    return F.length(F.rtrim(_col(s)))


def iso_day_of_week(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_col(d)) + 1


def is_weekend(d) -> Column:
    return F.dayofweek(_col(d)).isin(1, 7)


def week_start_sunday(d) -> Column:
    """Sunday on or before the date."""
    return F.date_add(_col(d), F.lit(1) - F.dayofweek(_col(d)))


def week_label(week_start) -> Column:
    """``YYYY-Www``: year of the Sunday week start, ISO week of its Monday.

    One label per Sunday-start week (the ISO week that Monday..Saturday share).
    """
    ws = _col(week_start)
    return F.concat(F.year(ws).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(F.date_add(ws, 1)).cast("string"), 2, "0"))


def stamp_from_file_name(name) -> Column:
    return F.regexp_extract(_col(name), STAMP_IN_NAME, 1)
