"""Date and time normalisers (N9–N11, N26–N30, N35) as Column expressions.

The session zone is UTC; local (Sao Paulo) values are derived with
``from_utc_timestamp`` so that daylight saving before 2019 is honoured.
Timestamps may arrive as ``timestamp_ntz``: they are read as UTC wall time.
Nothing here reads the clock: "now" is always a parameter (``as_of``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolens.functions.parse import ws_trim

SAO_PAULO = "America/Sao_Paulo"
YMD_RE = r"^\d{4}-\d{2}-\d{2}$"
HMS_RE = r"^\d{2}:\d{2}:\d{2}$"


def as_utc_timestamp(c: Column) -> Column:
    """A ``timestamp`` (instant) from a timestamp/timestamp_ntz/string column."""
    return c.cast("timestamp")


def local_ts(c: Column, zone: str = SAO_PAULO) -> Column:
    return F.from_utc_timestamp(as_utc_timestamp(c), zone)


def local_date(c: Column, zone: str = SAO_PAULO) -> Column:
    """Calendar day of an instant in ``zone``."""
    return F.to_date(local_ts(c, zone))


def brazil_date(c: Column, zone: str = SAO_PAULO) -> Column:
    """``YYYY-MM-DD`` of the instant in Sao Paulo."""
    return F.date_format(local_ts(c, zone), "yyyy-MM-dd")


def brazil_time(c: Column, zone: str = SAO_PAULO) -> Column:
    """``HH:mm:ss`` (24 h) of the instant in Sao Paulo."""
    return F.date_format(local_ts(c, zone), "HH:mm:ss")


def parse_ymd(c: Column) -> Column:
    """The first 10 characters when they are ``YYYY-MM-DD``-shaped."""
    s = ws_trim(c)
    ymd = F.when(F.length(s) >= 10, F.substring(s, 1, 10)).otherwise(s)
    return F.when((s != "") & ymd.rlike(YMD_RE), ymd)


def parse_timestamp(c: Column) -> Column:
    """Any ISO-8601 instant (date, date-time, optional fraction and
    offset; no offset = UTC), else null. The text must begin with its year:
    a bare time is no instant."""
    s = ws_trim(c)
    return F.when(s.rlike(r"^[+-]?\d{4}"), s.try_cast("timestamp"))


def parse_date_only_loose(c: Column) -> Column:
    """N9, else the UTC day of N10 (as ``YYYY-MM-DD`` text)."""
    return F.coalesce(parse_ymd(c), F.date_format(parse_timestamp(c), "yyyy-MM-dd"))


def short_offset_timestamp(c: Column) -> Column:
    """``2026-03-19 07:58:27-03`` (offset hours, optional ``:MM``); any
    other text falls back to N10 after its first space becomes ``T``."""
    s = ws_trim(c)
    pat = r"^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}[+-]\d{2}(:\d{2})?$"
    one_space = F.regexp_replace(s, r"\s+", " ")
    direct = F.coalesce(F.try_to_timestamp(one_space, F.lit("yyyy-MM-dd HH:mm:ssx")),
                        F.try_to_timestamp(one_space, F.lit("yyyy-MM-dd HH:mm:ssxxx")))
    fallback = parse_timestamp(F.regexp_replace(s, r"^([^ ]*) ", "$1T"))
    return F.when(s.rlike(pat), direct).otherwise(fallback)


def local_datetime_fixed_offset(date_col: Column, time_col: Column, offset: str = "-03:00") -> Column:
    """Local date + time at a fixed offset; a bad time is midnight."""
    d = ws_trim(date_col)
    t = F.coalesce(ws_trim(time_col), F.lit(""))
    t = F.when(t.rlike(r"^\d{2}:\d{2}(:\d{2})?$"), t).otherwise(F.lit("00:00:00"))
    t = F.when(F.length(t) == 5, F.concat(t, F.lit(":00"))).otherwise(t)
    iso = F.concat(d, F.lit("T"), t, F.lit(offset))
    return F.when(d.rlike(YMD_RE), F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


def _valid_hms(t: Column) -> Column:
    return t.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$")


def date_hour_lenient(date_col: Column, time_col: Column, zone: str = SAO_PAULO) -> Column:
    """N29 (marketplace rule): date + HH:mm:ss local time; a bad hour gives
    the date at midnight."""
    d = F.coalesce(date_col.cast("string"), F.lit(""))
    t = F.coalesce(ws_trim(time_col), F.lit(""))
    t = F.when(_valid_hms(t), t).otherwise(F.lit("00:00:00"))
    wall = F.try_to_timestamp(F.concat(d, F.lit(" "), t), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(d.rlike(YMD_RE), F.to_utc_timestamp(wall, zone))


def date_hour_strict(date_col: Column, time_col: Column, zone: str = SAO_PAULO) -> Column:
    """N29 (store rule): as above, but a bad hour gives null."""
    d = F.coalesce(date_col.cast("string"), F.lit(""))
    t = F.coalesce(ws_trim(time_col), F.lit(""))
    wall = F.try_to_timestamp(F.concat(d, F.lit(" "), t), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(d.rlike(YMD_RE) & _valid_hms(t), F.to_utc_timestamp(wall, zone))


def zero_date_repair(c: Column, as_of_year: int) -> Column:
    """``0000-00-00`` → null; year 0000 → ``as_of_year``; month 1–12 and
    day 1–31 required. Returns ``YYYY-MM-DD`` text."""
    s = ws_trim(c)
    part = F.when(F.length(s) >= 10, F.substring(s, 1, 10)).otherwise(s)
    y = F.substring(part, 1, 4)
    m = F.substring(part, 6, 2).try_cast("int")
    d = F.substring(part, 9, 2).try_cast("int")
    ok = part.rlike(YMD_RE) & m.between(1, 12) & d.between(1, 31)
    fixed = F.when(y == "0000", F.concat(F.lit(f"{as_of_year:04d}"), F.substring(part, 5, 6))).otherwise(part)
    return F.when((s != "") & ~s.isin("0000-00-00", "0000-00-00 00:00:00") & ok, fixed)


def _ymd_date(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(YMD_RE), F.try_to_date(s, "yyyy-MM-dd"))


def days_between(start: Column, end: Column) -> Column:
    """Whole calendar days end − start between two ``YYYY-MM-DD`` values."""
    return F.datediff(_ymd_date(end), _ymd_date(start))


def days_between_non_negative(start: Column, end: Column) -> Column:
    """N35 (store rule): a negative difference is null."""
    d = days_between(start, end)
    return F.when(d >= 0, d)


def round_days(start_ts: Column, end_ts: Column) -> Column:
    """round((end − start) / 1 day), half toward +infinity (not datediff)."""
    us = F.unix_micros(as_utc_timestamp(end_ts)) - F.unix_micros(as_utc_timestamp(start_ts))
    return F.floor(us / 86400e6 + 0.5).cast("bigint")
