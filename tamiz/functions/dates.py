"""Date functions on columns; unparsable values are null, never errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import squeeze
from tamiz.plans import vocabulary as V


def parse_date(text: Column, default: Column | None = None) -> Column:
    """Day/month/year with slashes or dots, ISO dates with or without a time, or 'D de MES de AAAA' anywhere."""
    raw = F.replace(F.lower(squeeze(text)), F.lit(","), F.lit(""))
    found = [F.try_to_date(F.when(raw.rlike(p), raw), f) for p, f in ((r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"))]
    stamped = F.when(raw.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"), F.regexp_extract(raw, r"^\S+", 0))
    found.append(F.try_to_date(stamped, "yyyy-M-d"))
    spoken = rf"(\d{{1,2}})\s+de\s+({'|'.join(V.MONTHS)})\s+de\s+(\d{{4}})"
    month = F.array_position(F.array(*map(F.lit, V.MONTHS)), F.regexp_extract(raw, spoken, 2))
    iso = F.when(month > 0, F.concat_ws("-", F.regexp_extract(raw, spoken, 3), month.cast("string"), F.regexp_extract(raw, spoken, 1)))
    found.append(F.try_to_date(iso, "yyyy-M-d"))
    return F.coalesce(*found, *([default] if default is not None else []))


def edition_date(stamp: Column, zone: str = "America/Mexico_City", now: Column | None = None) -> Column:
    """The local day of an ISO time stamp: one without an offset keeps its own day; an unreadable one is ``now``'s."""
    aware = stamp.rlike(r"([Zz]|[+-]\d{2}:?\d{2})$") & stamp.contains("T")
    local = F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(F.try_to_timestamp(F.when(aware, stamp)), F.current_timezone()), zone))
    naive = F.try_to_date(F.substring(stamp, 1, 10), "yyyy-MM-dd")
    today = F.to_date(F.from_utc_timestamp(now if now is not None else F.current_timestamp(), zone))
    return F.coalesce(F.when(aware, local).otherwise(naive), today)


def feed_date(text: Column) -> Column:
    """The day of an RFC 2822 date in its own offset."""
    return F.try_to_date(F.regexp_extract(F.coalesce(text, F.lit("")), r"(\d{1,2} [A-Za-z]{3} \d{4})", 1), "d MMM yyyy")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def month_grid(day: Column) -> Column:
    """For the day's month: days, blanks before its first day in weeks from Monday, and blanks after its last."""
    first = F.trunc(day, "month")
    days = F.dayofmonth(F.last_day(day))
    lead = F.weekday(first)
    return F.struct(days.alias("days"), lead.alias("lead"), F.pmod(-(lead + days), F.lit(7)).alias("trail"))
