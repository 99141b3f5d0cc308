"""Release dates: relative, ordinal and absolute texts. `now` is always given.

What lies outside the years 1 to 9999 is null, however large the number in a text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds of a unit where months have 30 and years 365 days.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}
RELATIVE = r"(?i)(\d+)\s*(second|minute|hour|day|week|month|year)s?\s*ago"
FORMATS = ("MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy", "d MMMM yyyy", "yyyy/MM/dd", "MM/dd/yyyy")
#: Microseconds of the first and the last instant that a date can be.
FIRST, LAST = -62_135_596_800_000_000, 253_402_300_799_999_999
MOST_MONTHS = 9999 * 12


def _parts(t: Column) -> tuple[Column, Column]:
    return F.nullif(F.regexp_extract(t, RELATIVE, 1), F.lit("")).try_cast("bigint"), F.lower(F.regexp_extract(t, RELATIVE, 2))


def _instant(micros: Column) -> Column:
    return F.timestamp_micros(F.when(micros.between(FIRST, LAST), micros)).cast("timestamp_ntz")


def _minus(now: Column, value: Column, seconds: Column) -> Column:
    """now less value times seconds."""
    return _instant(F.try_subtract(F.unix_micros(now.cast("timestamp")), F.try_multiply(value, seconds.cast("bigint") * 1_000_000)))


def absolute(t: Column) -> Column:
    """An ISO instant, a date, or one of FORMATS, with ordinals allowed; null if it is none."""
    plain = F.regexp_replace(F.trim(t), r"(\d+)(st|nd|rd|th)", "$1")
    tries = [F.try_to_timestamp(plain, F.lit(f)) for f in FORMATS]
    return F.coalesce(plain.try_cast("timestamp"), *tries).cast("timestamp_ntz")


def fixed_units(t: Column, now: Column) -> Column:
    """`2 days ago` in fixed units, else an absolute date."""
    value, unit = _parts(t)
    seconds = F.create_map(*[F.lit(x) for kv in UNIT_SECONDS.items() for x in kv])[unit]
    return F.when(value.isNotNull(), _minus(now, value, seconds)).otherwise(absolute(t))


def months_back(now: Column, months: Column) -> Column:
    """The same day and time of an earlier month; a day that month lacks runs over into the next (31 March less one month is 3 March, or 2)."""
    first = F.date_trunc("month", now)
    into = now.cast("timestamp").cast("double") - first.cast("timestamp").cast("double")
    base = F.add_months(first.cast("date"), -F.when(months <= MOST_MONTHS, months).cast("int")).cast("timestamp")
    return _instant(F.unix_micros(base) + F.round(into * 1_000_000).cast("bigint"))


def calendar_units(t: Column, now: Column) -> Column:
    """`2 months ago` by the calendar, else an absolute date."""
    value, unit = _parts(t)
    seconds = F.create_map(*[F.lit(x) for kv in UNIT_SECONDS.items() if kv[0] not in ("month", "year") for x in kv])[unit]
    by_month = unit.isin("month", "year") & value.isNotNull()
    months = F.when(unit == "month", value).when(unit == "year", F.try_multiply(value, F.lit(12)))
    return F.when(by_month, months_back(now, months)).when(value.isNotNull(), _minus(now, value, seconds)).otherwise(absolute(t))


def attribute_or_text(attribute: Column, t: Column, now: Column) -> Column:
    """A datetime attribute; only without one the text. An attribute that can't be read is null."""
    return F.when(F.coalesce(attribute, F.lit("")) != "", attribute.try_cast("timestamp").cast("timestamp_ntz")).otherwise(calendar_units(t, now))
