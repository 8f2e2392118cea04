"""Timestamps as text and back. The session time zone is UTC (see session.py)."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)

OFFSET_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
NAIVE_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
PLAIN_DATE = r"^\d{4}-\d{2}-\d{2}$"
# ISO 8601: calendar and week dates; hours, with minutes, with seconds, with a fraction; each in
# the extended form with its marks or in the basic form without.
ISO_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?"
_CLOCK = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
ISO_TIMESTAMP = rf"^({ISO_DATE})[T ]({_CLOCK})(Z|[+-](?:{_CLOCK}))?$"


def moment(value: datetime) -> Column:
    """A literal timestamp. ``F.lit`` would read a naive one in the local zone."""
    aware = value if value.tzinfo is not None else value.replace(tzinfo=UTC)
    return F.timestamp_micros(F.lit((aware - _EPOCH) // timedelta(microseconds=1)))


def from_micros(micros: int | None) -> datetime | None:
    """``unix_micros`` of a collected row as an aware datetime."""
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def _iso(moment: Column) -> Column:
    fraction = F.pmod(F.unix_micros(moment), F.lit(1_000_000))
    return F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == 0, F.lit("")).otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
        ),
    )


def iso_z(moment: Column) -> Column:
    """2026-01-01T12:00:00Z, with six fractional digits where there are any."""
    return F.concat(_iso(moment), F.lit("Z"))


def iso_offset(moment: Column) -> Column:
    """2026-01-01T12:00:00+00:00."""
    return F.concat(_iso(moment), F.lit("+00:00"))


def parse_offset_timestamp(text: Column) -> Column:
    """A timestamp that names its offset, else null."""
    return F.when(text.rlike(OFFSET_TIMESTAMP), text.try_cast("timestamp"))


def _day(text: Column) -> Column:
    """The day a text in the form of ``ISO_DATE`` names; null if there is no such day."""
    plain = F.replace(text, F.lit("-"), F.lit(""))
    year = F.substring(plain, 1, 4)
    calendar = F.concat_ws("-", year, F.substring(plain, 5, 2), F.substring(plain, 7, 2)).try_cast("date")
    # The first week has January 4 in it; a week without a day starts with its Monday.
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    week = F.substring(plain, 6, 2).try_cast("int")
    day = F.coalesce(F.nullif(F.substring(plain, 8, 1), F.lit("")), F.lit("1")).try_cast("int")
    of_week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7 + day - 1)
    exists = (week >= 1) & day.between(1, 7) & (F.extract(F.lit("YEAROFWEEK"), of_week) == year.try_cast("int"))
    found = F.when(F.contains(text, F.lit("W")), F.when(exists, of_week)).otherwise(calendar)
    return F.when(year != "0000", found)


def _clock(text: Column) -> Column:
    """Microseconds of a text in the form of ``_CLOCK``; null past 23:59:59. More than six
    digits of a fraction are cut."""
    plain = F.regexp_replace(text, "[:.,]", "")
    part = lambda at: F.coalesce(F.nullif(F.substring(plain, at, 2), F.lit("")), F.lit("0")).try_cast("bigint")
    hour, minute, second = part(1), part(3), part(5)
    fraction = F.rpad(F.substring(plain, 7, 6), 6, "0").try_cast("bigint")
    fits = (hour <= 23) & (minute <= 59) & (second <= 59)
    return F.when(fits, ((hour * 60 + minute) * 60 + second) * 1_000_000 + fraction)


def parse_iso_date(text: Column) -> Column:
    """A calendar or week date in extended or basic form, else null."""
    # The shape comes first: a plain cast also takes 'today', 'now' and '2026'.
    return F.when(text.rlike(f"^(?:{ISO_DATE})$"), _day(text))


def parse_iso_timestamp(text: Column) -> Column:
    """An ISO date and time of day, else null; one without an offset is UTC."""
    day, clock, offset = (F.regexp_extract(text, ISO_TIMESTAMP, i) for i in (1, 2, 3))
    shift = _clock(F.substring(offset, 2, 32))
    shift = F.when(offset.isin("", "Z"), F.lit(0)).when(F.startswith(offset, F.lit("-")), -shift).otherwise(shift)
    start = F.unix_date(_day(day)).cast("bigint") * 86_400_000_000
    return F.when(text.rlike(ISO_TIMESTAMP), F.timestamp_micros(start + _clock(clock) - shift))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)
