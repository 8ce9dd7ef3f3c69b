"""Dates and timestamps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


MICROS_PER_DAY = 86_400_000_000


def as_of_date(as_of: Column | date | str | None = None) -> Column:
    """The day a report is made for; today unless given, so that a run can be repeated."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def days_before(as_of: Column | date | str | None, days: int) -> Column:
    """Midnight ``days`` before ``as_of``; stays a DATE, so comparisons push down to the scan."""
    return F.date_sub(as_of_date(as_of), days)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of the instant in UTC, with milliseconds (cut, not rounded) and a Z.

    A timestamp with a zone is the same instant in any session; one without is local time of the session zone, and
    an hour that the zone skips counts as the one after it. The text is made of whole numbers, the day and the
    milliseconds of the day since 1970, so no step depends on the session zone again.
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    in_day = F.pmod(micros, F.lit(MICROS_PER_DAY))
    day = F.date_from_unix_date(F.call_function("div", micros - in_day, F.lit(MICROS_PER_DAY)).cast("int"))
    millis = F.call_function("div", in_day, F.lit(1000)).cast("int")
    seconds, minutes = (F.call_function("div", millis, F.lit(n)).cast("int") for n in (1000, 60_000))
    hours = F.call_function("div", minutes, F.lit(60)).cast("int")
    digits = hours * 10_000_000 + minutes % 60 * 100_000 + seconds % 60 * 1000 + millis % 1000
    clock = (digits + 1_000_000_000).cast("string")  # a one, then HHMMSSmmm
    parts = [F.substring(clock, *at) for at in ((2, 2), (4, 2), (6, 2), (8, 3))]
    return F.concat(
        day.cast("string"), F.lit("T"), parts[0], F.lit(":"), parts[1], F.lit(":"), parts[2], F.lit("."), parts[3], F.lit("Z")
    )
