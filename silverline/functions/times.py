"""Dates and times that arrive in mixed formats.

Only ``try_`` parsers are used, so a value nobody can parse becomes NULL instead
of ending the job, whatever the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.fixed_values import (
    AGE_BANDS,
    EVENT_DATE_NAMES,
    EVENT_TIME_NAMES,
    EVENT_TIMESTAMP_NAMES,
)

# Years have four digits, or more with a sign.
YEAR = "(?:[0-9]{4}|-[0-9]{4,7}|[+][0-9]{5,7})"
SLASHED = rf"^([0-9]{{2}})/([0-9]{{2}})/({YEAR})\z"
ISO_OR_SLASHED = rf"^{YEAR}-[0-9]{{2}}-[0-9]{{2}}\z|{SLASHED}"
SECONDS_OR_MILLIS = "^[0-9]{10}(?:[0-9]{3})?$"
CLOCK = r"^[0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def flexible_date(value: Column) -> Column:
    """Date from ``yyyy-MM-dd``, ``dd/MM/yyyy``, 10-digit seconds or 13-digit millis.

    A shape test lets only well-formed texts reach Spark's own date cast, which
    still rejects days that do not exist and is much faster than parsing with a
    pattern, above all on texts that do not fit. The first ten digits of millis
    are its whole seconds.
    """
    text = F.trim(value.cast("string"))
    return F.coalesce(_calendar_text(text).try_cast("date"), _epoch_date(text))


def _calendar_text(text: Column) -> Column:
    """A date of either calendar shape as year, month and day, whether or not there is such a day; else NULL."""
    slashed = F.concat(F.substr(text, F.lit(7)), F.lit("-"), text.substr(4, 2), F.lit("-"), text.substr(1, 2))
    ordered = F.when(text.substr(3, 1) == F.lit("/"), slashed).otherwise(text)
    return F.when(text.rlike(ISO_OR_SLASHED), ordered)


def _epoch_date(text: Column) -> Column:
    seconds = F.when(text.rlike(SECONDS_OR_MILLIS), text.substr(1, 10).try_cast("bigint"))
    return F.to_date(F.timestamp_seconds(seconds))


def date_and_time(day: Column, time: Column) -> Column:
    """Timestamp from a flexible date and an ``HH:mm:ss`` text (midnight if NULL).

    A calendar date is read once, together with its time.
    """
    clock = F.coalesce(F.trim(time.cast("string")), F.lit("00:00:00"))
    text = F.trim(day.cast("string"))
    dated = F.coalesce(_calendar_text(text), _epoch_date(text).cast("string"))
    stamp = F.concat(dated, F.lit(" "), clock)
    return F.when(clock.rlike(CLOCK), stamp).try_cast("timestamp")


def first_existing(names: Collection[str], candidates: Collection[str], purpose: str) -> str:
    """First of ``candidates`` that is a column; an error naming the choices if none is."""
    for candidate in candidates:
        if candidate in names:
            return candidate
    raise ValueError(f"no column for {purpose}: tried {list(candidates)}, have {list(names)}")


def _optional(names: Collection[str], candidates: Collection[str], purpose: str) -> Column | None:
    if set(candidates).isdisjoint(names):
        return None
    return F.col(first_existing(names, candidates, purpose))


def event_date_source(names: Collection[str]) -> Column | None:
    """The raw date column of an event, if the records have one."""
    return _optional(names, EVENT_DATE_NAMES, "event date")


def event_time(names: Collection[str]) -> Column:
    """Event timestamp from whichever columns exist.

    A timestamp column wins, then date with time, then the date at midnight;
    with none of them the event time is NULL.
    """
    stamp = _optional(names, EVENT_TIMESTAMP_NAMES, "event timestamp")
    day = event_date_source(names)
    time = _optional(names, EVENT_TIME_NAMES, "event time")
    if stamp is not None:
        return F.try_to_timestamp(stamp.cast("string"))
    if day is None:
        return F.lit(None).cast("timestamp")
    return flexible_date(day).cast("timestamp") if time is None else date_and_time(day, time)


def age_band(dob: Column, as_of: date | Column | None = None) -> Column:
    """Age band on ``as_of`` (today if not given); NULL below 18 or if dob is unknown."""
    today = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = F.floor(F.months_between(today, dob) / F.lit(12))
    oldest_first = sorted(AGE_BANDS.items(), reverse=True)
    return F.coalesce(*[F.when(age >= F.lit(lowest), F.lit(label)) for lowest, label in oldest_first])
