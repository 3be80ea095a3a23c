"""Dates from parts, packed digits and mixed spellings; ages."""

from __future__ import annotations

import calendar
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paneloom.functions.text import map_values

_MONTHS = {
    name.lower(): number
    for names in (calendar.month_name, calendar.month_abbr)
    for number, name in enumerate(names)
    if name
}

DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "M-d-yyyy", "MMM d, yyyy", "MMMM d, yyyy")


def whole_number(value: Column) -> Column:
    """Integer part of a number or of its text; null when it is not a number."""
    return value.cast("string").try_cast("double").try_cast("int")


def month_number(value: Column) -> Column:
    """Month 1-12 from a name, an abbreviation, a number or its text."""
    text = F.lower(F.trim(value.cast("string")))
    number = whole_number(text)
    return F.coalesce(map_values(text, _MONTHS), F.when(number.between(1, 12), number))


def valid_date(year: Column, month: Column, day: Column) -> Column:
    """Calendar date, null when it does not exist."""
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(
        years=year, months=month, days=day, hours=zero, mins=zero, secs=zero
    ).cast("date")


def date_from_parts(day: Column, month: Column, year: Column) -> Column:
    return valid_date(whole_number(year), month_number(month), whole_number(day))


def mixed_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date from the first of the formats that fits, null when none does."""
    text = F.trim(value.cast("string"))
    return F.coalesce(text.try_cast("date"), *[F.try_to_date(text, f) for f in formats])


def packed_date(
    value: Column, pivot: int = 35, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    """Date from ``MMDDYY``, ``MDDYY`` or ``MDYY`` digits, else a mixed spelling.

    Two-digit years below ``pivot`` belong to the 2000s.
    """
    text = F.trim(value.cast("string"))

    def cut(start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    def packed(month_digits: int, day_digits: int) -> Column:
        short = cut(1 + month_digits + day_digits, 2)
        year = F.when(short < pivot, short + 2000).otherwise(short + 1900)
        return valid_date(year, cut(1, month_digits), cut(1 + month_digits, day_digits))

    return (
        F.when(text.rlike("^[0-9]{6}$"), packed(2, 2))
        .when(text.rlike("^[0-9]{5}$"), packed(1, 2))
        .when(text.rlike("^[0-9]{4}$"), packed(1, 1))
        .otherwise(mixed_date(text, formats))
    )


def birth_date(
    value: Column,
    season: Column,
    packed_seasons: Sequence[int] = (),
    unreadable_seasons: Sequence[int] = (),
) -> Column:
    """Birth date by the season's spelling: packed, unreadable (null) or mixed."""
    return (
        F.when(season.isin(*packed_seasons), packed_date(value))
        .when(season.isin(*unreadable_seasons), F.lit(None).cast("date"))
        .otherwise(mixed_date(value))
    )


def day_and_time(day: Column, time: Column) -> Column:
    """Timestamp from a day text and a time text, null when either is missing."""
    return F.concat(day, F.lit(" "), time).try_cast("timestamp_ntz")


def age_at(birth: Column, season: Column, openers: Mapping[int, str]) -> Column:
    """Whole 365-day years between the birth date and the season's opening day."""
    opening = map_values(season, openers).cast("date")
    return F.floor(F.datediff(opening, birth.cast("date")) / 365).cast("int")
