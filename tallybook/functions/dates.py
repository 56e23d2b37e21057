"""Dates from text. Texts are told apart by shape, so no row pays for a failed parse."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date texts as (shape, format), tried in this order.
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}-\d{1,2}-\d{2}$", "M-d-yy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
)

# Fixed value: a day with a time of day, in seconds or minutes, perhaps with a fraction and a zone.
CLOCK = r"^(\d{4}-\d{1,2}-\d{1,2})[T ](\d{1,2}:\d{1,2})(:\d{1,2}(?:\.\d{1,9})?)?(?:Z| ?[+-]\d{2}:?\d{2})?$"

# Fixed value: a date in numbers that ends with its year, perhaps with a time of day; its first two parts are numbered.
NUMBERED = r"^(\d{1,2})[-/](\d{1,2})[-/](?:\d{4}|\d{2})(?: \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"
NUMBERED_CLOCK = r"^\d{1,2}[-/]\d{1,2}[-/](?:\d{4}|\d{2}) (\d{1,2}:\d{1,2})(:\d{1,2})?$"

# Fixed value: two-digit years above this one belong to the 1900s.
LAST_SHORT_YEAR = "68"


def date_formats(day_first: bool) -> tuple[tuple[str, str], ...]:
    """The accepted forms; in dates of numbers that end with the year, the month or the day stands first."""
    swapped = {"M-d-": "d-M-", "M/d/": "d/M/"}
    return tuple((shape, swapped[f[:4]] + f[4:] if day_first and f[:4] in swapped else f) for shape, f in DATE_FORMATS)


def parse_date(text: Column, formats: Sequence[tuple[str, str]] | None = None, day_first: bool = False) -> Column:
    """Date from the first format whose shape fits; null when none fits or the day is impossible.

    The text must be stripped. ``day_first`` reads ``30/04/2022`` as the 30th of April; one text alone does
    not tell, its column may (``day_first_columns``).
    """
    formats = date_formats(day_first) if formats is None else formats
    day = F.when(text.rlike(NUMBERED_CLOCK), F.substring_index(text, " ", 1)).otherwise(text)
    parsed = F.when(text.rlike(CLOCK), _clock(text).cast("date"))
    for shape, fmt in reversed(formats):
        own = day if fmt[:4] in ("M-d-", "M/d/", "d-M-", "d/M/") else text
        parsed = F.when(own.rlike(shape), _parse(own, fmt)).otherwise(parsed)
    return parsed


def parse_timestamp(text: Column, day_first: bool = False) -> Column:
    """Timestamp from stripped text, as the clock showed it; a text that holds only a date is midnight."""
    day = parse_date(text, day_first=day_first)
    seconds = F.regexp_extract(text, NUMBERED_CLOCK, 2)
    clock = F.concat(F.regexp_extract(text, NUMBERED_CLOCK, 1), F.when(seconds == "", ":0").otherwise(seconds))
    numbered = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock).try_cast("timestamp_ntz")
    return (
        F.when(text.rlike(CLOCK), _clock(text))
        .when(text.rlike(NUMBERED_CLOCK), numbered)
        .otherwise(day.cast("timestamp_ntz"))
    )


def day_parts(text: Column) -> Column:
    """(first, second) of a date whose parts are all numbers and whose year stands last; else null."""
    first, second = (F.regexp_extract(text, NUMBERED, k).cast("int") for k in (1, 2))
    return F.when(text.rlike(NUMBERED), F.struct(first.alias("first"), second.alias("second")))


def _clock(text: Column) -> Column:
    """Day and time of day as written; a zone is left out."""
    seconds = F.regexp_extract(text, CLOCK, 3)
    full = F.concat(
        F.regexp_extract(text, CLOCK, 1),
        F.lit(" "),
        F.regexp_extract(text, CLOCK, 2),
        F.when(seconds == "", ":0").otherwise(seconds),
    )
    return full.try_cast("timestamp_ntz")


def _parse(text: Column, fmt: str) -> Column:
    if re.search(r"\byy$", fmt):
        # Spark reads every two-digit year as 20yy, so the century is written out first.
        year = F.right(text, F.lit(2))
        century = F.when(year > LAST_SHORT_YEAR, "19").otherwise("20")
        text = F.concat(F.left(text, F.length(text) - 2), century, year)
        fmt += "yy"
    return F.try_to_date(text, fmt)


def month_key(day: Column) -> Column:
    """Sortable month text such as ``2022-04``."""
    return F.date_format(day, "yyyy-MM")


def month_label(day: Column) -> Column:
    """Display month such as ``Apr 2022``."""
    return F.date_format(day, "MMM yyyy")
