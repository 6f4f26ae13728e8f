"""Scalar functions, each one a function from ``Column`` to ``Column``.

All of them are built-in Spark expressions, so a projection that uses them
stays inside whole-stage code generation. Functions that can fail on bad input
use the ``try_`` forms: ANSI mode stays on and bad input becomes NULL.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and formats that decide the results.
FIRST_DIGITS_PATTERN = "[0-9]+"
NON_DIGITS_PATTERN = "[^0-9]+"
POSTCODE_PATTERN = "[A-Z]{1,2}[0-9]+ +[0-9]+[A-Z]+"
REGISTER_DATE_FORMAT = "d/M/yyyy"
FRAGMENT_NUMBER_PATTERN = "_([0-9]+)\\.csv$"
RELEASE_DATE_PATTERN = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
COUNTRY_PREFIX = "UK"


# --- codes: three rules for "the code" of one text, each used by other jobs ---


def first_digits(text: Column) -> Column:
    """The first run of digits; NULL if there is none."""
    return F.regexp_substr(text, F.lit(FIRST_DIGITS_PATTERN))


def only_digits(text: Column) -> Column:
    """The text without its non-digits; '' if nothing is left."""
    return F.regexp_replace(text, NON_DIGITS_PATTERN, "")


def before_dash(text: Column) -> Column:
    """The trimmed text before the first dash; all of it if there is no dash."""
    return F.trim(F.substring_index(text, "-", 1))


# --- postcodes ---


def find_postcode(
    *parts: Column,
    pattern: str = POSTCODE_PATTERN,
    ignore_case: bool = True,
    skip_nulls: bool = False,
) -> Column:
    """The first postcode in the blank-separated parts; NULL if there is none.

    By default one NULL part hides the whole address. ``skip_nulls`` searches
    the parts that are there.
    """
    if skip_nulls:
        text = F.concat_ws(" ", *parts)
    else:
        text = reduce(lambda left, right: F.concat(left, F.lit(" "), right), parts)
    return F.regexp_substr(text, F.lit(("(?i)" if ignore_case else "") + pattern))


def without_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def normal_postcode(postcode: Column) -> Column:
    """Lower case without blanks."""
    return F.lower(without_blanks(postcode))


# --- identity ---


def organisation_id(company_number: Column) -> Column:
    return F.concat(F.lit(COUNTRY_PREFIX), company_number)


def content_key(*parts: Column) -> Column:
    """MD5 of the parts put together; NULL as soon as one part is NULL.

    Dates must be of type date, so that they enter as ``yyyy-MM-dd``.
    """
    return F.md5(F.concat(*[part.cast("string") for part in parts]))


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


# --- dates ---


def register_date(text: Column) -> Column:
    """Day/month/year text to a date; NULL for blanks and impossible days."""
    return F.try_to_date(text, REGISTER_DATE_FORMAT)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def previous_month(day: Column) -> Column:
    """First day of the month before; January leads to December."""
    return F.add_months(month_start(day), -1)


def first_of_month(as_of: dt.date, months: int = 0) -> dt.date:
    """The first day of the month that lies ``months`` after the one of ``as_of``."""
    index = as_of.year * 12 + as_of.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def in_month(day: Column, as_of: dt.date, months: int = 0) -> Column:
    """Same month as ``as_of``, moved by ``months``.

    Written as a half-open range of literals: that form reaches the Parquet
    reader as a pushed filter and prunes row groups; month(d) = m does not.
    """
    return (day >= F.lit(first_of_month(as_of, months))) & (
        day < F.lit(first_of_month(as_of, months + 1))
    )


def on_day(moment: Column, as_of: dt.date) -> Column:
    """On the day ``as_of``, as a range for the same reason."""
    return (moment >= F.lit(as_of)) & (moment < F.lit(as_of + dt.timedelta(days=1)))


# --- counts ---


def change(before: Column, after: Column) -> Column:
    return after - before


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as double; NULL if the whole is zero."""
    return F.try_divide((F.lit(100) * part).cast("double"), whole.cast("double"))


# --- file names ---


def file_name(path: Column) -> Column:
    """The part after the last slash; NULL if the path has no slash or no name."""
    return F.nullif(F.regexp_extract(path, ".*/([^/]+)$", 1), F.lit(""))


def fragment_number(name: Column) -> Column:
    """17 of ``..._17.csv``; NULL if the name has no number."""
    return F.regexp_extract(name, FRAGMENT_NUMBER_PATTERN, 1).try_cast("int")


def release_date(name: Column) -> Column:
    """The date in the name of a release file; NULL if there is none."""
    return F.try_to_date(F.regexp_substr(name, F.lit(RELEASE_DATE_PATTERN)), "yyyy-MM-dd")
