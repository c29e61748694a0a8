"""Dates and application periods. Raw strings stay; typed dates are added beside them."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

from .text import clean, let

# The printed date forms that are recognised.
FOUR_DIGIT_YEAR = r"(?U)(\d{4})[.\-/\s\x1c-\x1f]+(\d{1,2})[.\-/\s\x1c-\x1f]+(\d{1,2})"
TWO_DIGIT_YEAR = r"(?U)(\d{2})[.\-/](\d{1,2})[.\-/](\d{1,2})"
PERIOD_MARK = "~|∼"
IMMINENT_DAYS = 3


def _two_digits(c: Column) -> Column:
    return F.lpad(F.translate(c, "０１２３４５６７８９", "0123456789"), 2, "0")


def _iso(text: Column, pattern: str, century: str) -> Column:
    year, month, day = (F.regexp_extract(text, pattern, g) for g in (1, 2, 3))
    return F.concat(F.lit(century), F.concat_ws("-", year, _two_digits(month), _two_digits(day)))


def norm_date(c: Column) -> Column:
    """First date in the text as YYYY-MM-DD; the cleaned text where there is none."""

    def first_date(text: Column) -> Column:
        return (
            F.when(text.rlike(FOUR_DIGIT_YEAR), _iso(text, FOUR_DIGIT_YEAR, ""))
            .when(text.rlike(TWO_DIGIT_YEAR), _iso(text, TWO_DIGIT_YEAR, "20"))
            .otherwise(text)
        )

    return let(clean(c), first_date)


def period_parts(c: Column) -> Column:
    """Number of pieces of a period text; anything but 2 has no start date."""
    return F.size(F.split(c, PERIOD_MARK))


def split_period(c: Column) -> Column:
    """Struct (apply_start, apply_end). Without exactly two parts only the end is set."""
    text = F.coalesce(c, F.lit(""))
    parts = F.split(text, PERIOD_MARK)
    is_range = F.size(parts) == 2
    start = F.when(is_range, F.get(parts, F.lit(0))).otherwise("")
    end = F.when(is_range, F.get(parts, F.lit(1))).otherwise(text)
    return F.struct(norm_date(start).alias("apply_start"), norm_date(end).alias("apply_end"))


def as_date(c: Column) -> Column:
    """Typed date of a normalized text; null = unknown."""
    return F.when(
        c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")
    )


def _day(as_of: Column | datetime.date) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def d_day(end: Column, as_of: Column | datetime.date) -> Column:
    """Days left until the deadline; null where the deadline is unknown."""
    return F.date_diff(as_date(end), _day(as_of))


def is_open(end: Column, as_of: Column | datetime.date) -> Column:
    """Not past the deadline. Unknown deadlines count as open."""
    typed = as_date(end)
    return typed.isNull() | (typed >= _day(as_of))


def imminent(end: Column, as_of: Column | datetime.date, days: int = IMMINENT_DAYS) -> Column:
    """Flag, never a filter: due within `days`."""
    return F.coalesce(d_day(end, as_of).between(0, days), F.lit(False))
