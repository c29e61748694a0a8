"""Intervals of numbers with open and closed ends, written like `[3,7)`; an empty side is open."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INTERVAL = r"^\s*([\[(])\s*([^,\s]*)\s*,\s*([^,\s]*)\s*([\])])\s*$"


def interval(text: Column) -> Column:
    """struct<low, low_closed, high, high_closed> of `[3,7)`; an open side is null.

    Null where the text is no interval.
    """
    part = lambda k: F.regexp_extract(text, INTERVAL, k)
    low, high = part(2).try_cast("double"), part(3).try_cast("double")
    odd = (low.isNull() & (part(2) != "")) | (high.isNull() & (part(3) != ""))
    found = F.struct(
        low.alias("low"), (part(1) == "[").alias("low_closed"), high.alias("high"), (part(4) == "]").alias("high_closed"))
    return F.when(text.rlike(INTERVAL) & ~odd, found)


def contains(bounds: Column, value: Column) -> Column:
    """Whether a value lies in an interval; null if either is unknown."""
    above = bounds["low"].isNull() | (value > bounds["low"]) | (bounds["low_closed"] & (value == bounds["low"]))
    below = bounds["high"].isNull() | (value < bounds["high"]) | (bounds["high_closed"] & (value == bounds["high"]))
    return F.when(bounds.isNotNull() & value.isNotNull(), above & below)
