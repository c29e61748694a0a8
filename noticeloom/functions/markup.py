"""Expressions that cut records out of page markup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .text import clean_each, strip_tags

CELL = r"<td[^>]*>((?s:.*?))</td>"


def cut_region(html: Column, marker: str) -> Column:
    """Markup after the first marker; null (no rows) where the marker is missing."""
    return F.get(F.split(html, rf"\Q{marker}\E", 2), F.lit(1))


def split_blocks(html: Column, delimiter: str) -> Column:
    """Pieces between delimiters; what stands before the first one is dropped."""
    pieces = F.split(html, delimiter)
    return F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))


def match_blocks(html: Column, pattern: str) -> Column:
    """All whole matches of a block pattern."""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))


def has_anchor(block: Column, pattern: str) -> Column:
    return block.rlike(pattern)


def field(block: Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match, '' where the pattern is absent."""
    return F.regexp_extract(block, pattern, group)


def field_list(block: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(block, F.lit(pattern), F.lit(group))


def last_match(block: Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the last match, '' where the pattern is absent."""
    return F.coalesce(F.try_element_at(field_list(block, pattern, group), F.lit(-1)), F.lit(""))


def raw_cells(block: Column) -> Column:
    """Contents of all table cells with their tags blanked, still escaped."""
    return F.transform(field_list(block, CELL), strip_tags)


def cells(block: Column) -> Column:
    """Cleaned contents of all table cells."""
    return clean_each(raw_cells(block))


def cell(texts: Column, index: int, min_len: int | None = None) -> Column:
    """Element at `index`, '' unless the array has `min_len` elements."""
    needed = index + 1 if min_len is None else min_len
    return F.when(F.size(texts) >= needed, F.get(texts, F.lit(index))).otherwise("")


def first_where(texts: Column, predicate: Callable[[Column], Column]) -> Column:
    """First element that satisfies the predicate, '' if none does."""
    return F.coalesce(F.get(F.filter(texts, predicate), F.lit(0)), F.lit(""))


def pick_prefix(texts: Column, prefix: str) -> Column:
    """First element with the prefix, every occurrence of the prefix removed."""
    found = first_where(texts, lambda t: t.startswith(prefix))
    return F.trim(F.replace(found, F.lit(prefix), F.lit("")))

