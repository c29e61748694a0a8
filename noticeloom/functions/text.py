"""String expressions. Everything is JVM-side but the entity table of HTML 5."""

from __future__ import annotations

import html
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

# White space as Unicode sees it, plus the separators U+001C-1F that (?U)\s leaves out.
SPACES = r"(?U)[\s\x1c-\x1f]+"
# The same characters as a list, for trimming.
SPACE_CHARACTERS = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# What is taken out of markup and URLs. (?s:.*?) is any text.
SCRIPT_OR_STYLE = r"<script(?s:.*?)</script>|<style(?s:.*?)</style>"
TAG = r"<[^>]+>"
COMMENT = r"<!--(?s:.*?)-->"
SESSION_ID = r";jsessionid=[^?]*"
SLUG_LENGTH = 80
# Texts that are Python objects at a time: a batch holds up to 10,000 pages.
DECODED_AT_ONCE = 256


# The functions use nothing else of this module, so that they are sent whole to workers without it.
@F.arrow_udf(T.StringType())
def _decode(texts: pa.Array) -> pa.Array:
    parts = [pa.array([], pa.string())]
    for k in range(0, len(texts), DECODED_AT_ONCE):
        part = texts.slice(k, DECODED_AT_ONCE).to_pylist()
        parts.append(pa.array([None if t is None else html.unescape(t) for t in part], pa.string()))
    return pa.concat_arrays(parts)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _decode_each(lists: pa.Array) -> pa.Array:
    parts = [pa.array([], pa.list_(pa.string()))]
    for k in range(0, len(lists), DECODED_AT_ONCE):
        part = lists.slice(k, DECODED_AT_ONCE).to_pylist()
        parts.append(pa.array(
            [None if ts is None else [None if t is None else html.unescape(t) for t in ts] for ts in part],
            pa.list_(pa.string())))
    return pa.concat_arrays(parts)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mentions(text: Column, *words: str) -> Column:
    """Whether a text has one of some words; far cheaper than a pattern that needs one of them."""
    found = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def unescape(c: Column) -> Column:
    """Replace character references; null becomes ''.

    Only texts with an ampersand are sent to Python.
    """
    text = F.coalesce(c, F.lit(""))
    return F.coalesce(_decode(F.when(text.contains("&"), text)), text)


def unescape_each(texts: Column) -> Column:
    """`unescape` on every element of an array, with one call for the whole array."""
    has_reference = F.exists(texts, lambda t: t.contains("&"))
    return F.coalesce(_decode_each(F.when(has_reference, texts)), texts)


def clean_each(texts: Column) -> Column:
    """`clean` on every element of an array; only arrays with references are sent to Python."""
    return F.transform(unescape_each(texts), collapse)


def collapse(c: Column) -> Column:
    """Runs of white space become one space, the ends are trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACES, " "))


def clean(c: Column) -> Column:
    """Unescape, then collapse: `&nbsp;` ends as a plain space."""
    return collapse(unescape(c))


def clean_late(c: Column) -> Column:
    """Collapse, then unescape: `&nbsp;` stays a no-break space."""
    return unescape(collapse(c))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAG, " ")


def strip_comments(c: Column) -> Column:
    return F.regexp_replace(c, COMMENT, "")


def strip_html(c: Column) -> Column:
    """Page to text: no scripts and styles, a line break per tag, no blank lines."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), SCRIPT_OR_STYLE, "")
    lines = unescape(F.regexp_replace(bare, TAG, "\n"))
    return F.regexp_replace(lines, r"(?U)\n[\s\x1c-\x1f]*\n+", "\n")


def drop_session(c: Column, pattern: str = SESSION_ID) -> Column:
    return F.regexp_replace(c, pattern, "")


def url_host(c: Column) -> Column:
    """Host of an http(s) URL; anything else is returned as it is."""
    return F.regexp_replace(c, r"^https?://([^/]+).*", "$1")


def slug(c: Column) -> Column:
    """File label of a URL; null where there is no `://`. A label only, never a key."""
    rest = F.get(F.split(c, "://", 2), F.lit(1))
    return F.substring(F.regexp_replace(rest, r"(?U)\W+", "_"), 1, SLUG_LENGTH)


def join_nonempty(texts: Column, separator: str = " / ") -> Column:
    return F.array_join(F.filter(texts, lambda t: t != ""), separator)


def or_default(c: Column, default: str) -> Column:
    """Display value of a field that is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))
