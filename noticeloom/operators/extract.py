"""Announcement rows out of list pages, driven by one spec per board."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as spec_field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.markup import cut_region, field, has_anchor, match_blocks, raw_cells, split_blocks
from ..functions.text import clean_each, collapse, unescape_each
from ..sources.pages import only_ok

PAGE_COLUMNS = ("run_id", "source", "page_no")


@dataclass(frozen=True)
class Capture:
    """A text taken from a block: pattern, group, and how it is cleaned.

    mode: raw (as matched), clean (unescape, collapse), late (collapse, unescape),
    decode (unescape only), collapse (collapse only).
    """

    pattern: str
    group: int = 1
    mode: str = "clean"
    before: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class BoardSpec:
    """What a board's list pages look like."""

    source: str
    anchor: str
    captures: dict[str, Capture]
    # Texts in, record columns out. Keys are the capture names, `cells` for the cleaned table
    # cells, and for an array its name (as matched) and decoded_<name>.
    record: Callable[[dict[str, Column]], dict[str, Column]]
    block_pattern: str | None = None
    block_delimiter: str | None = None
    region_marker: str | None = None
    with_cells: bool = False
    # At most one list pattern.
    arrays: dict[str, str] = spec_field(default_factory=dict)


def blocks(pages: DataFrame, spec: BoardSpec) -> DataFrame:
    """One row per block that links to an announcement: page columns, pos, block."""
    html = F.col("html")
    if spec.region_marker:
        html = cut_region(html, spec.region_marker)
    if spec.block_delimiter:
        found = split_blocks(html, spec.block_delimiter)
    else:
        found = match_blocks(html, spec.block_pattern)
    kept = [c for c in PAGE_COLUMNS if c in pages.columns]
    return (
        pages.select(*kept, F.posexplode(found).alias("pos", "block"))
        .filter(has_anchor(F.col("block"), spec.anchor))
    )


def extract_rows(pages: DataFrame, spec: BoardSpec) -> DataFrame:
    """Records of one board, narrow: `html` and `block` end here, before any shuffle.

    The texts of a block go to Python together, as one array to clean and one to decode.
    """
    if "status" in pages.columns:
        pages = only_ok(pages)
    if "source" in pages.columns:
        pages = pages.filter(F.col("source") == spec.source)
    kept = [c for c in PAGE_COLUMNS if c in pages.columns and c != "source"]

    raw: dict[str, Column] = {}
    cleaned: dict[str, Column] = {}
    decoded: dict[str, Column] = {}
    for name, capture in spec.captures.items():
        text = field(F.col("block"), capture.pattern, capture.group)
        if capture.before:
            text = capture.before(text)
        if capture.mode in ("collapse", "late"):
            text = collapse(text)
        kind = {"clean": cleaned, "late": decoded, "decode": decoded}.get(capture.mode, raw)
        kind[name] = text
    to_clean = F.array(*cleaned.values()).cast("array<string>")
    if spec.with_cells:
        to_clean = F.concat(to_clean, raw_cells(F.col("block")))
    taken = blocks(pages, spec).select(
        *kept, "pos",
        *[c.alias(f"raw_{n}") for n, c in raw.items()],
        *[
            F.transform(F.regexp_extract_all("block", F.lit(p), F.lit(1)), collapse).alias(f"raw_{n}")
            for n, p in spec.arrays.items()
        ],
        to_clean.alias("to_clean"),
        F.array(*decoded.values()).cast("array<string>").alias("to_decode"),
    )
    to_decode = F.col("to_decode")
    for name in spec.arrays:
        to_decode = F.concat(to_decode, f"raw_{name}")
    # Cells are exploded from an array of one: as a plain column the optimizer would put their cleaning,
    # a pattern per cell, into each field that takes a text from them.
    once = (lambda c: F.explode(F.array(c))) if spec.with_cells else (lambda c: c)
    ready = taken.select(
        *[c for c in taken.columns if c not in ("to_clean", "to_decode")],
        *([once(clean_each(F.col("to_clean"))).alias("cleaned")] if cleaned or spec.with_cells else []),
        *([unescape_each(to_decode).alias("decoded")] if decoded or spec.arrays else []),
    )

    texts = {n: F.col(f"raw_{n}") for n in (*raw, *spec.arrays)}
    texts.update({n: F.get("cleaned", F.lit(i)) for i, n in enumerate(cleaned)})
    texts.update({n: F.get("decoded", F.lit(i)) for i, n in enumerate(decoded)})
    # Cells follow the captures in `cleaned`, decoded arrays follow them in `decoded`.
    if spec.with_cells:
        texts["cells"] = _tail("cleaned", len(cleaned))
    for name in spec.arrays:
        texts[f"decoded_{name}"] = _tail("decoded", len(decoded))
    return ready.select(*kept, "pos", *[c.alias(n) for n, c in spec.record(texts).items()])


def _tail(array: str, skip: int) -> Column:
    return F.slice(array, F.lit(skip + 1), F.greatest(F.size(array), F.lit(1)))
