"""Fetched pages as a table, and the filters that reach its scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import strip_html, url_host

OK_STATUS = 200

FIRST_BOARD = "kstartup"

# Hosts whose detail pages may be read.
ALLOWED_HOSTS = ("bizinfo.go.kr", "nipa.kr", "kocca.kr", "smtech.go.kr", "k-startup.go.kr")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page table in Parquet; partition it by run_id and source."""
    return spark.read.parquet(path)


def only_ok(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("status") == OK_STATUS)


def cap_of(source: Column, caps: int | Mapping[str, int]) -> Column:
    """The last page to read of a source; null where `caps` names none."""
    if isinstance(caps, int):
        return F.lit(caps)
    cap = F.lit(None).cast("int")
    for name, last in sorted(caps.items()):
        cap = F.when(source == name, last).otherwise(cap)
    return cap


def page_cap(pages: DataFrame, caps: int | Mapping[str, int]) -> DataFrame:
    """Pages up to the cap of their source; sources without a cap keep all pages."""
    beyond = F.col("page_no") > cap_of(F.col("source"), caps)
    return pages.filter(~F.coalesce(beyond, F.lit(False)))


def valid_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]+$"), F.lit(False))


def host_suffixes(host: Column) -> Column:
    """The host and every parent domain: a.b.kr -> [a.b.kr, b.kr, kr]."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
    )


def allowed_host(df: DataFrame, hosts: list[str] | tuple[str, ...] = ALLOWED_HOSTS) -> DataFrame:
    """Rows whose URL lies on an allowed host or below one.

    The list is configuration of a few names, so it is a literal in the filter.
    """
    known = F.array(*[F.lit(h) for h in hosts])
    return df.filter(F.arrays_overlap(host_suffixes(url_host(F.col("url"))), known))


def detail_texts(pages: DataFrame, header: Column | bool | None = None) -> DataFrame:
    """Text of each readable page; boards other than the first carry their URL on top.

    `header` says which rows get the URL; by default all but those of the first board, if there is
    a source column.
    """
    text = strip_html(F.col("html"))
    if header is None:
        header = F.col("source") != FIRST_BOARD if "source" in pages.columns else True
    wanted = F.coalesce(header if isinstance(header, Column) else F.lit(header), F.lit(True))
    top = F.concat(F.coalesce("url", F.lit("")), F.lit("\n\n"))
    text = F.concat(F.when(wanted, top).otherwise(""), text)
    kept = [c for c in pages.columns if c not in ("html", "status")]
    return only_ok(pages).select(*kept, text.alias("text"))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages without a usable answer, with the reason."""
    reason = F.concat(F.lit("HTTP "), F.col("status").cast("string"))
    kept = [c for c in pages.columns if c != "html"]
    bad = ~F.coalesce(F.col("status") == OK_STATUS, F.lit(False))
    return pages.filter(bad).select(*kept, F.coalesce(reason, F.lit("no status")).alias("reason"))


def write_details(details: DataFrame, path: str) -> None:
    """Detail texts by source. No shuffle: each task writes what it extracted."""
    details.write.mode("errorifexists").partitionBy("source").parquet(path)
