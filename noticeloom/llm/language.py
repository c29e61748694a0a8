"""Language identification by Bayesian fusion of evidence.

Text likelihoods come from byte trigrams, compared with an unordered-bytes model that stands for "no
known language". They are combined with the declared markup language, through the confusion of
declarations that the data show, and with a prior per host, smoothed towards its address suffix and
that towards all documents. Confusion and priors are grouped counts over all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import cut_lineage, join_dimension

# The classifier is fitted on at most this many texts of every declared language; which texts is
# decided by a hash of their id.
FIT_TEXTS = 1000
BUCKETS = 1 << 15
# Trigrams overlap: every byte is seen three times.
OVERLAP = 3.0
UNSEEN = 0.5
# A language has so many trigrams per counted one, and UNSEEN of them per bucket, at most, spread as in
# the unknown model. So the unknown model wins on what a language has not seen, however few its texts.
BACK = 0.125
# Share of the unknown model that lies evenly on all trigrams, for bytes that no known text has.
EVEN = 0.05
# Weight of the wider level in the smoothing of host and suffix priors, and of declarations.
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 20.0, 50.0, 5.0
UNKNOWN_PRIOR = 0.01
# The evidence of a short text in a known language scatters by this times the root of its bytes
# (standard deviation on held-out texts of less than 40 bytes: 1.1).
SCATTER = 1.0
LEAST_POSTERIOR = 0.5
UNKNOWN = "und"
SLICE_BYTES = 1 << 21
# Addresses, hexadecimal names and numbers of ASCII text say nothing about its language.
LEFT_OUT = re.compile(
    rb"(?:https?|ftp)://[!-~]+|(?<![0-9a-z.])www\.[!-~]+"
    rb"|(?<![0-9a-z._%+-])[0-9a-z._%+-]+@[0-9a-z-]+(?:\.[0-9a-z-]+)+"
    rb"|(?<![0-9a-z])(?:0x[0-9a-f]+|(?=[a-f]*[0-9])[0-9a-f]{8,}(?:-[0-9a-f]{4,})*)(?![0-9a-z])"
    rb"|[+(]?[0-9](?:[0-9.,:/() -]*[0-9])?")


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes that end at each position; the first two see zeros before them."""
    x = data.astype(np.uint32)
    before = np.concatenate([[0], x[:-1]]).astype(np.uint32) if len(x) else x
    first = np.concatenate([[0, 0], x[:-2]]).astype(np.uint32)[:len(x)] if len(x) else x
    code = x | (before << np.uint32(8)) | (first << np.uint32(16))
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


def _bytes_of(text: str | None) -> np.ndarray:
    """Lower-case bytes without LEFT_OUT, with runs of white space as one blank."""
    return np.frombuffer(_squeeze(LEFT_OUT.sub(b" ", _squeeze((text or "").lower().encode("utf-8")))), np.uint8)


def _squeeze(data: bytes) -> bytes:
    return b" ".join(data.split())


COUNT = T.StructType([
    T.StructField("language", T.StringType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("n", T.LongType()),
])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language; bucket numbers from BUCKETS on count single bytes."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch.column("_declared").to_pylist(), batch.column("_text")):
            data = _bytes_of(text.as_py())
            own = sums.setdefault(language, np.zeros(BUCKETS + 256, np.int64))
            own[:BUCKETS] += np.bincount(trigram_buckets(data), minlength=BUCKETS)
            own[BUCKETS:] += np.bincount(data, minlength=256)
    schema = pa.schema([("language", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    for language, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
            schema=schema)


class Model:
    """Log probabilities per trigram bucket: a column per language, then the unknown one."""

    def __init__(self, languages: list[str], trigrams: np.ndarray):
        self.languages, self.trigrams = languages, trigrams

    def scores(self, text: str | None) -> np.ndarray:
        """Log likelihood of the text per language, then of the unknown one."""
        return self.scores_of(_bytes_of(text))

    def scores_of(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(self.trigrams.shape[1])
        for k in range(0, len(data), SLICE_BYTES):
            first = max(0, k - 2)
            at = trigram_buckets(data[first:k + SLICE_BYTES])[k - first:]
            out += np.take(self.trigrams, at, axis=0).sum(axis=0, dtype=np.float64)
        return out / OVERLAP


def _unordered(single: np.ndarray) -> np.ndarray:
    """Counts per bucket of trigrams whose bytes are drawn one by one from the byte frequencies."""
    seen = np.flatnonzero(single)
    p = single[seen] / single.sum()
    chance, out = np.outer(p, p).ravel(), np.zeros(BUCKETS)
    for first, share in zip(seen, p):
        code = (first << 16 | seen[:, None] << 8 | seen[None, :]).astype(np.uint32).ravel()
        bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)
        out += np.bincount(bucket, weights=share * chance, minlength=BUCKETS)
    return (out * (1 - EVEN) + EVEN / BUCKETS) * single.sum()


def fit(rows: DataFrame) -> Model:
    """The model of a sample of rows(_id, _declared, _text): about FIT_TEXTS of every declared language.

    One aggregate counts the different rows of each language, which gives the share of them to take;
    rows are then taken by a hash of id and text, null ids too, without a window or a join. Counting
    is grouped in Spark; a table of languages times buckets reaches the driver (128 KB per language).
    """
    told = rows.filter("_declared <> ''").withColumn(
        "_c", F.xxhash64(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.coalesce("_text", F.lit(""))))
    sizes = {r["_declared"]: r["n"] for r in told.groupBy("_declared").agg(
        F.approx_count_distinct("_c").alias("n")).toLocalIterator()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 1), np.float32))
    # A row is in the sample by its own hash; rows that repeat an id and a text count once.
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, FIT_TEXTS / max(sizes[k], 1)))])
    chance = F.shiftrightunsigned("_c", 11).cast("double") / float(1 << 53)
    sample = told.filter(chance < F.element_at(share, F.col("_declared"))).dropDuplicates(["_declared", "_c"]).select(
        "_declared", "_text")
    counts = sample.mapInArrow(_count, COUNT).groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((BUCKETS + 256, len(languages)))
    column = pc.index_in(counts["language"], pa.array(languages, pa.string())).to_numpy()
    table[counts["bucket"].to_numpy(), column] = counts["n"].to_numpy()
    unknown = _unordered(table[BUCKETS:].sum(axis=1)) + UNSEEN
    return Model(languages, _log_table(table[:BUCKETS], unknown / unknown.sum()))


def _log_table(counts: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Logarithms of the languages' shares, smoothed by those of the unknown model, then of the latter."""
    out = np.empty((len(counts), counts.shape[1] + 1), np.float32)
    out[:, -1] = np.log(unknown)
    for k, n in enumerate(counts.sum(axis=0)):
        back = min(UNSEEN * BUCKETS, BACK * n) if n else BACK
        out[:, k] = np.log((counts[:, k] + back * unknown) / (n + back if n else 1 + BACK))
    return out


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """rows without _text, with _scores: log likelihoods per language and, last, of the unknown one.

    _left has the bytes that speak for or against a language, _all those of the whole text.
    """

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def scores(texts: pa.Array) -> pa.Array:
        def measured(text: str | None) -> list[float]:
            data, whole = _bytes_of(text), _squeeze((text or "").encode("utf-8"))
            return [float(len(data)), float(len(whole)), *model.scores_of(data).tolist()]

        return pa.array([measured(t.as_py()) for t in texts], pa.list_(pa.float64()))

    width = len(model.languages) + 1
    return rows.withColumn("_measured", scores("_text")).drop("_text").select(
        *[c for c in rows.columns if c != "_text"], F.get("_measured", F.lit(0)).alias("_left"),
        F.get("_measured", F.lit(1)).alias("_all"), F.slice("_measured", 3, width).alias("_scores"))


def _counts(groups: DataFrame, keys: list[str], n: int) -> DataFrame:
    """(*keys, _counts, _total) of groups(*keys, _best, _n): an array with a count per language."""
    held = groups.groupBy(*keys, "_best").agg(F.sum("_n").alias("_n")).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_best", "_n"))).alias("_of"), F.sum("_n").alias("_total"))
    count = lambda k: F.coalesce(F.element_at("_of", k), F.lit(0)).cast("double")
    every = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), count)
    return held.select(*keys, every.alias("_counts"), F.col("_total").cast("double").alias("_total"))


def _log_shares(weight: float, wider: Column) -> Column:
    """Logarithms of _counts smoothed with `weight` times the shares of the wider level."""
    return F.zip_with("_counts", wider, lambda c, w: F.log((c + weight * w) / (F.col("_total") + weight)))


def identify(
    df: DataFrame, id: str = "doc_id", text: str = "text", declared: str | None = "lang",
    host: str | None = "source", suffix: str | None = None, model: Model | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, language, posterior, kept, *keep): one row per row of `df`.

    `declared`, `host` and `suffix` name columns of evidence, None where there is none; null evidence
    says nothing about a row (a null host or suffix has the prior of the next wider level's null
    group). Without `model` one is fitted on declared languages. A row is rejected (kept false,
    language null) when its text is null or has nothing but white space and LEFT_OUT, when the
    unordered-bytes model wins, or when no language reaches LEAST_POSTERIOR. The prior odds of that
    model allow for SCATTER and count by the share of the text that is not left out. Repeated rows are
    judged alike; ties go to the language first in the alphabet. No rows, or no declared languages to
    fit on: no language.
    """
    nothing = F.lit(None).cast("string")
    rows = df.select(
        F.col(id).alias("_id"),
        *[(F.col(c).cast("string") if c else nothing).alias(n) for n, c in (("_text", text), ("_declared", declared), ("_host", host), ("_suffix", suffix))],
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    ).withColumns({c: F.coalesce(c, F.lit("")) for c in ("_declared", "_host", "_suffix")})
    own = model or fit(rows)
    n = len(own.languages)
    found = cut_lineage(_scored(rows, own).withColumn("_empty", F.col("_left") == 0))
    kept_columns = [F.col(f"_keep_{c}").alias(c) for c in keep]
    if not n:
        return found.select(
            F.col("_id").alias(id), nothing.alias("language"), F.lit(0.0).alias("posterior"),
            F.lit(False).alias("kept"), *kept_columns)
    spoken = F.slice("_scores", 1, n)
    best = F.array_position(spoken, F.array_max(spoken)).cast("int") - 1
    sure = found.filter((~F.col("_empty")) & (F.array_max(spoken) > F.element_at("_scores", -1)))
    # One pass over the scores; hosts, suffixes and declarations are counted from its groups.
    groups = cut_lineage(sure.groupBy("_host", "_suffix", "_declared", best.alias("_best")).agg(F.count("*").alias("_n")))
    declared_groups = groups.filter("_declared <> ''")
    every, spread = [0.0] * n, [0.0] * n
    for held, part in ((every, groups), (spread, declared_groups)):
        for row in part.groupBy("_best").agg(F.sum("_n").alias("_n")).collect():
            held[row["_best"]] = float(row["_n"])
    shares = F.array(*[F.lit((c + 1.0) / (sum(every) + n)) for c in every])
    suffixes = _counts(groups, ["_suffix"], n).select("_suffix", _log_shares(SUFFIX_WEIGHT, shares).alias("_by_suffix"))
    hosts = _counts(groups, ["_host", "_suffix"], n).join(suffixes, "_suffix").select(
        "_host", "_suffix", _log_shares(HOST_WEIGHT, F.transform("_by_suffix", lambda s: F.exp(s))).alias("_prior"))
    # P(declared | language): a declaration's share of the language, smoothed by its share of all rows.
    share = F.col("_total") / F.lit(sum(spread) or 1.0)
    of_language = F.zip_with("_counts", F.array(*[F.lit(c) for c in spread]), lambda c, all: F.log(
        (c + DECLARED_WEIGHT * share) / (all + DECLARED_WEIGHT)))
    declarations = _counts(declared_groups, ["_declared"], n).select(
        "_declared", F.concat(of_language, F.array(F.log(share))).alias("_says"))
    with_prior = join_dimension(found, cut_lineage(hosts), ["_host", "_suffix"], ["_id"])
    fused = join_dimension(with_prior, cut_lineage(declarations), ["_declared"], ["_id"])
    wide_prior = F.transform(shares, lambda s: F.log(s))
    prior, says = F.coalesce("_prior", wide_prior), F.coalesce("_says", F.array_repeat(F.lit(0.0), n + 1))
    unknown_odds = (F.lit(float(np.log(UNKNOWN_PRIOR / (1 - UNKNOWN_PRIOR)))) - F.sqrt("_left") * SCATTER) * F.col("_left") / F.greatest("_left", "_all")
    odds = F.when(F.col("_empty"), 0.0).otherwise(unknown_odds)
    priors = F.concat("_prior", F.array("_odds"))
    evidence = F.zip_with(F.zip_with("_scores", priors, lambda s, p: s + p), "_says", lambda s, d: s + d)
    weighed = fused.withColumns({"_prior": prior, "_says": says, "_odds": odds})
    top = weighed.withColumn("_e", evidence).withColumn("_m", F.array_max("_e")).withColumn(
        "_z", F.aggregate("_e", F.lit(0.0), lambda a, e: a + F.exp(e - F.col("_m"))))
    spoken_top = F.array_max(F.slice("_e", 1, n))
    posterior = F.when(F.col("_empty"), 0.0).otherwise(F.exp(spoken_top - F.col("_m")) / F.col("_z"))
    name = F.get(F.array(*[F.lit(x) for x in own.languages]), F.array_position("_e", spoken_top).cast("int") - 1)
    judged = top.withColumn("_p", posterior).withColumn("_ok", ~F.col("_empty") & (F.col("_p") >= LEAST_POSTERIOR))
    return judged.select(
        F.col("_id").alias(id), F.when(F.col("_ok"), name).alias("language"), F.col("_p").alias("posterior"),
        F.col("_ok").alias("kept"), *kept_columns)


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, lang, host, suffix) of `pages`(page_id, url, html): the evidence of a web page.

    Scripts, styles, comments and tags are removed; lang is the html element's, its first part in
    lower case; the suffix is the last label of the host.
    """
    markup = F.coalesce(F.col("html"), F.lit(""))
    bare = F.regexp_replace(markup, r"(?i)<(script|style)\b(?s:.*?)</\1\s*>|<!--(?s:.*?)-->|<[^>]*>", " ")
    lang = F.lower(F.regexp_extract(markup, r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z]+)""", 1))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"://([^/?#:]*)", 1))
    return pages.select(
        "page_id", bare.alias("text"), F.nullif(lang, F.lit("")).alias("lang"), F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"))
