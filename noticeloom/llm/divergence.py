"""Quality rules by distribution divergence: documents far from every language reference are dropped.

A document has two histograms, of character classes and of common words. The references are the
same histograms summed over all documents of a language. The Jensen-Shannon distance to the nearest
reference decides, for texts long enough for the histogram to mean something.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, cut_lineage, let, whole, words

# Frequent function words of each language, by rank.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem".split(),
    "en": "the of and to in a is that for it on with as was be by".split(),
    "es": "de la que el en y a los se del las por un para con una".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par".split(),
}
# Jensen-Shannon distance is the root of the divergence in bits; the limits are divergences.
CHARACTER_LIMIT = 0.09
WORD_LIMIT = 0.11
LEAST_CHARS = 300
LEAST_WORDS = 100
FEWEST_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
# Classes are taken off one after the other; what is left is the last class.
CLASSES = {
    "lower": "[a-z]+", "space": SPACE, "beyond": r"[^\x00-\x7F]+", "mark": r"[.,;:!?'\"()\-]+",
    "upper": "[A-Z]+", "digit": "[0-9]+", "symbol": "[#*$%&|<>]+",
}
EDGES = ".,;:!?'\"()-"
# Repeated windows up to this number are looked up in a list, more of them by sorting.
FEW_WINDOWS = 64


def _repeats(w: Column, hashes: Column) -> Column:
    """Words that lie in three-word windows found twice or more; `hashes` has one per window.

    Windows are equal when their 64-bit hashes are.
    """
    zero = F.lit(0).cast("bigint")

    def covered(at: Column) -> Column:
        # Each window covers its words up to the next covering window.
        return F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
            zero, lambda a, x: a + x)

    def by_list(h: Column, found: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(found, F.get(h, i)))
        return let(places, covered)

    def by_sort(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = let(pairs, lambda p: F.filter(p, lambda e, k: (
            (k > 0) & (F.get(p, k - 1)["x"] == e["x"])) | F.coalesce(F.get(p, k + 1)["x"] == e["x"], F.lit(False))))
        return let(F.array_sort(F.transform(twice, lambda e: e["i"])), covered)

    def counted(h: Column) -> Column:
        ordered = F.array_sort(h)
        found = let(ordered, lambda s: F.array_distinct(F.filter(s, lambda x, k: (k > 0) & (F.get(s, k - 1) == x))))
        return let(found, lambda d: F.when(F.size(d) <= FEW_WINDOWS, by_list(h, d)).otherwise(by_sort(h)))

    same = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when((F.size(w) < 3) | same, zero).otherwise(let(hashes, counted)).cast("bigint")


def features(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, chars, common).

    `chars` is the histogram of character classes, `common` the counts of the common words of any
    language that occur, after A-Z and edge marks are removed.
    """
    base = docs.select(F.col(id).alias(id), F.col(lang).cast("string").alias("lang"), whole(text).alias("_t"))
    left, counts = base.withColumns({"_r0": F.col("_t"), "_w": words(F.col("_t"))}), []
    for k, (name, pattern) in enumerate(CLASSES.items()):
        left = left.withColumn(f"_r{k + 1}", F.regexp_replace(f"_r{k}", pattern, ""))
        counts.append((F.length(f"_r{k}") - F.length(f"_r{k + 1}")).cast("bigint").alias(name))
    chars = F.struct(*counts, F.length(f"_r{len(CLASSES)}").cast("bigint").alias("other"))
    symbols = (F.length("_r6") - F.length("_r7")).cast("bigint")
    triple = F.transform(
        F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)))
    known = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    plain = F.filter(
        F.transform(F.split(F.lower(F.col("_t")), SPACE), lambda x: F.btrim(x, F.lit(EDGES))),
        lambda x: x.isin(*known))
    common = let(F.array_sort(plain), lambda c: let(F.array_distinct(c), lambda d: F.transform(
        d, lambda x, i: F.struct(x.alias("word"), (
            F.coalesce(F.array_position(c, F.get(d, i + 1)), F.size(c) + 1) - F.array_position(c, x)
        ).cast("bigint").alias("n")))))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    shaped = left.select(
        id, "lang", "_w", triple.alias("_h"), chars.alias("chars"), symbols.alias("n_symbols"),
        common.alias("common"), lines.alias("_lines"),
    )
    return shaped.select(
        id, "lang", F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"), "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeats(F.col("_w"), F.col("_h")).alias("n_repeat_words"), "chars", "common",
    )


def references(measured: DataFrame) -> dict[str, tuple[list[float], dict[str, float]]]:
    """Per language with a word list: shares of the character classes and of its common words.

    Sums over all documents of the language; what reaches the driver has a fixed size.
    """
    known = measured.filter(F.col("lang").isin(*COMMON_WORDS))
    names = [*CLASSES, "other"]
    totals = known.groupBy("lang").agg(
        F.sum("n_words").alias("n"), *[F.sum(f"chars.{c}").alias(c) for c in names]).collect()
    seen = known.select("lang", F.explode("common").alias("c")).groupBy("lang", "c.word").agg(
        F.sum("c.n").alias("n")).collect()
    out = {}
    for row in totals:
        letters, n = sum(row[c] for c in names), row["n"]
        if letters and n:
            shares = {r["word"]: r["n"] / n for r in seen if r["lang"] == row["lang"] and r["word"] in COMMON_WORDS[row["lang"]]}
            out[row["lang"]] = ([row[c] / letters for c in names], shares)
    return out


def _part(p: Column, q: Column) -> Column:
    """A bin's share of the divergence, in bits."""
    m = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2


def _character_divergence(shares: list[float]) -> Column:
    names = [*CLASSES, "other"]
    total = reduce(lambda a, b: a + b, [F.col(f"chars.{c}") for c in names]).cast("double")
    return reduce(lambda a, b: a + b, [_part(F.col(f"chars.{c}") / F.nullif(total, F.lit(0.0)), F.lit(q)) for c, q in zip(names, shares)])


def _word_divergence(shares: dict[str, float]) -> Column:
    """Bins are the common words of the reference and all other words."""
    table = F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair])
    n = F.nullif(F.col("n_words"), F.lit(0).cast("bigint")).cast("double")
    own = F.filter("common", lambda c: c["word"].isin(*sorted(shares)))

    def total(present: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

        def add(a: Column, c: Column) -> Column:
            p, q = c["n"] / n, F.element_at(table, c["word"])
            return F.struct((a["sum"] + _part(p, q)).alias("sum"), (a["p"] + p).alias("p"), (a["q"] + q).alias("q"))

        def close(a: Column) -> Column:
            # Words of the reference that the document lacks count half their share.
            unseen = F.lit(sum(shares.values())) - a["q"]
            rest = _part(F.greatest(1 - a["p"], F.lit(0.0)), F.lit(1 - sum(shares.values())))
            return a["sum"] + F.greatest(unseen, F.lit(0.0)) / 2 + rest

        return F.aggregate(present, start, add, close)

    return F.when(n.isNotNull(), let(own, total)) if shares else F.lit(None).cast("double")


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The features of every document with base_failed, divergences and `kept`.

    base_failed: fewer than 50 words, or more than half of them in repeated windows. Otherwise a
    document is dropped when its character histogram (texts of LEAST_CHARS on) or its common-word
    histogram (LEAST_WORDS on) is further than the limit from all language references. A declared
    language that has documents but no word list has no reference and no verdict: such documents are
    kept, as are all where no reference exists. Null texts count as empty; a null language is compared
    with all references. Repeated rows are judged each; no rows: no rows.
    """
    measured = cut_lineage(features(docs, id, text, lang))
    known = references(measured)
    null = F.lit(None).cast("double")
    by_char = [_character_divergence(chars) for chars, _ in known.values()]
    by_word = [_word_divergence(shares) for _, shares in known.values()]
    nearest = lambda cs: F.array_min(F.array(*cs)) if cs else null
    failed = (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    n_chars = reduce(lambda a, b: a + b, [F.col(f"chars.{c}") for c in [*CLASSES, "other"]])
    far = ((n_chars >= LEAST_CHARS) & (F.col("char_divergence") > CHARACTER_LIMIT)) | (
        (F.col("n_words") >= LEAST_WORDS) & (F.col("word_divergence") > WORD_LIMIT))
    foreign = F.col("lang").isNotNull() & ~F.col("lang").isin(*COMMON_WORDS)
    return measured.withColumns({
        "char_divergence": nearest(by_char), "word_divergence": nearest(by_word), "base_failed": failed,
    }).withColumn("kept", ~F.col("base_failed") & (foreign | ~F.coalesce(far, F.lit(False))))
