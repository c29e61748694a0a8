"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source has a target of words. Its documents are the blocks: they are put in a permuted order
and taken pass by pass until the target is reached, the last one cut to fit. That fixes an exact
number of blocks per source. A binary tree over the output shards splits these quotas: at a node
the left half draws its share, source after source, from the hypergeometric distribution, and the
right half gets the rest. A shard then owns a disjoint run of each source's permuted blocks and is
shuffled by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import accumulate, cut_lineage, join_dimension, let, n_words, numbered, whole, words

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SHARDS = 16
SEED = "mix-1"
BUCKET_DIGITS = 3
# Up to this variance a draw searches the distribution, beyond it tries points by ratio of uniforms, at
# a cost that does not grow. Both follow the distribution exactly, but for the rounding of doubles.
SEARCH_VARIANCE = 1000.0
SEARCH_REACH = 12
# A try fails with probability 0.3 or so; after all of them the mode is taken.
TRIES = 60


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target, quota) of `sizes`(source, source_size): one row per source.

    Sources by code point, null last, weigh `weights` in turn and share all words. A target stops
    at `most` times the size and the excess is shared again. That is a water level: by ascending
    cap per weight, a source is capped while its cap does not exceed its share of what is left. The
    table has a row per source, not per document, so its windows are small.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = sizes.withColumn("w", F.get(F.array(*[F.lit(w).cast("bigint") for w in weights]), turn.cast("int")))
    every = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    level = weighed.withColumns({
        "cap": F.col("source_size") * most, "all": F.sum("source_size").over(every),
        "w_all": F.sum("w").over(every),
    }).withColumns({
        "cap_before": F.sum("cap").over(by_level) - F.col("cap"),
        "w_from": F.col("w_all") - F.sum("w").over(by_level) + F.col("w"),
    })
    wide = "decimal(38,0)"
    capped = level.withColumn(
        "capped", F.col("cap").cast(wide) * F.col("w_from") <= (F.col("all") - F.col("cap_before")).cast(wide) * F.col("w")
    )
    rest = capped.withColumns({
        "left_over": F.col("all") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every),
        "w_open": F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0)).over(every),
    })
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("w") * F.col("left_over")).cast("double") / F.col("w_open").cast("double")
    )
    return rest.select("source", "source_size", target.alias("target")).withColumn(
        "quota", F.floor(F.col("target") + 0.5).cast("bigint")
    )


def _ln_factorial(x: Column) -> Column:
    """Stirling's series at x + 8, less the logarithms of the eight factors above x."""
    y = x.cast("double") + 8.0
    product = F.lit(1.0)
    for k in range(1, 9):
        product = product * (x.cast("double") + float(k))
    series = 1 / (12 * y) - 1 / (360 * y * y * y)
    return y * F.log(y) - y + 0.5 * F.log(y * 6.283185307179586) + series - F.log(product)


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def _hypergeometric(total: Column, marked: Column, drawn: Column, u: Column, v: Column) -> Column:
    """How many of `marked` items out of `total` are among `drawn`, from uniform numbers u and v.

    The distribution is searched around its mean as far as it has weight. From a wide one, points under
    its hat are tried until one lies under the distribution itself.
    """
    t, k, n = (c.cast("double") for c in (F.greatest(total, F.lit(1).cast("bigint")), marked, drawn))
    zero = F.lit(0).cast("bigint")
    shape = F.struct(
        (n * k / t).alias("mean"),
        (n * k / t * (t - k) / t * (t - n) / F.greatest(t - 1, F.lit(1.0))).alias("variance"),
        F.greatest(zero, drawn + marked - total).alias("low"), F.least(drawn, marked).alias("high"),
    )

    def log_share(x: Column) -> Column:
        return -(_ln_factorial(x) + _ln_factorial(marked - x) + _ln_factorial(drawn - x)
                 + _ln_factorial(total - marked - drawn + x))

    def exact(s: Column) -> Column:
        wide = F.sqrt(s["variance"]) * SEARCH_REACH + SEARCH_REACH
        ends = F.struct(
            F.greatest(s["low"], F.floor(s["mean"] - wide).cast("bigint")).alias("first"),
            F.least(s["high"], F.ceil(s["mean"] + wide).cast("bigint")).alias("last"))

        def search(e: Column) -> Column:
            top = F.greatest(e["first"], F.least(e["last"], F.floor(s["mean"]).cast("bigint")))
            weights = let(let(top, log_share), lambda peak: F.transform(
                F.sequence(e["first"], e["last"]), lambda x: F.exp(log_share(x) - peak)))

            def steps(ws: Column) -> Column:
                start = F.struct(F.lit(0.0).alias("sum"), zero.alias("steps"))
                return let(u * F.aggregate(ws, F.lit(0.0), lambda a, w: a + w), lambda aim: F.aggregate(
                    ws, start, lambda a, w: F.struct(
                        (a["sum"] + w).alias("sum"),
                        (a["steps"] + F.when(a["sum"] + w < aim, 1).otherwise(0)).cast("bigint").alias("steps"))))

            return F.least(e["first"] + let(weights, steps)["steps"], e["last"])

        return let(ends, search)

    def tried(s: Column) -> Column:
        """Ratio of uniforms with the constants of the hat for such distributions, 2 sqrt(2 / e) and
        3 - 2 sqrt(3 / e); the numbers of each try are hashed from u and v."""
        hat = F.sqrt(s["variance"] + 0.5) * 1.7155277699214135 + 0.8989161620588988
        mode = F.greatest(s["low"], F.least(s["high"], F.floor((n + 1) * (k + 1) / (t + 2)).cast("bigint")))

        def attempt(top: Column) -> Callable[[Column, Column], Column]:
            def one(found: Column, number: Column) -> Column:
                high, side = (_uniform(F.lit(part), u, v, number) for part in ("height", "side"))
                at = F.floor(s["mean"] + 0.5 + hat * (side - 0.5) / high).cast("bigint")
                point = F.struct(F.log(high).alias("height"), at.alias("at"))
                return F.coalesce(found, let(point, lambda p: F.when(
                    (p["at"] >= s["low"]) & (p["at"] <= s["high"])
                    & (p["height"] * 2 <= log_share(F.greatest(s["low"], F.least(s["high"], p["at"]))) - top), p["at"])))

            return one

        def all_tries(top: Column) -> Column:
            numbers = F.sequence(F.lit(1), F.lit(TRIES))
            return F.aggregate(numbers, F.lit(None).cast("bigint"), attempt(top))

        return F.coalesce(let(let(mode, log_share), all_tries), mode)

    return let(shape, lambda s: F.when(s["low"] == s["high"], s["low"]).when(
        s["variance"] > SEARCH_VARIANCE, tried(s)).otherwise(exact(s))).cast("bigint")


def splitting_tree(quotas: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(shard, source, blocks) of `quotas`(source, blocks): exact quotas divided among the shards.

    A row per node holds one number per source; the tree has as many levels as `shards` has binary
    digits. Shard sizes in blocks differ by rounding only.
    """
    entry = F.struct(F.col("source").alias("source"), F.col("blocks").cast("bigint").alias("blocks"))
    nodes = quotas.agg(F.sort_array(F.collect_list(entry)).alias("quotas")).select(
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "quotas"
    )
    for _ in range((shards - 1).bit_length()):
        nodes = _split(nodes, seed)
    return nodes.select(F.col("lo").alias("shard"), F.explode("quotas").alias("q")).select(
        "shard", "q.source", "q.blocks"
    )


def _split(nodes: DataFrame, seed: str) -> DataFrame:
    """Replace each node of more than one shard by its halves."""
    zero = F.lit(0).cast("bigint")
    total = F.aggregate("quotas", zero, lambda a, q: a + q["blocks"])
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    measured = nodes.withColumns({"mid": mid, "total": total}).withColumn(
        "share", F.floor(F.col("total") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")) + 0.5).cast("bigint")
    )

    def draw(acc: Column, q: Column) -> Column:
        name = F.coalesce(F.concat(F.lit("="), q["source"]), F.lit(""))
        u, v = (_uniform(F.lit(f"{seed}-{k}"), F.col("lo"), F.col("hi"), name) for k in "uv")
        got = _hypergeometric(acc["total"], q["blocks"], acc["share"], u, v)
        got = F.when((q["blocks"] == 0) | (acc["share"] == 0), zero).otherwise(got)
        return let(got, lambda x: F.struct(
            (acc["total"] - q["blocks"]).alias("total"), (acc["share"] - x).alias("share"),
            F.concat(acc["taken"], F.array(x)).alias("taken")))

    start = F.struct(F.col("total").alias("total"), F.col("share").alias("share"),
                     F.array().cast("array<bigint>").alias("taken"))
    drawn = measured.withColumn("taken", F.aggregate("quotas", start, draw)["taken"])

    def side(count) -> Column:
        return F.transform("quotas", lambda q, i: F.struct(
            q["source"].alias("source"), count(q, F.get(F.col("taken"), i)).alias("blocks")))

    halves = F.array(
        F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), side(lambda q, t: t).alias("quotas")),
        F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), side(lambda q, t: q["blocks"] - t).alias("quotas")),
    )
    whole_node = F.array(F.struct("lo", "hi", "quotas"))
    return drawn.select(
        F.explode(F.when(F.col("hi") - F.col("lo") > 1, halves).otherwise(whole_node)).alias("n")
    ).select("n.*")


def draws(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, shards: int = SHARDS,
    seed: str = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, size, source, source_size, target, draws): a row per document with its drawn blocks.

    `draws` is an array of (pass, words, shard, place): `words` is the size of the document but for
    the one document per source that is cut to meet the target; `place` orders the shard. Null or
    empty texts have size 0 and are never drawn; a null source is a source of its own, last in
    order; documents are permuted by a hash of their id, those of one id follow each other by a digest of
    the text, so that runs agree; rows that repeat both are alike. Sources
    without words have target 0. No rows: no rows. Columns of `keep` are carried along.
    """
    order = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(id).alias("_id"), F.col(source).cast("string").alias("_source"),
        n_words(whole(text)).alias("_size"), F.md5(whole(text)).alias("_tie"), *[F.col(c).alias(f"_keep_{c}") for c in keep],
    ).withColumn("_order", order).withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit("")))
    if not keep:
        rows = cut_lineage(rows)
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size")).withColumnRenamed("_source", "source")
    aims = targets(sizes, weights, most).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_key"), "source_size", "target", "quota"
    )
    placed = accumulate(
        rows, ["_key"], [F.substring("_order", 1, BUCKET_DIGITS)], [F.col("_order"), F.col("_id"), F.col("_tie")],
        {"_before": F.col("_size"), "_rank": F.when(F.col("_size") > 0, 1).otherwise(0).cast("bigint")},
    )
    aimed = join_dimension(placed, cut_lineage(aims), ["_key"], ["_order"])
    passes = F.coalesce(F.expr("quota div nullif(source_size, 0)"), F.lit(0).cast("bigint"))
    rest = F.coalesce(F.expr("quota % nullif(source_size, 0)"), F.lit(0).cast("bigint"))
    last = F.least(F.col("_size"), F.greatest(F.lit(0).cast("bigint"), rest - F.col("_before")))
    counted = aimed.withColumns({"_passes": passes, "_last": last})
    by_source = cut_lineage(counted.groupBy("_key").agg(
        F.sum(F.when(F.col("_size") > 0, 1).otherwise(0)).alias("_blocks"),
        F.sum(F.when(F.col("_size") > 0, F.col("_passes")).otherwise(0) + F.when(F.col("_last") > 0, 1).otherwise(0)).alias("blocks"),
    ))
    tree = splitting_tree(by_source.select(F.col("_key").alias("source"), "blocks"), shards, seed)
    runs = tree.groupBy("source").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("shard", "blocks"))), lambda x: x["blocks"]).alias("_runs"))
    ends = F.transform("_runs", lambda x, i: F.aggregate(
        F.slice("_runs", 1, i + 1), F.lit(0).cast("bigint"), lambda a, y: a + y))
    owned = by_source.join(runs.withColumnRenamed("source", "_key"), "_key").select(
        "_key", "_blocks", ends.alias("_ends"))
    found = join_dimension(counted, cut_lineage(owned), ["_key"], ["_order"])

    def one(number: Column, count: Column) -> Column:
        index = number * F.col("_blocks") + F.col("_rank")
        return F.struct(
            number.alias("pass"), count.alias("words"),
            F.size(F.filter("_ends", lambda e: e <= index)).alias("shard"),
            F.md5(F.concat_ws("/", F.col("_order"), number.cast("string"))).alias("place"),
        )

    full = F.when(F.col("_passes") > 0, F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("_passes") - 1), lambda p: one(p, F.col("_size"))))
    cut = F.when(F.col("_last") > 0, F.array(one(F.col("_passes"), F.col("_last"))))
    none = F.array().cast("array<struct<pass:bigint,words:bigint,shard:int,place:string>>")
    drawn = F.when(F.col("_size") == 0, none).otherwise(
        F.concat(F.coalesce(full, none), F.coalesce(cut, none)))
    return found.select(
        F.col("_id").alias(id), F.col("_size").alias("size"), F.col("_source").alias(source),
        "source_size", "target", drawn.alias("draws"), *[F.col(f"_keep_{c}").alias(c) for c in keep if c not in (id, source)],
    )


def mixed_documents(docs: DataFrame, columns: list[str], **options) -> DataFrame:
    """The mix itself: a row of `columns` per drawn block, with its shard, ordered by `place` inside it.

    `columns` name doc_id, text and source among others, and may have any name; _shard and _place of the
    mix take the place of columns named so. The text of a cut block is its first words, joined by blanks. Rows lie by (shard, place) over all partitions, which are ranges of it, so a
    large shard takes several and what is written keeps the order.
    """
    rows, names = numbered(docs.select(*columns))
    at = {c: names[options.get(c, d)] for c, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))}
    drawn = draws(rows, keep=tuple(names.values()), **{**options, **at}).withColumn("_draw", F.explode("draws"))
    cut = F.array_join(F.slice(words(whole(at["text"])), 1, F.col("_draw.words").cast("int")), " ")
    shortened = F.when(F.col("_draw.words") < F.col("size"), cut).otherwise(F.col(at["text"]))
    mix = drawn.withColumn(at["text"], shortened).select(
        *[F.col(n).alias(c) for c, n in names.items() if c not in ("_shard", "_place")],
        F.col("_draw.shard").alias("_shard"), F.col("_draw.place").alias("_place"))
    return mix.repartitionByRange("_shard", "_place").sortWithinPartitions("_shard", "_place")


def taken_words(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words the mix takes of each document."""
    taken = F.aggregate("draws", F.lit(0).cast("bigint"), lambda a, d: a + F.when(
        (d["shard"] >= 0) & (d["shard"] < SHARDS), d["words"]).otherwise(F.lit(0).cast("bigint")))
    return draws(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"))
