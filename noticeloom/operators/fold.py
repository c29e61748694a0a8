"""Fold announcements that several boards carry, by similarity of their titles.

Titles are compared as sets of character n-grams (Jaccard). Equal titles become one node first,
so copies never meet each other. Nodes meet only on their rarest n-grams, and the search is exact:
two sets with similarity t share k of the first |x| - ceil(t|x|) + k grams of any common order. Threshold and gram length are our choice; there is no published one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean, let
from ..session import cut_lineage

GRAM = 3
THRESHOLD = 0.8
# The order of grams needs only be common to all titles. Counting them in a fixed number of
# classes keeps the count table below this many rows, whatever the data.
CLASSES = 1 << 16
# Another turn of centres is taken while the last one left at most this share of the parts.
PROGRESS = 0.9


def title_key(title: Column) -> Column:
    return F.lower(clean(title))


def grams(title: Column, n: int = GRAM) -> Column:
    """Distinct n-grams of a text; a shorter text is its own gram.

    Up to three characters fit into one number, 21 bits each, which is compared much faster than
    a string. The numbering is one to one.
    """

    def code(start: Column) -> Column:
        total = F.lit(0).cast("bigint")
        for offset in range(n):
            point = F.ascii(F.substring(title, start + offset, F.lit(1))).cast("bigint")
            present = start + offset <= F.char_length(title)
            total = total * (1 << 21) + F.when(present, point + 1).otherwise(0)
        return total

    starts = F.sequence(F.lit(1), F.greatest(F.char_length(title) - (n - 1), F.lit(1)))
    gram = code if n <= 3 else (lambda i: F.substring(title, i, F.lit(n)))
    return F.array_distinct(F.transform(starts, gram))


def _nodes(df: DataFrame, title: str, key: str, n: int) -> DataFrame:
    """One row per distinct title: node, name, lo and hi source, smallest key, grams."""
    named = df.select(title_key(F.col(title)).alias("name"), "source", F.col(key).alias("key"))
    distinct = named.filter(F.col("name") != "").groupBy("name").agg(
        F.min("source").alias("lo"), F.max("source").alias("hi"), F.min("key").alias("key")
    )
    # The number is read from files afterwards, so it does not change.
    return cut_lineage(
        distinct.withColumn("node", F.monotonically_increasing_id()).withColumn(
            "grams", grams(F.col("name"), n)
        )
    )


def _ordered(nodes: DataFrame) -> DataFrame:
    """Nodes with their grams from rare to frequent: node, name, lo, hi, key, grams, size."""
    single = nodes.select("node", F.explode("grams").alias("gram"))
    single = single.withColumn("_class", F.pmod(F.xxhash64("gram"), F.lit(CLASSES)))
    counts = single.groupBy("_class").agg(F.count("*").alias("_n"))
    ordered = (
        single.join(F.broadcast(counts), "_class")  # at most CLASSES rows
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("_n", "gram"))).alias("_sorted"))
        .select("node", F.col("_sorted.gram").alias("grams"))
    )
    return cut_lineage(
        nodes.drop("grams").join(ordered, "node").withColumn("size", F.size("grams"))
    )


def _entries(ordered: DataFrame, threshold: float, pairs: bool) -> DataFrame:
    """One row per node and key: with `pairs` two prefix grams make a key, else one.

    Two sets with similarity t have k grams in common within the first |x| - ceil(t|x|) + k of
    each, where they share so many at all: sets of one gram have a single key.
    """
    needed = F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    prefix = F.slice("grams", F.lit(1), F.col("size") - needed + (2 if pairs else 1))
    # The gram lists stay behind: an entry exists once per key.
    keyed = ordered.withColumn("prefix", prefix).drop("grams", "name", "key")
    if not pairs:
        return keyed.withColumn("gram", F.explode("prefix"))
    # Of two titles the shorter one needs to show fewer grams: its keys within them are marked.
    least = F.ceil(F.col("size") * F.lit(2 * threshold / (1 + threshold)) - F.lit(1e-9)).cast("int")
    shown = F.col("size") - least + 2

    def key(of: Column, last: Column) -> Column:
        return F.struct(of.cast("string").alias("gram"), (last <= shown).alias("shown"))

    two = F.flatten(F.transform(
        "prefix", lambda g, at: F.transform(
            F.slice("prefix", at + 2, F.size("prefix")),
            lambda h, further: key(F.xxhash64(g, h), at + further + 2),
        )
    ))
    one = F.transform("prefix", lambda g, at: key(g, at + 1))
    keys = F.when(F.col("size") == 1, one).otherwise(two)
    return keyed.withColumn("_key", F.explode(keys)).select("*", "_key.*").drop("_key")


def _first_key(pairs: bool) -> Column:
    """The key by which two entries meet first."""
    def first(shared: Column) -> Column:
        one = F.get(shared, F.lit(0))
        if not pairs:
            return one
        both = F.xxhash64(one, F.get(shared, F.lit(1)))
        return F.when(F.size(shared) > 1, both.cast("string")).otherwise(one.cast("string"))

    return let(F.array_intersect("a_prefix", "b_prefix"), first)


def _source_class(prefix: str = "") -> Column:
    """Name of a node's only source, null for a node that several sources carry."""
    lo, hi = F.col(f"{prefix}lo"), F.col(f"{prefix}hi")
    return F.when(lo == hi, F.concat(F.lit("s"), lo))


def _mark_main(entries: DataFrame, classes: list[Column]) -> DataFrame:
    """Mark the entries of a gram that belong to its largest class.

    Two entries of one class need no comparison, so those of the largest class are only compared
    with the rest. A gram whose entries are all of one class costs nothing.
    """
    named = F.array_compact(F.array(*classes))
    counts = entries.select("gram", F.explode(named).alias("_class")).groupBy("gram", "_class").agg(
        F.count("*").alias("_n")
    )
    main = counts.groupBy("gram").agg(F.max_by("_class", F.struct("_n", "_class")).alias("_main"))
    marked = entries.join(main, "gram", "left")
    in_main = F.coalesce(F.array_contains(named, F.col("_main")), F.lit(False))
    return cut_lineage(marked.withColumn("main", in_main).drop("_main"))


def _verified(
    left: DataFrame, right: DataFrame, ordered: DataFrame, threshold: float, needed: Column,
    on: tuple[str, ...] = ("gram",), once: bool = False,
) -> DataFrame:
    """Similar pairs of entries that are equal in `on`, lie on different sources and are `needed`.

    `needed` is a cheap test on a_ and b_ columns. With `once`, for entries with pairs as keys, two
    titles are candidates only where they meet first; otherwise repeats are removed. Only then are
    the gram lists fetched.
    """
    a = left.select(*on, *[F.col(c).alias(f"a_{c}") for c in left.columns if c != "gram"])
    b = right.select(*on, *[F.col(c).alias(f"b_{c}") for c in right.columns if c != "gram"])
    one_source = F.coalesce(_source_class("a_") == _source_class("b_"), F.lit(False))
    near = F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * threshold - 1e-9
    test = needed & ~one_source & near
    if once:
        # Nested, so that prefixes are only compared where the cheap tests hold.
        test = F.when(test, _first_key(pairs=True) == F.col("gram")).otherwise(False)
    carried = [c for c in ("a_node", "b_node", "a_part", "b_part") if c in (*a.columns, *b.columns)]
    candidates = a.join(b, list(on)).filter(test).select(*carried)
    if not once:
        candidates = candidates.distinct()
    lists = ordered.select("node", "name", "grams")
    full = candidates.join(lists.select(*[F.col(c).alias(f"a_{c}") for c in lists.columns]), "a_node").join(
        lists.select(*[F.col(c).alias(f"b_{c}") for c in lists.columns]), "b_node"
    )

    def jaccard(common: Column) -> Column:
        return common / (F.size("a_grams") + F.size("b_grams") - common)

    sim = let(F.size(F.array_intersect("a_grams", "b_grams")), jaccard)
    return full.select(*carried, "a_name", "b_name", sim.alias("sim")).filter(
        F.col("sim") >= threshold
    )


def _compare(
    marked: DataFrame, ordered: DataFrame, threshold: float, needed: Column | None = None
) -> DataFrame:
    """All similar pairs but those inside the largest class of a key: a the longer title."""
    order = (F.col("b_size") < F.col("a_size")) | (
        (F.col("b_size") == F.col("a_size")) & (F.col("b_node") < F.col("a_node"))
    )
    test = order if needed is None else order & needed
    main, shown = F.col("main"), F.col("shown")
    sides = ((marked.filter(~main), marked.filter(shown)), (marked.filter(main), marked.filter(shown & ~main)))
    first, second = (
        _verified(left, right, ordered, threshold, test, once=True) for left, right in sides
    )
    return first.unionByName(second)


def similar_titles(
    df: DataFrame, title: str = "title", key: str = "id", n: int = GRAM,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(a, b, sim): pairs of different titles of different sources, a < b.

    Each pair comes from the first key it shares, so no distinct is needed. For folding use
    `fold_titles`, which does not list the pairs of a large cluster.
    """
    _check(threshold)
    ordered = _ordered(_nodes(df, title, key, n))
    marked = _mark_main(_entries(ordered, threshold, pairs=True), [_source_class()])
    return _compare(marked, ordered, threshold).select(
        F.least("a_name", "b_name").alias("a"), F.greatest("a_name", "b_name").alias("b"), "sim"
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label): smallest node of each connected part of the edges (a, b).

    Every round takes the smallest label among neighbours and then the label of that label, and
    ends when no label changed. Only counts reach the driver.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    links = cut_lineage(both.distinct())
    labels = cut_lineage(
        links.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    )
    while True:
        named = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        smallest = links.join(named, "other").groupBy("node").agg(F.min("near").alias("near"))
        lowered = labels.join(smallest, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("before")
        )
        # Labels that are no longer their own label point further down.
        moved = lowered.filter(F.col("node") != F.col("label")).select(
            F.col("node").alias("label"), F.col("label").alias("root")
        )
        jumped = lowered.join(moved, "label", "left").select(
            "node", F.coalesce("root", "label").alias("label"), "before"
        )
        after = cut_lineage(jumped)
        labels = after.select("node", "label")
        if after.filter(F.col("label") != F.col("before")).isEmpty():
            return labels


def _centres(placed: DataFrame, turn: int) -> DataFrame:
    """Two entries per gram and title length, of different sources where there are any.

    Entries of one source are not linked with each other, so a cluster needs a centre outside it.
    Another turn takes other centres.
    """
    payload = [c for c in placed.columns if c not in ("gram", "size")]
    chance = F.xxhash64("node", F.lit(turn))
    rank = F.struct(F.coalesce(_source_class(), F.lit("m")), chance)
    both = placed.groupBy("gram", "size").agg(
        F.min_by(F.struct(*payload), rank).alias("low"), F.max_by(F.struct(*payload), rank).alias("high")
    )
    each = both.select("gram", "size", F.explode(F.array("low", "high")).alias("centre"))
    return each.select("gram", "size", "centre.*")


def _merge(state: DataFrame, links: DataFrame) -> DataFrame:
    """Give linked parts one label."""
    edges = links.select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))
    merged = components(edges).withColumnRenamed("node", "part")
    return cut_lineage(
        state.join(merged, "part", "left")
        .withColumn("linked", F.col("linked") | F.col("label").isNotNull())
        .withColumn("part", F.coalesce("label", "part")).drop("label")
    )


def _parts(state: DataFrame) -> int:
    return state.select("part").distinct().count()


def _check(threshold: float) -> None:
    if not 0.5 < threshold <= 1:
        raise ValueError("the threshold must lie above 0.5 and not above 1")


def fold_titles(
    df: DataFrame, title: str = "title", key: str = "id", n: int = GRAM,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, group): the smallest key among the items that are the same across sources.

    Items are linked when they lie on different sources and their titles are equal or similar;
    groups are transitive. `key` must be unique. First, turn by turn, each title is compared with
    two centres per prefix gram and title length, which joins large clusters without comparing
    their members; this goes on while it joins much. Then what is still apart is compared in
    full, by pairs of prefix grams: titles outside the largest part or source of a pair with all
    titles of the pair.
    """
    _check(threshold)
    ordered = _ordered(_nodes(df, title, key, n))
    apart = F.col("a_part") != F.col("b_part")
    state = cut_lineage(
        ordered.select("node", F.col("node").alias("part"), F.lit(False).alias("linked"))
    )
    before, now, turn = None, _parts(state), 0
    while before is None or now < before * PROGRESS:
        placed = _entries(ordered.join(state, "node"), threshold, pairs=False)
        links = _verified(
            _centres(placed, turn), placed, ordered, threshold, apart, ("gram", "size")
        )
        state = _merge(state, links)
        before, now, turn = now, _parts(state), turn + 1
    placed = _entries(ordered.join(state, "node"), threshold, pairs=True)
    marked = _mark_main(placed, [F.concat(F.lit("p"), "part"), _source_class()])
    rest = _compare(marked, ordered, threshold, apart)
    whole = _merge(state, rest)
    grouped = ordered.select("node", "name", "lo", "hi", "key").join(whole, "node").filter(
        F.col("linked") | (F.col("lo") != F.col("hi"))
    )
    first = grouped.groupBy("part").agg(F.min("key").alias("group"))
    names = grouped.join(first, "part").select("name", "group")
    named = df.select(F.col(key).alias("key"), title_key(F.col(title)).alias("name"))
    return named.join(names, "name", "left").select(
        "key", F.coalesce("group", "key").alias("group")
    )


def fold_sources(items: DataFrame, groups: DataFrame, key: str = "id") -> DataFrame:
    """(group, source, items): on which sources each folded announcement appears."""
    return (
        items.select(F.col(key).alias("key"), "source").join(groups, "key")
        .groupBy("group", "source").agg(F.count("*").alias("items"))
    )
