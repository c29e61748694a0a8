"""Roadmaps by components: how many ways there are, and the k shortest, without listing all of them.

A way that visits no state twice crosses every strongly connected component in one stretch, because
components form a graph without cycles. So only the stretches inside components are listed; ways are
counted and ranked by dynamic programming over the states at which components are entered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

COUNT = "decimal(38,0)"


def _grown(edges: DataFrame, seeds: DataFrame, source: str, target: str) -> DataFrame:
    """States with a colour, spread along edges from `source` to `target` inside the same `zone`.

    seeds: state, zone, colour; the largest colour that reaches a state stays. edges: with `zone`.
    """
    held = seeds
    while True:
        reached = held.join(edges.select(F.col(source).alias("state"), F.col(target).alias("to"), "zone"), ["state", "zone"])
        offered = reached.select(F.col("to").alias("state"), "zone", "colour")
        new = cut_lineage(held.withColumn("old", F.col("colour")).unionByName(
            offered.withColumn("old", F.lit(None).cast("string"))).groupBy("state", "zone").agg(
            F.max("colour").alias("colour"), F.max("old").alias("old")))
        moved = not new.filter(F.col("old").isNull() | (F.col("colour") > F.col("old"))).isEmpty()
        held = new.drop("old")
        if not moved:
            return held


def strong_components(edges: DataFrame) -> DataFrame:
    """(state, component): states that reach each other share the name of one of them.

    Every round colours all states forward with the largest name that reaches them; the states that
    reach back to the state of that name inside its colour are a component. The others go on with
    their colour as their zone, so all zones are worked on at once. States that have no way in or no
    way out inside their zone are components of their own and leave first.
    """
    links = cut_lineage(edges.select("from_state", "to_state").distinct())
    states = links.select(F.col("from_state").alias("state")).union(links.select("to_state")).distinct()
    left = cut_lineage(states.withColumn("zone", F.lit("")))
    found = None

    def keep(rows: DataFrame) -> None:
        nonlocal found
        rows = rows.select("state", "component")
        found = rows if found is None else found.unionByName(rows)

    while not left.isEmpty():
        one, two = (left.select(F.col("state").alias(c), F.col("zone")) for c in ("from_state", "to_state"))
        inside = cut_lineage(links.filter("from_state <> to_state").join(one, "from_state").join(two, ["to_state", "zone"]))
        through = cut_lineage(inside.select(F.col("from_state").alias("state")).intersect(inside.select("to_state")))
        lone = left.join(through, "state", "left_anti").withColumn("component", F.col("state"))
        keep(cut_lineage(lone))
        rest = left.join(through, "state", "left_semi")
        for c in ("from_state", "to_state"):
            inside = inside.join(through.withColumnRenamed("state", c), c, "left_semi")
        inside = cut_lineage(inside)
        coloured = _grown(inside, rest.withColumn("colour", F.col("state")), "from_state", "to_state")
        zone = F.concat_ws("\0", "zone", "colour")
        shaded = cut_lineage(coloured.select("state", zone.alias("zone"), "colour"))
        a, b = (shaded.select(F.col("state").alias(c), F.col("zone")) for c in ("from_state", "to_state"))
        same = cut_lineage(inside.drop("zone").join(a, "from_state").join(b, ["to_state", "zone"]))
        roots = shaded.filter(F.col("state") == F.col("colour"))
        back = _grown(same, roots, "to_state", "from_state")
        keep(cut_lineage(back.withColumn("component", F.col("colour"))))
        left = cut_lineage(shaded.join(back.select("state"), "state", "left_anti").select("state", "zone"))
    return found if found is not None else left.select("state", F.col("zone").alias("component"))


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("steps", "path")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def stretches(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(entry, exit, path, steps): all ways inside a component that visit no state twice.

    A state alone is the way of no step from itself to itself. Ways are listed inside components only:
    their number is what makes counting hard, and components of a roadmap are small.
    """
    at = components.select("state", "component")
    inner = cut_lineage(
        edges.select("from_state", "to_state").distinct()
        .join(at.select(F.col("state").alias("from_state"), "component"), "from_state")
        .join(at.select(F.col("state").alias("to_state"), "component"), ["to_state", "component"])
        .select("from_state", "to_state"))
    paths = cut_lineage(at.select(F.col("state").alias("entry"), F.col("state").alias("exit"), F.array("state").alias("path")))
    every = paths
    while True:
        paths = cut_lineage(
            paths.join(inner, F.col("exit") == F.col("from_state")).filter(~F.array_contains("path", F.col("to_state")))
            .select("entry", F.col("to_state").alias("exit"), F.concat("path", F.array("to_state")).alias("path")))
        if paths.isEmpty():
            break
        every = every.unionByName(paths)
    return every.withColumn("steps", (F.size("path") - 1).cast("bigint"))


def ranked_roadmap(edges: DataFrame, starts: DataFrame, goals: DataFrame, k: int = 3) -> DataFrame:
    """(start, goal, rank, path, steps, ways): the k shortest ways, and how many ways there are.

    edges: from_state, to_state; starts, goals: state. Ways visit no state twice, have a step at least,
    and are ranked by steps, then by their states. Null states belong to no way; repeated rows count
    once. Rows are bounded by k x starts x goals, and tables on the way by k x starts x states.
    """
    links = cut_lineage(edges.filter("from_state is not null and to_state is not null").select("from_state", "to_state").distinct())
    begin = starts.filter("state is not null").select("state").distinct()
    # States without any edge are components too, so that every start has one.
    alone = begin.withColumnRenamed("state", "from_state").withColumn("to_state", F.col("from_state"))
    components = cut_lineage(strong_components(links.unionByName(alone)))
    inside = cut_lineage(stretches(links, components))
    name = lambda c: components.select(F.col("state").alias(c), F.col("component").alias(f"{c}_in"))
    across = cut_lineage(
        links.join(name("from_state"), "from_state").join(name("to_state"), "to_state")
        .filter("from_state_in <> to_state_in").select(F.col("from_state").alias("exit"), F.col("to_state").alias("next")))
    # From an entry of one component to an entry of another: a stretch, then an edge.
    leaps = inside.join(across, "exit").select("entry", "next", "path", "steps")
    hops = cut_lineage(leaps.groupBy("entry", "next").agg(F.count("*").cast(COUNT).alias("n")))
    short = cut_lineage(_best(leaps, ["entry", "next"], k).select("entry", "next", "path", "steps"))

    one = F.lit(1).cast(COUNT)
    ways = begin.select(F.col("state").alias("start"), F.col("state").alias("entry"), one.alias("n"))
    best = begin.select(
        F.col("state").alias("start"), F.col("state").alias("entry"), F.array().cast("array<string>").alias("before"),
        F.lit(0).cast("bigint").alias("gone"))
    ways, best = cut_lineage(ways), cut_lineage(best)
    all_ways, all_best = ways, best
    while True:
        total = F.sum(F.col("n") * F.col("m")).cast(COUNT).alias("n")
        ways = cut_lineage(
            ways.join(hops.withColumnRenamed("n", "m"), "entry").groupBy("start", F.col("next").alias("entry")).agg(total))
        if ways.isEmpty():
            break
        longer = best.join(short, "entry").select(
            "start", F.col("next").alias("entry"), F.concat("before", "path").alias("path"),
            (F.col("gone") + F.col("steps") + 1).alias("steps"))
        best = cut_lineage(_best(longer, ["start", "entry"], k).select(
            "start", "entry", F.col("path").alias("before"), F.col("steps").alias("gone")))
        all_ways, all_best = all_ways.unionByName(ways), all_best.unionByName(best)

    ends = cut_lineage(inside.join(goals.select(F.col("state").alias("exit")).distinct(), "exit", "left_semi"))
    last = ends.groupBy("entry", "exit").agg(F.count("*").cast(COUNT).alias("m"))
    moved = F.col("start") != F.col("exit")
    counted = all_ways.join(last, "entry").filter(moved).groupBy("start", F.col("exit").alias("goal")).agg(
        F.sum(F.col("n") * F.col("m")).cast(COUNT).alias("ways"))
    tails = _best(ends, ["entry", "exit"], k).select("entry", "exit", "path", "steps")
    listed = all_best.join(tails, "entry").filter(moved).select(
        "start", F.col("exit").alias("goal"), F.concat("before", "path").alias("path"), (F.col("gone") + F.col("steps")).alias("steps"))
    return _best(listed, ["start", "goal"], k).join(counted, ["start", "goal"]).select(
        "start", "goal", "rank", "path", "steps", "ways")
