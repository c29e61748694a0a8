"""URL filter by link-graph propagation: trust along host edges, distrust against them.

Rules decide the urls they fit. Their decisions seed a personalised PageRank over hosts: trust flows
from hosts with allowed pages along links, distrust flows from hosts with blocked pages to the hosts
that link to them. Scores are whole numbers, so sums do not depend on their order and runs agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage, join_dimension

# (host, path, verdict); a host fits itself and its subdomains.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# A seed whose pages are all decided alike starts with UNIT; seeds stay below 2**63 / (100 * UNIT).
UNIT = 100_000_000
DAMPING_PERCENT = 85
# Turns end when the scores of all hosts together moved by less than this share of the seeds.
TOLERANCE = 0.001
TURNS_PER_TABLE = 8
# A host is blocked when its distrust exceeds its trust and is no less than what a wholly blocked host
# passes to each of eight hosts that link to it: its restart, damped once, in eight parts.
LEAST_DISTRUST = UNIT * (100 - DAMPING_PERCENT) // 100 * DAMPING_PERCENT // 800
EDGES_PER_SALT = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies between the first `://` and `/`, `?`, `#`, with A-Z lowered; then up to `?`, `#`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, host: Column, html: str = "html") -> DataFrame:
    """(src, dst): different hosts, src having a page that links to dst, or being one site with it.

    Links are absolute addresses in href and src. A host and the domain it lies in (of two labels at
    least) are linked both ways, since their pages belong together. Edges count once.
    """
    from_page = pages.select(host.alias("src"), F.col(html).alias("_html")).filter("src <> ''")
    linked = from_page.select("src", F.explode(F.array_distinct(
        F.regexp_extract_all(F.coalesce(F.col("_html"), F.lit("")), F.lit(LINK), F.lit(1)))).alias("dst"))
    links = linked.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).distinct()
    parent = F.regexp_extract("src", r"^[^.]+\.(.+\..+)$", 1)
    inside = from_page.select("src").distinct().select("src", parent.alias("dst")).filter("dst <> ''")
    both = inside.unionByName(inside.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.unionByName(both).filter("dst <> '' AND src <> dst").distinct()


def propagate(seeds: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, node, score) by personalised PageRank; seeds (kind, node, seed), edges (kind, src, dst).

    Every turn a node sends DAMPING_PERCENT of its score in equal parts along its edges; seeds get
    the rest of their seed again. Hosts with very many edges send from several salted copies, so no
    key holds more than EDGES_PER_SALT edges. The scores are written as a table every few turns;
    only their change reaches the driver.
    """
    degrees = cut_lineage(edges.groupBy("kind", "src").agg(F.count("*").alias("degree")))
    salts = F.ceil(F.col("degree") / EDGES_PER_SALT).cast("bigint")
    out = cut_lineage(edges.join(degrees, ["kind", "src"]).select(
        "kind", "src", F.pmod(F.xxhash64("dst"), salts).alias("salt"), "dst", "degree"))
    hubs = cut_lineage(degrees.select("kind", "src", salts.alias("salts")).filter("salts > 1"))
    hubless = hubs.isEmpty()
    kept = cut_lineage(seeds)
    base = kept.select("kind", "node", F.expr(f"seed * {100 - DAMPING_PERCENT} div 100").alias("score"))
    aim = kept.agg(F.sum("seed")).first()[0] or 0
    part = F.expr(f"score * {DAMPING_PERCENT} div (100 * degree)").alias("score")

    def turn(scores: DataFrame) -> DataFrame:
        """One shuffle: the sums lie by node, as the next turn joins them with the edges."""
        holders, keys = scores.withColumnRenamed("node", "src"), ["kind", "src"]
        if not hubless:
            copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1).cast("bigint")) - 1)
            holders = holders.join(hubs, ["kind", "src"], "left").select(
                "kind", "src", "score", F.explode(copies).alias("salt"))
            keys = [*keys, "salt"]
        sent = out.join(holders, keys).select("kind", F.col("dst").alias("node"), part)
        return sent.unionByName(base).groupBy("kind", "node").agg(F.sum("score").alias("score"))

    scores = base
    while True:
        for _ in range(TURNS_PER_TABLE):
            before, scores = scores, turn(scores)
        joined = scores.join(before.withColumnRenamed("score", "before"), ["kind", "node"], "full")
        both = cut_lineage(joined.select(
            "kind", "node", F.coalesce("score", F.lit(0)).cast("bigint").alias("score"),
            F.coalesce("before", F.lit(0)).cast("bigint").alias("before")))
        change = both.agg(F.sum(F.abs(F.col("score") - F.col("before")))).first()[0] or 0
        scores = both.select("kind", "node", "score")
        if change <= aim * tolerance:
            return scores


def host_scores(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """(host, trust, distrust) in parts of UNIT, of every host with a page, link or seed.

    A host's seed of trust is the share of its pages that a rule allows, of distrust the share that a
    rule blocks.
    """
    host, path = host_and_path(F.col(url))
    _, verdict = rule_of(host, path, rules)
    counts = pages.select(host.alias("node"), verdict.alias("v")).filter("node <> ''").groupBy("node").agg(
        F.count("*").alias("n"), F.count_if(F.col("v") == "allow").alias("trust"),
        F.count_if(F.col("v") == "block").alias("distrust"))
    counted = cut_lineage(counts)
    seeds = counted.select("node", F.explode(F.create_map(
        F.lit("trust"), F.expr(f"trust * {UNIT} div n"), F.lit("distrust"), F.expr(f"distrust * {UNIT} div n"))).alias("kind", "seed")).filter("seed > 0")
    edges = cut_lineage(host_edges(pages, host, html))
    directed = edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    scores = propagate(seeds.select("kind", "node", "seed"), directed)
    return scores.groupBy(F.col("node").alias("host")).agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0)).cast("bigint").alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0)).cast("bigint").alias("distrust"))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict): every row judged by the longest rule, else by its host's scores.

    A host without a rule is blocked when its distrust exceeds its trust and is LEAST_DISTRUST at least,
    and allowed otherwise. Null urls and urls without `://` have an empty host and path, no
    rule, and are allowed. Null html has no links; repeated rows are judged each. No rows: no rows.
    """
    source = pages.select(F.col(id).alias("_id"), F.col(url).cast("string").alias("_url"), F.col(html).cast("string").alias("_html"))
    blocked = host_scores(source, rules, "_url", "_html").filter(
        (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= LEAST_DISTRUST)
    ).select("host", F.lit(True).alias("_blocked"))
    host, path = host_and_path(F.col("_url"))
    placed = source.select("_id", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = placed.withColumns({"rule": name, "_says": verdict})
    joined = join_dimension(ruled, cut_lineage(blocked), ["host"], ["_id", "path"])
    by_host = F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(F.col("_id").alias(id), "host", "path", "rule", F.coalesce("_says", by_host).alias("verdict"))
