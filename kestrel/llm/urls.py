"""URL filters: rules first, then trust and distrust propagated over the host graph.

1. The longest rule that fits a url decides it. A rule fits its host and all subdomains,
   if the url's path starts with the rule's path (of equally long rules the longer host's).
2. Host edges come from the pages' links (``href`` and ``src`` to another host), and join every
   host with the one above it (a.b.example.com, b.example.com, example.com), also where that
   one has no page. Bare public suffixes join nobody, unless they have pages themselves.
3. Hosts with pages that a rule allows (blocks) are seeds, with that many pages as mass.
   Trust is personalised PageRank from the allowed seeds along the links; distrust is the
   same from the blocked seeds against the links: who links to bad hosts is suspect.
   Both are summed as a power series, round by round, until little mass of either is left.
4. A page without a rule is blocked if distrust makes up more than ``threshold`` of its
   host's trust and distrust; hosts that neither reaches are allowed.

Everything is joined and aggregated per host; pages are counted before any shuffle.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and
is judged as host ``""``; null html has no links; repeated rows each get a verdict and count as
mass; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ref, staged


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str = "/"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)\z", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def suffixes(host: Column) -> Column:
    """The host and every host above it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def decide(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``pages`` (with host and path) plus ``rule`` and ``ruled``, both null where no rule fits."""
    spark = pages.sparkSession
    known = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "r_host string, r_path string, ruled string")
    hosts = pages.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("r_host"))
    fitting = F.struct(
        (-F.length("r_host") - F.length("r_path")).alias("order"), (-F.length("r_host")).alias("then"), "r_path", F.concat("r_host", "r_path").alias("rule"), "ruled"
    )
    by_host = hosts.join(known, "r_host").groupBy("host").agg(F.array_sort(F.collect_list(fitting)).alias("fitting"))
    rows = pages.join(by_host, "host", "left")
    best = F.get(F.filter("fitting", lambda r: F.col("path").startswith(r["r_path"])), 0)
    return rows.withColumn("best", best).select(*[ref(c) for c in pages.columns], F.col("best.rule").alias("rule"), F.col("best.ruled").alias("ruled"))


def bare_suffix(host: Column) -> Column:
    """Names under which anybody registers: one label (com), or a usual second label of a country (co.uk)."""
    name = F.regexp_replace(host, r":\d*$", "")
    return name.rlike(r"^[^.]*$") | name.rlike(r"^(ac|co|com|edu|gob|gouv|gov|govt|gv|ltd|mil|ne|net|nom|or|org|plc|sch)\.[a-z]{2}$")


def host_edges(pages: DataFrame, html_col: str = "html", host_col: str = "host") -> DataFrame:
    """(src, dst, n): links between different hosts, and hosts with the nearest node above them.

    Nodes are the hosts with pages and all hosts above them that are no bare public suffix.
    """
    found = F.array_distinct(F.transform(F.regexp_extract_all(ref(html_col), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""), 1), lower_ascii))
    links = pages.select(ref(host_col).alias("src"), F.explode(found).alias("dst")).where("src <> dst and src <> ''")
    links = links.groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = pages.select(ref(host_col).alias("h")).where("h <> ''").distinct()
    is_name = ~F.col("h").rlike(r"(^|\.)\d+(:\d*)?$")  # addresses have no host above them
    above = hosts.where(is_name).select(F.explode(suffixes(F.col("h"))).alias("h")).where(~bare_suffix(F.col("h")))
    nodes = hosts.unionAll(above).distinct()
    up = nodes.where(is_name).select("h", F.posexplode(suffixes(F.col("h"))).alias("up", "top")).where("up > 0")
    present = up.join(nodes.select(F.col("h").alias("top")), "top")
    nearest = present.groupBy("h").agg(F.min_by("top", "up").alias("top"))
    family = nearest.select(F.col("h").alias("src"), F.col("top").alias("dst")).unionAll(nearest.select(F.col("top").alias("src"), F.col("h").alias("dst")))
    return links.unionAll(family.withColumn("n", F.lit(1).cast("long"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, left: float = 0.01) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) over edges (src, dst, n).

    Trust moves along the edges, distrust against them. Ends when of each kind at most ``left`` of its own
    seeds' mass still moves: a kind with few seeds goes as far as one with many.
    """
    along = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    against = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    both = along.unionAll(against)
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    steps = staged(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("p")), "host-steps")
    mass = F.stack(F.lit(2), F.lit("trust"), F.col("trust").cast("double"), F.lit("distrust"), F.col("distrust").cast("double"))
    moving = staged(seeds.select("host", mass.alias("kind", "x")).where("x > 0"), "host-mass")
    of_kind = lambda: {r["kind"]: r["x"] for r in moving.groupBy("kind").agg(F.sum("x").alias("x")).collect()}
    total = now = of_kind()
    rounds = [moving]
    while any(now.get(k, 0.0) > left * x for k, x in total.items()):
        arrived = moving.withColumnRenamed("host", "src").join(steps, ["kind", "src"])
        moving = staged(arrived.groupBy(F.col("dst").alias("host"), "kind").agg(F.sum(F.col("x") * F.col("p") * damping).alias("x")), "host-mass")
        rounds.append(moving)
        now = of_kind()
    all_rounds = rounds[0]
    for r in rounds[1:]:
        all_rounds = all_rounds.unionByName(r)
    each = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("x"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    ranks = all_rounds.groupBy("host").agg(*each)
    # a kind's whole mass counts as much as its seeds': what ended at hosts without links is shared out in proportion
    sums = ranks.agg(F.sum("trust").alias("all_trust"), F.sum("distrust").alias("all_distrust"))
    size = seeds.agg(F.sum("trust").alias("seed_trust"), F.sum("distrust").alias("seed_distrust")).first()
    whole = sums.first()
    scale = {k: float(size[f"seed_{k}"] or 0) / whole[f"all_{k}"] if whole[f"all_{k}"] else 0.0 for k in ("trust", "distrust")}
    return ranks.select("host", (F.col("trust") * scale["trust"]).alias("trust"), (F.col("distrust") * scale["distrust"]).alias("distrust"))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.5, damping: float = 0.85) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust and distrust of its host."""
    host, path = host_and_path(ref(url_col))
    parsed = pages.select(ref(id_col).alias("id"), host.alias("host"), path.alias("path"), ref(html_col).alias("html"))
    ruled = staged(decide(parsed.drop("html"), rules), "pages-ruled")
    count = lambda v: F.count(F.when(F.col("ruled") == v, 1))
    seeds = staged(ruled.where("host <> ''").groupBy("host").agg(count("allow").alias("trust"), count("block").alias("distrust")), "host-seeds")
    ranks = propagate(staged(host_edges(parsed), "host-edges"), seeds, damping)
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    verdicts = staged(ranks.select(F.col("host").alias("v_host"), "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("judged")), "host-verdicts")
    rows = ruled.join(verdicts, F.col("host") == F.col("v_host"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return rows.select("id", "host", "path", "rule", F.coalesce("ruled", "judged", F.lit("allow")).alias("verdict"), zero("trust"), zero("distrust"))
