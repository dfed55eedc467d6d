"""URL filters: rules first, then trust and distrust spread over host links.

Rules allow or block a host with all its subdomains below a path. Where no rule
fits, the host decides: hosts with allowed pages are seeds of a personalised
PageRank along the links, hosts with blocked pages are seeds of the same walk
against the links, so that distrust reaches whoever links to a blocked host. A
host is blocked where the distrust part of both exceeds ``threshold``.

Links are counted per host pair before they are shuffled, and from then on the
work follows the number of host pairs, not of pages. The state of every round
is stored in the shared folder. Only columns of Spark SQL are used.

Defined cases: a null url or one without :// has an empty host and path, no rule
fits it, and the verdict is ``otherwise``. Null html has no links; links within a
host do not count. Hosts that neither walk reaches get ``otherwise`` too. A
host without links keeps what it has. Repeated rows are judged alike and count
as often as they occur. Extra columns of the pages are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.common import ascii_lower, store

LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first :// up to /, ? or #, lower-cased A-Z, and the path behind it up to ? or #."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def locate(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path = host_and_path(F.col(url_col))
    return pages.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """rule_host, rule_path, rule, decides from (verdict, "host/path") pairs."""
    rows = [F.struct(F.lit(r[:r.index("/")]).alias("rule_host"), F.lit(r[r.index("/"):]).alias("rule_path"), F.lit(r).alias("rule"),
                     F.lit(v).alias("decides")) for v, r in rules]
    none = spark.range(0).selectExpr("'' AS rule_host", "'' AS rule_path", "'' AS rule", "'' AS decides")
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else none


def rules_of_hosts(hosts: DataFrame, rules: DataFrame, labels: int) -> DataFrame:
    """host, fits: the rules for each host and its parents, longest first, then by name; no rule's host has more than ``labels`` labels."""
    tails = F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)])
    held = hosts.select("host", F.explode(F.array_distinct(tails)).alias("rule_host")).join(rules, "rule_host")
    return held.groupBy("host").agg(F.sort_array(F.collect_set(F.struct(
        (-F.char_length("rule")).alias("size"), "rule", "rule_path", "decides"))).alias("fits"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """src, dst, n: pages of a host that link to another one."""
    host, _ = host_and_path(F.col(url_col))
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1)), ascii_lower))
    return pages.select(host.alias("src"), F.explode(found).alias("dst")).where("src <> dst AND src <> ''").groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = 0.85, rounds: int = 10_000, tolerance: float = 1e-6) -> DataFrame:
    """host, trust, distrust from ``seeds`` (host, t0, d0, each summing to 1 or 0) and ``links`` (src, dst, n).

    Power iteration until the total change of a round is below ``tolerance`` and
    the round has reached no host for the first time. The change shrinks by
    ``damping`` at least each round, so only chains of links longer than
    ``rounds`` go on beyond that; they are an error.
    """
    out = links.groupBy("src").agg(F.sum("n").alias("n_out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("n_in"))
    edges = store(links.join(out, "src").join(into, "dst").select(
        "src", "dst", (F.col("n") / F.col("n_out")).alias("forth"), (F.col("n") / F.col("n_in")).alias("back")), "host-links")
    nodes = seeds.select("host").unionByName(links.select(F.explode(F.array("src", "dst")).alias("host"))).distinct()
    state = nodes.join(seeds, "host", "left").join(out.withColumnRenamed("src", "host"), "host", "left").join(
        into.withColumnRenamed("dst", "host"), "host", "left").select(
        "host", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("t0", "d0")), F.col("n_out").isNull().alias("end"), F.col("n_in").isNull().alias("start"))
    state = store(state.withColumns({"trust": F.col("t0"), "distrust": F.col("d0")}), "host-state")
    for _ in range(rounds):
        won = edges.join(state.select(F.col("host").alias("src"), "trust"), "src").groupBy("dst").agg(F.sum(F.col("forth") * F.col("trust")).alias("won"))
        lost = edges.join(state.select(F.col("host").alias("dst"), "distrust"), "dst").groupBy("src").agg(F.sum(F.col("back") * F.col("distrust")).alias("lost"))
        moved = state.join(won.withColumnRenamed("dst", "host"), "host", "left").join(lost.withColumnRenamed("src", "host"), "host", "left")

        def step(seed, value, got, stays):
            return (1 - damping) * F.col(seed) + damping * (F.coalesce(got, F.lit(0.0)) + F.when(F.col(stays), F.col(value)).otherwise(0.0))

        trust, distrust = step("t0", "trust", "won", "end"), step("d0", "distrust", "lost", "start")
        state = store(moved.select("host", "t0", "d0", "end", "start", trust.alias("trust"), distrust.alias("distrust"),
                                   (F.abs(trust - F.col("trust")) + F.abs(distrust - F.col("distrust"))).alias("change"),
                                   (F.col("trust").cast("boolean") != trust.cast("boolean")).alias("new_trust"),
                                   (F.col("distrust").cast("boolean") != distrust.cast("boolean")).alias("new_distrust")), "host-state")
        change, new = state.agg(F.coalesce(F.sum("change"), F.lit(0.0)), F.coalesce(F.bool_or(F.col("new_trust") | F.col("new_distrust")), F.lit(False))).first()
        if change < tolerance and not new:
            break
        state = state.drop("change", "new_trust", "new_distrust")
    else:
        raise RuntimeError(f"trust has not settled after {rounds} rounds")
    return state.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.5,
          otherwise: str = "allow", damping: float = 0.85, rounds: int = 10_000, tolerance: float = 1e-6) -> DataFrame:
    """page, host, path, rule, verdict, trust, distrust for every row; rules are (allow or block, "host/path") pairs."""
    at = store(locate(pages, id_col, url_col), "hosts")
    labels = max([1, *(r[:r.index("/")].count(".") + 1 for _, r in rules)])
    fits = rules_of_hosts(at.select("host").distinct(), rule_table(pages.sparkSession, rules), labels)
    ruled = at.join(fits, "host", "left")
    # the longest rule whose path the page's path starts with; the list is sorted
    first = F.get(F.filter("fits", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0))
    ruled = store(ruled.select("page", "host", "path", first["rule"].alias("rule"), first["decides"].alias("decides")), "ruled")
    share = lambda v: F.avg((F.coalesce("decides", F.lit("")) == v).cast("double"))
    raw = store(ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("t"), share("block").alias("d")), "seeds")
    total = raw.agg(F.sum("t").alias("t_all"), F.sum("d").alias("d_all"))  # one row
    part = lambda c, all_: F.coalesce(F.try_divide(c, all_), F.lit(0.0))
    seeds = raw.join(F.broadcast(total)).select("host", part("t", "t_all").alias("t0"), part("d", "d_all").alias("d0"))
    reach = spread(seeds, store(host_links(pages, url_col, html_col), "host-pairs"), damping, rounds, tolerance)
    hosts = reach.withColumn("by_host", F.when(F.col("trust") + F.col("distrust") > 0, F.when(
        F.col("distrust") / (F.col("trust") + F.col("distrust")) > threshold, "block").otherwise("allow")).otherwise(otherwise))
    return ruled.join(hosts, "host", "left").select(
        "page", "host", "path", "rule", F.coalesce("decides", "by_host", F.lit(otherwise)).alias("verdict"), "trust", "distrust")
