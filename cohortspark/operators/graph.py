"""Graphs as edge tables (src, dst, weight).

Loops keep their state in reliable checkpoints: each round starts from stored
rows, so a lost executor costs one round and plans do not grow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.operators import ordered as O
from cohortspark.operators.verbs import first_rows
from cohortspark.session import cut_lineage


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degree(edges: DataFrame, vertices: DataFrame | None = None, kind: str = "out") -> DataFrame:
    """Out degree (influence), in degree (prestige) or both; vertices without an edge get 0."""
    ends = {"out": edges.select(F.col("src").alias("id")), "in": edges.select(F.col("dst").alias("id")),
            "all": edges.select(F.explode(F.array("src", "dst")).alias("id"))}[kind]
    counts = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    if vertices is None:
        vertices = vertices_of(edges)
    return vertices.join(counts, "id", "left").fillna(0, ["degree"])


def degree_dist(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """Vertices per out degree and the mean weight sum of those vertices."""
    w = F.sum(weight) if weight else F.lit(None).cast("double")
    per = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"), w.alias("w"))
    return per.groupBy("degree").agg(F.count(F.lit(1)).alias("n_vertices"), F.avg("w").alias("mean_weight"))


def dup_edges(edges: DataFrame) -> DataFrame:
    """Number of repeated edges in all."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("c")).agg(F.sum(F.col("c") - 1).alias("n_duplicates"))


def dup_edge_dist(edges: DataFrame) -> DataFrame:
    """Vertices per number of repeats among their out edges."""
    per = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("c")).groupBy("src").agg(F.sum(F.col("c") - 1).alias("repeats"))
    return per.groupBy("repeats").agg(F.count(F.lit(1)).alias("n_vertices"))


def transpose(edges: DataFrame) -> DataFrame:
    swap = {"src": "dst", "dst": "src"}
    return edges.select(*[F.col(swap.get(c, c)).alias(c) for c in edges.columns])


def lookup_edge(edges: DataFrame, src, dst) -> DataFrame:
    return edges.where((F.col("src") == src) & (F.col("dst") == dst))


def bandwidth(edges: DataFrame) -> DataFrame:
    """Largest index gap over the edges."""
    return edges.agg(F.max(F.abs(F.col("src") - F.col("dst"))).alias("bandwidth"))


def flow_cost(edges: DataFrame, capacity: str = "capacity", residual: str = "residual", weight: str = "weight") -> DataFrame:
    """Sum over the edges with capacity of used capacity times weight."""
    used = F.when(F.col(capacity) > 0, (F.col(capacity) - F.col(residual)) * F.col(weight))
    return edges.agg(F.coalesce(F.sum(used), F.lit(0.0)).alias("cost"))


def chains(edges: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame, bool]:
    """Contract chains: (core edges, links of the contracted vertices, whether loops of such vertices were left out).

    ``edges`` (src, dst, w) holds a pair once. A vertex with one edge in and one
    out lies on a chain, unless ``keep`` (a test of its id) holds. Each of them
    looks up the vertex its own predecessor points to, which doubles the distance,
    so a chain of n takes log2(n) rounds. ``links`` (id, head, off) names the
    vertex a chain leaves and the weight from there; core edges pass whole chains.
    """
    ends = edges.select(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    inner = ends.groupBy("id").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).where("i = 1 AND o = 1").where(~keep).select("id")
    own = edges.join(inner, edges["dst"] == inner["id"], "left_semi").where("src <> dst")
    links = cut_lineage(own.select(F.col("dst").alias("id"), F.col("src").alias("head"), F.col("w").alias("off"))
                        .join(inner.select(F.col("id").alias("head"), F.lit(True).alias("__on")), "head", "left")
                        .select("id", "head", "off", F.coalesce("__on", F.lit(False)).alias("on")))
    total = links.count()
    for _ in range(total.bit_length() + 1):
        if links.where("on").isEmpty():
            break
        next_ = links.select(F.col("id").alias("head"), F.col("head").alias("__head"), F.col("off").alias("__off"), F.col("on").alias("__on"))
        links = cut_lineage(links.where("on").join(next_, "head").select(
            "id", F.col("__head").alias("head"), (F.col("off") + F.col("__off")).alias("off"), F.col("__on").alias("on")).unionByName(links.where("NOT on")))
    # what still points along a chain now goes round in a loop that nothing leads into
    loops = not links.where("on").isEmpty()
    links = links.where("NOT on").drop("on") if loops else links.drop("on")
    if not total:
        return edges, links, loops
    outer = edges.join(inner, edges["dst"] == inner["id"], "left_anti")
    jump = links.select(F.col("id").alias("src"), "head", "off")
    on_chain = outer.join(inner, outer["src"] == inner["id"], "left_semi").join(jump, "src")
    core = outer.join(inner, outer["src"] == inner["id"], "left_anti").unionByName(
        on_chain.select(F.col("head").alias("src"), "dst", (F.col("off") + F.col("w")).alias("w")))
    return cut_lineage(core), links, loops


def _parents_loop(state: DataFrame) -> bool:
    """Whether the parent pointers (id, parent) of a state go round somewhere."""
    up = cut_lineage(state.where(F.col("parent").isNotNull()).select("id", "parent"))
    # a pointer that still points after so many doublings has no end
    for _ in range(up.count().bit_length()):
        up = cut_lineage(up.join(up.select(F.col("id").alias("parent"), F.col("parent").alias("next")), "parent").select("id", F.col("next").alias("parent")))
        if up.isEmpty():
            return False
    return not up.isEmpty()


def shortest_paths(edges: DataFrame, source, weight: str | None = "weight", bucket: float | None = None) -> DataFrame:
    """Distance from one vertex; vertices that are not reached have an infinite one.

    Chains are contracted to shortcut edges first, and their vertices get their
    distance from the end of the chain at last. In between, rounds relax the
    edges of vertices whose distance fell, the nearest ``bucket`` of distance
    first (all at once without it). There is no limit of rounds: a reachable loop of
    negative weight shows in the parent pointers, which are followed after 8, 16,
    32, ... rounds, and raises.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    e = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst", w.alias("w"))
    # a loop at a vertex matters only if it is negative
    e = cut_lineage(e.groupBy("src", "dst").agg(F.min("w").alias("w")).where("src <> dst OR w < 0"))
    kind = edges.schema["src"].dataType
    start = F.lit(source).cast(kind)
    core, links, _ = chains(e, F.col("id") == start)
    core = core.groupBy("src", "dst").agg(F.min("w").alias("w")).where("src <> dst OR w < 0")
    core = cut_lineage(core)
    state = e.sparkSession.range(1).select(start.alias("id"), F.lit(0.0).alias("d"), F.lit(None).cast(kind).alias("parent"), F.lit(True).alias("new"))
    rounds = 0
    while True:
        front = state.where("new")
        if bucket:
            lowest = front.agg(F.min("d")).first()[0]
            front = front.where(F.col("d") < lowest + bucket) if lowest is not None else front
        offers = core.join(front.select(F.col("id").alias("src"), "d"), "src").groupBy(F.col("dst").alias("id")).agg(
            F.min(F.struct((F.col("d") + F.col("w")).alias("d"), F.col("src").alias("parent"))).alias("o"))
        done = F.col("new") & (F.col("d") < lowest + bucket) if bucket and lowest is not None else F.col("new")
        better = F.col("o").isNotNull() & (F.col("d").isNull() | (F.col("o.d") < F.col("d")))
        state = cut_lineage(state.join(offers, "id", "full").select(
            "id", F.when(better, F.col("o.d")).otherwise(F.col("d")).alias("d"), F.when(better, F.col("o.parent")).otherwise(F.col("parent")).alias("parent"),
            (better | F.coalesce(F.col("new") & ~done, F.lit(False))).alias("new")))
        if state.where("new").isEmpty():
            break
        rounds += 1
        if rounds >= 8 and rounds & (rounds - 1) == 0 and _parents_loop(state):
            raise ValueError("distances do not settle: a loop of negative weight can be reached")
    found = state.select("id", "d")
    on_chain = links.join(found.withColumnRenamed("id", "head"), "head").select("id", (F.col("d") + F.col("off")).alias("d"))
    found = found.join(on_chain, "id", "left_anti").unionByName(on_chain)
    return vertices_of(edges).join(found, "id", "left").select("id", F.coalesce("d", F.lit(float("inf"))).alias("distance"))


def eccentricity(dist: DataFrame) -> DataFrame:
    """Largest distance per vertex of a distance table (a, b, distance)."""
    return dist.groupBy(F.col("a").alias("id")).agg(F.max("distance").alias("eccentricity"))


def radius_diameter(dist: DataFrame) -> DataFrame:
    return eccentricity(dist).agg(F.min("eccentricity").alias("radius"), F.max("eccentricity").alias("diameter"))


def st_connected(edges: DataFrame, s, t) -> bool:
    """Search from both ends, widening the smaller frontier, until they meet or one is done."""
    e = cut_lineage(edges.select("src", "dst").distinct())
    kind = edges.schema["src"].dataType
    one = lambda x: e.sparkSession.range(1).select(F.lit(x).cast(kind).alias("id"))
    if s == t:
        return True
    seen = {"s": one(s), "t": one(t)}
    front = dict(seen)
    size = {"s": 1, "t": 1}
    while True:
        side = "s" if size["s"] <= size["t"] else "t"
        a, b = ("src", "dst") if side == "s" else ("dst", "src")
        step = e.join(front[side], e[a] == front[side]["id"], "left_semi").select(F.col(b).alias("id")).distinct()
        step = cut_lineage(step.join(seen[side], "id", "left_anti"))
        size[side] = step.count()
        if not size[side]:
            return False
        seen[side] = cut_lineage(seen[side].unionByName(step))
        front[side] = step
        if not step.join(seen["t" if side == "s" else "s"], "id", "left_semi").isEmpty():
            return True


def _mark(df: DataFrame):
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Component of each vertex, named by its smallest id, in few rounds even on long chains.

    Rounds alternate between linking larger neighbours and smaller ones to the
    smallest vertex in sight, until the edges are stars. Minima are taken with
    partial aggregation, so a vertex with many edges is no single task.
    """
    e = cut_lineage(edges.where(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    state = _mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(low2, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(down.unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        now = _mark(e)
        if now == state:
            break
        state = now
    ids = vertices if vertices is not None else vertices_of(edges)
    return ids.join(e.select(F.col("u").alias("id"), F.col("v").alias("c")), "id", "left").select(
        "id", F.coalesce("c", "id").alias("component"))


def link_components(comp: DataFrame) -> DataFrame:
    """Edges that join each component to the next one."""
    reps = comp.select(F.col("component").alias("src")).distinct()
    return O.lead(reps, "src", "dst", ["src"]).where(F.col("dst").isNotNull())


def topo_levels(edges: DataFrame) -> DataFrame:
    """Level of each vertex: all edges go to a higher level. A loop in the graph is an error.

    Chains are contracted first. Then a round takes the vertices that wait for
    nothing and tells their successors; of these only the ones it has reached,
    with the number of edges they still wait for, are kept from round to round.
    """
    e = cut_lineage(edges.select("src", "dst", F.lit(1).cast("long").alias("w")).distinct())
    ids = cut_lineage(vertices_of(edges))
    alone = not e.where("src = dst").isEmpty()
    core, links, loops = chains(e, F.lit(False))
    if alone or loops:
        raise ValueError("the graph has a loop")
    need = cut_lineage(core.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("need")))
    start = ids.join(links, "id", "left_anti").join(need, "id", "left_anti").select("id", F.lit(0).cast("long").alias("level"))
    front = cut_lineage(start)
    done, waiting, rounds = [front], None, 0
    while not front.isEmpty():
        told = core.join(front.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id")).agg(
            F.count(F.lit(1)).alias("got"), F.max(F.col("level") + F.col("w")).alias("level"))
        told = need.join(told, "id")
        if waiting is not None:
            told = told.unionByName(waiting).groupBy("id").agg(F.max("need").alias("need"), F.sum("got").alias("got"), F.max("level").alias("level"))
        told = cut_lineage(told)
        front, waiting = told.where("got = need").select("id", "level"), told.where("got < need")
        done.append(front)
        rounds += 1
        if rounds % 16 == 0:
            done = [cut_lineage(reduce(DataFrame.unionByName, done))]
    found = reduce(DataFrame.unionByName, done)
    on_chain = links.join(found.withColumnRenamed("id", "head"), "head").select("id", (F.col("level") + F.col("off")).alias("level"))
    out = cut_lineage(found.unionByName(on_chain))
    if out.count() < ids.count():
        raise ValueError("the graph has a loop")
    return out.select("id", F.col("level").cast("int").alias("level"))


SOURCES = 64  # bits of a long


def _without_leaves(both: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Core vertices (id, h, first), core edges (src, dst), leaves (id, parent) of edges given in both directions.

    A leaf hangs on one vertex, which has other edges too. Core vertices with a
    leaf have h = 1 and the smallest of their leaves as ``first``.
    """
    sizes = both.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("other"))
    single = sizes.where("n = 1").select(F.col("id").alias("leaf"), "other")
    kids = single.groupBy(F.col("other").alias("id")).agg(F.min("leaf").alias("first"))
    # two vertices with one edge are no leaves: each of them has the other
    info = cut_lineage(sizes.join(kids, "id", "left").select(
        "id", "other", "first", F.expr("n = 1 AND first IS NULL").alias("leaf"), F.expr("IF(n > 1 AND first IS NOT NULL, 1L, 0L)").alias("h")))
    core = info.where("NOT leaf").select("id", "h", "first")
    # an edge between core vertices is met from both ends
    links = both.join(core.select(F.col("id").alias("src")), "src", "left_semi").groupBy(
        F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(F.count(F.lit(1)).alias("n")).where("n = 2")
    return core, cut_lineage(links.select(F.col("u").alias("src"), F.col("v").alias("dst"))), info.where("leaf").select("id", F.col("other").alias("parent"))


def eccentricities(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """id, component, eccentricity: the largest number of hops to another vertex of the component, edges taken both ways.

    Leaves are one hop further out than the vertex they hang on, so the searches
    leave them out: most vertices of a tree are never stored or passed on again.
    """
    both_ways = lambda e: e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    ends = edges.where("src <> dst")
    if vertices is not None:
        comp = components(edges, vertices).withColumn("h", F.lit(0).cast("long"))
        return _search_far(cut_lineage(comp), cut_lineage(both_ways(ends).distinct()))
    both = cut_lineage(both_ways(ends).distinct())
    core, links, leaves = _without_leaves(both)
    comp = cut_lineage(components(links, core.select("id")).join(core, "id"))
    found = _search_far(comp.select("id", "component", "h"), cut_lineage(both_ways(links)))
    # a component is named by the smallest id, be it a leaf
    names = comp.groupBy("component").agg(F.min(F.least("id", "first")).alias("name"))
    found = cut_lineage(O.attach(found, names, ["component"]).select("id", F.col("name").alias("component"), "eccentricity"))
    outer = leaves.join(found.withColumnRenamed("id", "parent"), "parent").select("id", "component", F.col("eccentricity") + 1)
    # an end without an edge to another vertex is alone
    alone = vertices_of(edges.where("NOT coalesce(src <> dst, false)")).where("id IS NOT NULL")
    alone = alone.join(both.select(F.col("src").alias("id")), "id", "left_anti").select("id", F.col("id").alias("component"), F.lit(0).cast("long"))
    return found.union(outer).union(alone)


def _search_far(comp: DataFrame, both: DataFrame) -> DataFrame:
    """Eccentricities of the vertices (id, component, h), ``h`` the number of hops from a vertex to what hangs on it.

    Searches start from up to 64 vertices of each component at once; a vertex holds
    one bit for each that has reached it, so a round passes on one number per
    vertex, whatever the number of searches. A search from s gives bounds for all:
    the eccentricity of v lies between max(e(s) - d, d + h(s)) and e(s) + d for their
    distance d. The next searches start where the bounds are widest apart, at both
    ends; most vertices are settled by bounds and never searched from.
    """
    bounds = cut_lineage(comp.select("id", "component", F.lit(0).cast("long").alias("low"), F.lit(1 << 40).alias("high")))
    while True:
        open_ = bounds.where("low < high")
        half = SOURCES // 2
        far = first_rows(open_, half, ["-high", "id"], ["component"])
        near = first_rows(open_, half, ["low", "id"], ["component"])
        chosen = far.unionByName(near).select("id", "component").distinct()
        bit = F.row_number().over(Window.partitionBy("component").orderBy("id")) - 1  # 64 rows at most
        front = cut_lineage(chosen.select("id", bit.alias("bit")).select("id", F.expr("shiftleft(1L, bit)").alias("fresh")))
        if front.isEmpty():
            break
        seen = front.select("id", F.col("fresh").alias("seen"), "fresh")
        reached, hops = [front.withColumn("d", F.lit(0).cast("long"))], 0
        while True:
            hops += 1
            told = both.join(seen.where("fresh <> 0").select(F.col("id").alias("src"), "fresh"), "src").groupBy(F.col("dst").alias("id")).agg(
                F.bit_or("fresh").alias("told"))
            old = F.coalesce("seen", F.lit(0).cast("long"))
            fresh = F.coalesce("told", F.lit(0).cast("long")).bitwiseAND(F.bitwise_not(old))
            seen = cut_lineage(seen.drop("fresh").join(told, "id", "full").select("id", old.bitwiseOR(fresh).alias("seen"), fresh.alias("fresh")))
            new = seen.where("fresh <> 0")
            if new.isEmpty():
                break
            reached.append(new.select("id", "fresh", F.lit(hops).cast("long").alias("d")))
            if hops % 16 == 0:
                reached = [cut_lineage(reduce(DataFrame.unionByName, reached))]
        bits = F.filter(F.sequence(F.lit(0), F.lit(SOURCES - 1)), lambda b: F.getbit("fresh", b) == 1)
        each = cut_lineage(reduce(DataFrame.unionByName, reached).select("id", "d", F.explode(bits).alias("bit")).join(comp, "id"))
        own = each.groupBy("component", "bit").agg(F.max(F.col("d") + F.col("h")).alias("e"), F.max(F.when(F.col("d") == 0, F.col("h"))).alias("hs"))
        told = each.join(own, ["component", "bit"]).groupBy("id").agg(
            F.max(F.greatest(F.col("e") - F.col("d"), F.col("d") + F.col("hs"), F.when(F.col("d") == 0, F.col("e")))).alias("lo"), F.min(F.col("e") + F.col("d")).alias("hi"))
        bounds = cut_lineage(bounds.join(told, "id", "left").select(
            "id", "component", F.greatest("low", "lo").alias("low"), F.least("high", "hi").alias("high")))
    return bounds.select("id", "component", F.col("low").alias("eccentricity"))
