"""Consolidating pairwise matches into groups by low-diameter decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import discard, materialize


def _shifted_start(vertex: str, level: int, rate: float):
    """Start time of a vertex's own cluster: minus an exponential draw, fixed by vertex and level."""
    unit = (F.pmod(F.xxhash64(F.col(vertex), F.lit(level)), F.lit(1 << 52)).cast("double") + 1.0) / float((1 << 52) + 1)
    return F.log(unit) / rate


def _grow(arcs: DataFrame, level: int, rate: float, hops: int) -> DataFrame:
    """(v, center): every vertex with the center whose cluster reaches it first, growing one hop per unit of time.

    arcs hold both directions, so their left ends are all vertices. After `hops` hops growth stops; a center is
    always in the same component as its vertices, so an early stop costs another level, never a wrong group.
    """
    state = arcs.select("v").distinct().select("v", F.col("v").alias("center"), _shifted_start("v", level, rate).alias("at"))
    for _ in range(hops):
        reached = arcs.join(state, "v").select(F.col("w").alias("v"), "center", (F.col("at") + 1.0).alias("at"))
        state = state.unionByName(reached).groupBy("v").agg(F.min_by("center", "at").alias("center"), F.min("at").alias("at"))
    return state.select("v", "center")


def connected_groups(links: DataFrame, a: str = "a", b: str = "b", *, rate: float = 0.02, hops: int = 2, max_levels: int = 60) -> DataFrame:
    """(vertex, group): every vertex of `links` with the smallest vertex of its connected component.

    Clusters grow from exponentially shifted start times, contract to super-vertices, and the links between
    clusters are solved the same way until none is left; then the assignments are composed from the last level
    back. Each level writes its tables to the shared folder and asks the driver for one number, the count of
    links left. Self links make a vertex a group of one; links with a NULL end are none; repeated links, either
    way round, count once; no links give an empty result. Vertices may be of any ordered type.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    # numbers in place of keys: exact, given once and written, so a lost executor can't renumber
    names = materialize(pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct().select("name", F.monotonically_increasing_id().alias("v")), "vertices")
    numbered = pairs.where("a <> b").join(names.select(F.col("name").alias("a"), F.col("v").alias("v")), "a").join(names.select(F.col("name").alias("b"), F.col("v").alias("w")), "b")
    edges = materialize(numbered.select(F.least("v", "w").alias("v"), F.greatest("v", "w").alias("w")).distinct(), "edges")

    steps: list[DataFrame] = []
    while True:
        level = len(steps)
        if level >= max_levels:
            raise RuntimeError(f"links are left after {max_levels} levels")
        arcs = edges.unionByName(edges.select(F.col("w").alias("v"), F.col("v").alias("w")))
        step = materialize(_grow(arcs, level, rate, hops), "centers")
        steps.append(step)
        left = step.select(F.col("v"), F.col("center").alias("c1"))
        right = step.select(F.col("v").alias("w"), F.col("center").alias("c2"))
        between = edges.join(left, "v").join(right, "w").where("c1 <> c2").select(F.least("c1", "c2").alias("v"), F.greatest("c1", "c2").alias("w")).distinct()
        nxt = materialize(between, "edges")
        discard(edges)
        edges = nxt
        if edges.isEmpty():
            break

    # compose: what a level's centers became at later levels; centers that met no further link stay themselves
    whole = steps[-1]
    for step in reversed(steps[:-1]):
        later = whole.select(F.col("v").alias("center"), F.col("center").alias("top"))
        whole = step.join(later, "center", "left").select("v", F.coalesce("top", "center").alias("center"))
    named = names.join(whole, "v", "left").select("name", F.coalesce("center", "v").alias("center"))
    named = materialize(named, "composed")
    for done in (*steps, edges, names):
        discard(done)
    smallest = named.groupBy("center").agg(F.min("name").alias("group"))
    return named.join(smallest, "center").select(F.col("name").alias("vertex"), "group")
