"""Consolidating links into groups: connected components of records that share labels.

Labels become spokes to one of their records. The component of the vertex of highest degree, the giant if
there is one, is peeled off first by breadth-first joins of its frontier, however deep it is, and taken away
by an anti-join. The rest is labelled by propagating minima. Records are numbered once, so that only numbers
move in the rounds; one job per frontier and round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.operators.graph import both_ways, cut_and_sum, propagate_minima
from quorum.session import cut

#: frontiers kept apart; beyond that they are written together, so that plans stay short
FRONTIERS_APART = 16


def spokes(members: DataFrame) -> DataFrame:
    """Edges (a, b), b < a, from each record to the least record of each of its labels.

    ``members`` has id and label; null ids or labels link nothing. There are at most as many edges as
    members: no pairs within a label are made.
    """
    m = members.where(F.col("id").isNotNull() & F.col("label").isNotNull()).select("id", "label").distinct()
    hub = m.groupBy("label").agg(F.min("id").alias("hub"))
    return m.join(hub, "label").where(F.col("id") != F.col("hub")).select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()


def peel(edges: DataFrame) -> DataFrame | None:
    """The component of the vertex of highest degree, one column v; None without edges.

    An edge's ends are at most one frontier apart, so what a frontier reaches is new if it is in neither of
    the last two.
    """
    both = both_ways(edges)
    top = both.groupBy("a").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct(F.col("n"), F.col("a"))).alias("m")).first().m  # one row
    if top is None:
        return None
    frontier, last = edges.sparkSession.createDataFrame([(top.a,)], f"v {edges.schema['a'].dataType.simpleString()}"), None
    seen = [frontier]
    while True:
        reached = both.join(frontier, F.col("a") == F.col("v"), "left_semi").select(F.col("b").alias("v")).distinct()
        fresh = reached.join(frontier, "v", "left_anti")
        if last is not None:
            fresh = fresh.join(last, "v", "left_anti")
        last = frontier
        frontier, n = cut_and_sum(fresh, F.lit(1))
        if not n:
            break
        seen.append(frontier)
        if len(seen) > FRONTIERS_APART:
            seen = [cut(_all(seen))]
    return _all(seen)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def connected_groups(members: DataFrame) -> DataFrame:
    """id and group_id of every record linked with another; group_id is the least id of its component.

    ``members`` has id and label (strings), repeats allowed; null ids and labels link nothing, records that
    share no label give no row. An empty table gives no rows.
    """
    named = cut(members.where(F.col("id").isNotNull() & F.col("label").isNotNull()).select("id", "label").distinct())
    number = cut(named.select("id").distinct().select("id", F.monotonically_increasing_id().alias("v")))
    edges = cut(spokes(named.join(number, "id").select(F.col("v").alias("id"), "label")))
    giant = peel(edges)
    if giant is None:
        return number.select("id", F.col("id").alias("group_id")).where("false")
    rest = cut(edges.join(giant, F.col("a") == F.col("v"), "left_anti"))
    roots = propagate_minima(rest).unionByName(giant.select("v", F.lit(-1).cast("bigint").alias("root")))
    of = cut(number.join(roots, "v").select("id", "root"))
    return of.join(of.groupBy("root").agg(F.min("id").alias("group_id")), "root").select("id", "group_id")
