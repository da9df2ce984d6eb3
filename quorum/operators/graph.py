"""Connected components by propagating minima and contracting what has met, one job per round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quorum.session import cut


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def cut_and_sum(df: DataFrame, what: Column) -> tuple[DataFrame, int]:
    """df written to the shared folder, and the sum of ``what``, counted in the same job."""
    seen = Observation()
    done = cut(df.observe(seen, F.coalesce(F.sum(what.cast("bigint")), F.lit(0)).alias("n")))
    return done, seen.get["n"]


def propagate_minima(edges: DataFrame) -> DataFrame:
    """v, root: every vertex of the edges (a, b) with one vertex of its component, the same for all of it.

    In a round every vertex takes the least of its neighbours and itself, then that one's least; vertices are
    put in an order by hash that differs from round to round, so that no order of the ids makes long chains.
    The edges are then rewritten to what their ends have taken, and those that have become loops or repeats
    are dropped: a round has about a third of the vertices of the one before, so all rounds together cost
    little more than the first. Loops in ``edges`` join nothing.
    """
    edges, taken, turn = edges.select("a", "b").where(F.col("a") != F.col("b")), [], 0
    while True:
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        least = both_ways(edges).groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("v"), F.least("m", rank("a")).getField("x").alias("f"))
        step = cut(least.join(least.select(F.col("v").alias("f"), F.col("f").alias("g")), "f").select("v", F.col("g").alias("f")))
        taken.append(step)
        a, b = (step.select(F.col("v").alias(c), F.col("f").alias(f"new_{c}")) for c in "ab")
        met = edges.join(a, "a").join(b, "b").where(F.col("new_a") != F.col("new_b"))
        edges, n = cut_and_sum(met.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), F.lit(1))
        turn += 1
        if not n:
            break
    roots = taken.pop()
    while taken:  # backwards, from the smallest table
        on = roots.select(F.col("v").alias("f"), F.col("f").alias("r"))
        roots = taken.pop().join(on, "f", "left").select("v", F.coalesce("r", "f").alias("f"))
    return roots.select("v", F.col("f").alias("root"))


def components(edges: DataFrame, conflict: Column | None = None) -> DataFrame:
    """v, component (least vertex), n_vertices, has_conflict of all vertices of the edges (a, b).

    Edges for which ``conflict`` holds join nothing; has_conflict tells whether one lies inside the component.
    Self-loops keep a vertex that has no other edge.
    """
    flagged = edges.select("a", "b", F.coalesce(conflict if conflict is not None else F.lit(False), F.lit(False)).alias("bad"))
    links = cut(flagged.where("NOT bad").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = cut(propagate_minima(links))
    lone = flagged.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(roots, "v", "left_anti").select("v", F.col("v").alias("root"))
    of = cut(roots.unionByName(lone))
    found = of.join(of.groupBy("root").agg(F.min("v").alias("component"), F.count(F.lit(1)).alias("n_vertices")), "root").select("v", "component", "n_vertices")
    ends = [found.select(F.col("v").alias(c), F.col("component").alias(f"c_{c}")) for c in "ab"]
    inside = flagged.where("bad").join(ends[0], "a").join(ends[1], "b").where("c_a = c_b").select(F.col("c_a").alias("component")).distinct().withColumn("has_conflict", F.lit(True))
    return found.join(inside, "component", "left").select("v", "component", "n_vertices", F.coalesce("has_conflict", F.lit(False)).alias("has_conflict"))
