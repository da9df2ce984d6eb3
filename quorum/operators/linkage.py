"""Probabilistic record linkage: blocking, comparison levels, Fellegi-Sunter weights by EM, post-filters, clusters.

Pairs are reduced to the counts of their level patterns; EM runs on those, whose number is the product of the
levels and does not grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.operators.graph import components

#: pairs of random records for estimating how often levels agree by chance
CHANCE_PAIRS, EM_STEPS, TINY = 5_000_000, 30, 1e-6


@dataclass(frozen=True)
class Comparison:
    """Levels of agreement, best first, as conditions over columns l_... and r_...; what fits none is level 0; a null side is level -1."""

    name: str
    columns: list[str]
    levels: list[Column]


def gamma(c: Comparison) -> Column:
    null = reduce(lambda a, b: a | b, [F.col(f"{s}_{x}").isNull() for s in "lr" for x in c.columns])
    out = F.when(null, -1)
    for i, cond in enumerate(c.levels):
        out = out.when(cond, len(c.levels) - i)
    return out.otherwise(0).alias(f"gamma_{c.name}")


def with_sides(pairs: DataFrame, a: DataFrame, b: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """pairs (id_l, id_r) with the columns of both records as l_... and r_..."""
    l = a.select(F.col(key).alias("id_l"), *[F.col(c).alias(f"l_{c}") for c in cols])
    r = b.select(F.col(key).alias("id_r"), *[F.col(c).alias(f"r_{c}") for c in cols])
    return pairs.join(l, "id_l").join(r, "id_r")


def compare(pairs: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    return pairs.select("id_l", "id_r", *[gamma(c) for c in comparisons])


def chance_pairs(a: DataFrame, b: DataFrame, key: str, n: int = CHANCE_PAIRS, seed: int = 1) -> DataFrame:
    """About n random pairs, whatever the tables' sizes: each side's rows are drawn into numbered slots that meet one to one. All pairs if there are no more than n.

    A side of more than n rows is drawn from by hash, so that about n of its rows take part; a smaller one is drawn repeatedly.
    """
    size_a, size_b = a.count(), (a.count() if a is b else b.count())
    if size_a * size_b <= n:
        return a.select(F.col(key).alias("id_l")).crossJoin(b.select(F.col(key).alias("id_r"))).distinct()  # n rows at most

    def slots(df: DataFrame, size: int, name: str) -> DataFrame:
        own, each = F.lit(seed if name == "id_l" else seed + 1), -(-n // max(size, 1))
        rows = df.select(F.col(key).alias(name))
        if size > n:
            rows = rows.where(F.pmod(F.xxhash64(name, F.lit("drawn"), own), F.lit(size)) < n)
        drawn = rows.select(name, F.explode(F.sequence(F.lit(1), F.lit(each))).alias("k"))
        return drawn.withColumn("slot", F.pmod(F.xxhash64(name, "k", own), F.lit(n)))

    # the drawn rows count as few as the undrawn when Spark plans, and would be broadcast
    return slots(a, size_a, "id_l").hint("merge").join(slots(b, size_b, "id_r"), "slot").select("id_l", "id_r").distinct()


def pattern_counts(gammas: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    return gammas.groupBy(*[f"gamma_{c.name}" for c in comparisons]).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Model:
    """Chances of each level among matches (m) and non-matches (u), and the share of matches among the blocked pairs."""

    m: dict[str, list[float]]
    u: dict[str, list[float]]
    prior: float

    def weight(self, c: Comparison) -> Column:
        """log2(m / u) of a pair's level; 0 where it is null."""
        out = F.lit(0.0)
        for level in range(len(c.levels) + 1):
            out = F.when(F.col(f"gamma_{c.name}") == level, log2(self.m[c.name][level] / self.u[c.name][level])).otherwise(out)
        return out


def levels_of(counts: list, comparisons: list[Comparison], weight) -> dict[str, list[float]]:
    out = {}
    for c in comparisons:
        n = np.full(len(c.levels) + 1, TINY)
        for row, w in zip(counts, weight):
            g = row[f"gamma_{c.name}"]
            if g >= 0:
                n[g] += w
        out[c.name] = list(n / n.sum())
    return out


def estimate(gammas: DataFrame, chance: DataFrame, comparisons: list[Comparison]) -> Model:
    """u from the levels of random pairs, m and the prior by EM on the blocked pairs' patterns with u fixed."""
    by_chance = pattern_counts(chance, comparisons).collect()  # patterns
    rows = sorted(pattern_counts(gammas, comparisons).collect(), key=tuple)  # patterns
    u = levels_of(by_chance, comparisons, [r.n for r in by_chance])
    n = np.array([r.n for r in rows], dtype=float)
    model = Model({c.name: [0.1, *[0.9 / len(c.levels)] * len(c.levels)] for c in comparisons}, u, 0.1)
    for _ in range(EM_STEPS):
        logs = np.array([sum(log2(model.m[c.name][r[f"gamma_{c.name}"]] / u[c.name][r[f"gamma_{c.name}"]]) for c in comparisons if r[f"gamma_{c.name}"] >= 0) for r in rows])
        odds = model.prior / (1 - model.prior) * np.exp2(np.clip(logs, -60, 60))
        p = odds / (1 + odds)
        model = Model(levels_of(rows, comparisons, n * p), u, float(np.clip((n * p).sum() / max(n.sum(), 1), TINY, 1 - TINY)))
    return model


def frequency_adjustment(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """value, tf: share of each value among both tables' records, for raising agreement on rare values."""
    both = a.select(F.col(col).alias("value")).unionAll(b.select(F.col(col).alias("value"))).where(F.col("value").isNotNull())
    n = both.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("all")))).select("value", (F.col("n") / F.col("all")).alias("tf"))


def score(gammas: DataFrame, model: Model, comparisons: list[Comparison], extra: Column | None = None) -> DataFrame:
    """gammas with match_weight and match_probability; ``extra`` is added to the weight (term frequencies)."""
    w = F.lit(log2(model.prior / (1 - model.prior)))
    for c in comparisons:
        w = w + model.weight(c)
    if extra is not None:
        w = w + F.coalesce(extra, F.lit(0.0))
    odds = F.pow(F.lit(2.0), F.least(F.greatest(w, F.lit(-60.0)), F.lit(60.0)))
    return gammas.withColumn("match_weight", w).withColumn("match_probability", odds / (1 + odds))


def clusters(scored: DataFrame, threshold: float) -> DataFrame:
    """record, cluster_id (least record): components of the pairs at or above the threshold."""
    edges = scored.where(F.col("match_probability") >= threshold).select(F.col("id_l").alias("a"), F.col("id_r").alias("b"))
    return components(edges).select(F.col("v").alias("record"), F.col("component").alias("cluster_id"))
