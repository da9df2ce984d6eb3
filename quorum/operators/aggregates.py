"""Aggregates that the built-in ones leave open: ties, shares, outliers, rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.operators.windows import with_totals
from quorum.session import cut


def mode_of(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, mode_value, mode_count: the most frequent non-null value, the smaller one of ties."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("m"), F.col(value).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias("mode_value"), (-F.col("b.m")).alias("mode_count"))


def histogram(df: DataFrame, key: str, label: Column, name: str) -> DataFrame:
    """key, total, name: an array of (label, count, percent of the key's rows to two places), greatest label first; null labels are 'Unknown'."""
    n = df.groupBy(key, F.coalesce(label, F.lit("Unknown")).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    return with_percent(n, key, name)


def with_percent(counts: DataFrame, key: str, name: str) -> DataFrame:
    total = F.sum("count").over(Window.partitionBy(key))
    shared = counts.withColumn("total", total).withColumn("percent", F.round(F.col("count") / F.col("total") * 100, 2))
    return shared.groupBy(key).agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("label", "count", "percent")), asc=False).alias(name))


def allocate_mass(parts: DataFrame, whole: str, weight: str, magnitude: str) -> DataFrame:
    """parts with share and allocated: the magnitude of their whole in proportion to their weight, conserving its sum. A whole of zero weight allocates nothing."""
    known = with_totals(parts, [whole], __total=F.sum(weight))
    return known.withColumn("share", F.try_divide(F.col(weight).cast("double"), F.col("__total").cast("double"))).withColumn("allocated", F.col("share") * F.col(magnitude)).drop("__total")


def majority(df: DataFrame, unit: list[str], group: str, least: float = 0.5) -> DataFrame:
    """unit, group, share of the group that holds more than ``least`` of the unit's rows (null groups count in the whole only)."""
    n = df.groupBy(*unit, group).agg(F.count(F.lit(1)).alias("__n"))
    share = F.col("__n") / F.sum("__n").over(Window.partitionBy(*unit))
    return n.withColumn("share", share).where((F.col("share") > least) & F.col(group).isNotNull()).drop("__n")


def quantiles(counted: DataFrame, key: str, value: str, n: str, at: list[float]) -> DataFrame:
    """key, q (array in the order of ``at``): exact quantiles, interpolated between neighbours, of values that occur n times.

    ``counted`` has one row per key and value. The places are found in a few hundred ranges of values first
    and then within one range, so no task holds all the values of a key. Null keys have no row.
    """
    x = F.col(value).cast("double")
    ranged = counted.where(F.col(value).isNotNull() & F.col(key).isNotNull()).withColumn("__b", (F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * 64)).cast("int"))
    upto = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranged.groupBy(key, "__b").agg(F.sum(n).alias("__m")).withColumns({"__upto": F.sum("__m").over(upto), "__all": F.sum("__m").over(Window.partitionBy(key))})
    place = lambda q: (F.col("__all") - 1) * F.lit(float(q))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("side"), f(place(q)).cast("bigint").alias("r"), (place(q) - F.floor(place(q))).alias("part")) for i, q in enumerate(at) for s, f in ((0, F.floor), (1, F.ceil))]))
    before = F.col("__upto") - F.col("__m")
    held = ranges.select(key, "__b", "__m", "__upto", wanted.alias("w")).where((before <= F.col("w.r")) & (F.col("w.r") < F.col("__upto"))).select(key, "__b", "w.i", "w.side", "w.part", (F.col("w.r") - before).alias("r"))
    within = Window.partitionBy(key, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("__upto", F.sum(n).over(within))
    found = placed.join(held, [key, "__b"]).where((F.col("__upto") - F.col(n) <= F.col("r")) & (F.col("r") < F.col("__upto")))
    sides = found.groupBy(key, "i").agg(F.max(F.when(F.col("side") == 0, x)).alias("lo"), F.max(F.when(F.col("side") == 1, x)).alias("hi"), F.max("part").alias("part"))
    one = sides.select(key, F.struct("i", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("v")).alias("s"))
    return one.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["v"]).alias("q"))


def iqr_outliers(df: DataFrame, key: str, value: str, times: float = 1.5) -> DataFrame:
    """key, n_rows, q1, q3, n_outliers: values beyond times the interquartile range. The table is read once; nulls do not count."""
    counted = cut(df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n")))
    q = quantiles(counted, key, value, "__n", [0.25, 0.75]).select(F.col(key).alias("__k"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * times
    out = (F.col(value) < F.col("q1") - reach) | (F.col(value) > F.col("q3") + reach)
    return counted.join(q, F.col(key) == F.col("__k")).groupBy(key, "q1", "q3").agg(F.sum("__n").alias("n_rows"), F.coalesce(F.sum(F.when(out, F.col("__n"))), F.lit(0)).alias("n_outliers"))


def rollup_with_all(df: DataFrame, kind: str, group: str, value: Column, left_out: list[str]) -> DataFrame:
    """kind, group, n per kind and group, and per group under the kind 'all' without the kinds ``left_out``; n counts distinct values."""
    each = df.groupBy(kind, group).agg(F.countDistinct(value).alias("n"))
    every = df.where(~F.col(kind).isin(left_out)).groupBy(group).agg(F.countDistinct(value).alias("n")).select(F.lit("all").alias(kind), group, "n")
    return each.unionByName(every)


def single_value(c: Column) -> Column:
    """An aggregate: the value if all non-null ones are equal, else null."""
    return F.when(F.min(c) == F.max(c), F.max(c))


def count_once(df: DataFrame, cohort: str, seat: str, member: str) -> DataFrame:
    """cohort, once (distinct members), per_seat (members counted for each seat they are in): once <= per_seat."""
    by_member = df.where(F.col(member).isNotNull()).groupBy(cohort, member).agg(F.countDistinct(seat).alias("__s"))
    return by_member.groupBy(cohort).agg(F.count(F.lit(1)).alias("once"), F.sum("__s").alias("per_seat"))
