"""Ranking, deduplication, gaps and fills over windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def qualify(df: DataFrame, condition_of: Column, keep: Column, name: str = "__q") -> DataFrame:
    """Rows for which ``keep``, an expression of column ``name``, holds; ``name`` is the window expression. QUALIFY of other dialects."""
    return df.withColumn(name, condition_of).where(keep).drop(name)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order. The order should be total; else any of the tied rows is kept."""
    return qualify(df, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), F.col("__q") == 1)


def latest_by_struct(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As latest_per_key for orders by plain columns, greatest first, but by an aggregate that is combined before the shuffle: no hot key is sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("__m"))
    return best.select(*keys, *[F.col(f"__m.{c}").alias(c) for c in rest])


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key, with their rank as ``rnk``."""
    return df.withColumn("rnk", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rnk") <= k)


def with_totals(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """df with aggregates over the rows of its key (null is a key too).

    An aggregate that is combined before the shuffle and joined back, not a window: a hot key is never one
    task, as adaptive execution splits skewed joins.
    """
    totals = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggregates.items()])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(totals, on).drop(*[f"__{k}" for k in keys])


def sessions_by_gap(df: DataFrame, user: str, at: str, seconds: int) -> DataFrame:
    """df with is_new (first row of a user, or more than ``seconds`` after the row before) and session_no from 1."""
    w = Window.partitionBy(user).orderBy(at)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    gap = micros(F.col(at)) - micros(F.lag(at).over(w))
    new = df.withColumn("is_new", gap.isNull() | (gap > seconds * 1_000_000))
    return new.withColumn("session_no", F.sum(F.col("is_new").cast("int")).over(w.rangeBetween(Window.unboundedPreceding, 0)))


def first_known(df: DataFrame, keys: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """Each of cols replaced by the key's first non-null value in the order."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({c: F.first_value(c, ignoreNulls=True).over(w) for c in cols})


def sibling_resolution(df: DataFrame, keys: list[Column], key_id: str, populated: Column) -> DataFrame:
    """df with resolved_id: an unpopulated row takes the id of its one populated sibling; rows with several or none keep theirs."""
    w = Window.partitionBy(*keys)
    n, other = F.count_if(populated).over(w), F.max(F.when(populated, F.col(key_id))).over(w)
    return df.withColumn("resolved_id", F.when(populated, F.col(key_id)).when(n == 1, other).otherwise(F.col(key_id)))
