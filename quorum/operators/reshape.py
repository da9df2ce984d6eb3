"""Columns to rows and back, and unions of unequal tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.operators.incremental import newer_than


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value", kind: str = "string") -> DataFrame:
    """One row per id row and column with a non-null value, in one scan; values are cast to ``kind`` first."""
    cast = df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in values])
    return cast.unpivot(ids, values, name, value).where(F.col(value).isNotNull())


def unpivot_known(df: DataFrame, ids: list[str], lookup: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """As unpivot, of the columns that the lookup names and the table has."""
    have = set(df.columns)
    return unpivot(df, ids, sorted(c for c in set(lookup) if c in have and c not in ids), name, value)


def pivot(df: DataFrame, keys: list[str], on: str, values: list, measure: str) -> DataFrame:
    """Sums of a measure by conditional aggregates; one column per listed value, 0 where there is none."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col(on) == v, F.col(measure))), F.lit(0)).alias(f"{on}_{v}") for v in values])


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """All rows; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def master_and_tail(master: DataFrame, tail: DataFrame, at: str) -> DataFrame:
    """The authoritative table, and of the other one what is later than its last row (all of it if it is empty)."""
    return master.unionByName(newer_than(tail, master, at))
