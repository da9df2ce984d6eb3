"""Data tests: each gives the failing rows; a gate sums them up before a table is published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Repeated combinations without nulls, with their number."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.where(known).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_sampled(df: DataFrame, cols: list[str], fraction: float, seed: int = 1) -> DataFrame:
    """At most one repeated combination among the rows of a sample of the combinations: a cheap probe, not a proof.

    The sample is drawn by a hash of the combination, so that all rows of a drawn one are seen.
    """
    drawn = F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 20)) < F.lit(int(fraction * (1 << 20)))
    return unique(df.where(drawn), cols).limit(1)


def freshness(df: DataFrame, group: str, at: str, now: Column | None = None) -> DataFrame:
    """group, last_at, lag_hours: how far each group's last row is behind ``now`` (the table's last row if not given)."""
    last = df.groupBy(group).agg(F.max(at).alias("last_at"))
    if now is None:
        last, now = last.crossJoin(F.broadcast(df.agg(F.max(at).alias("__now")))), F.col("__now")  # one row
    seconds = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_at").cast("timestamp"))
    return last.select(group, "last_at", F.floor(seconds / 3600).alias("lag_hours"))


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))


def accepted_range(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(col) < low)
    if high is not None:
        bad = bad | (F.col(col) > high)
    return df.where(bad)


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.where(~F.coalesce(F.expr(expression), F.lit(False)))


def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose non-null value the parent lacks."""
    keys = parent.select(F.col(parent_col).alias("__p")).where(F.col("__p").isNotNull()).distinct()
    return df.where(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("__p"), "left_anti")


def tuple_exists(df: DataFrame, cols: list[str], parent: DataFrame) -> DataFrame:
    return df.join(parent.select(*cols).distinct(), cols, "left_anti")


def is_uuid(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).rlike(UUID))


def is_state(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).rlike("^[A-Z]{2}$"))


def share_below(df: DataFrame, condition: Column, most: float) -> DataFrame:
    """One row with the share if more than ``most`` of the rows meet the condition."""
    return df.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("double")).alias("share")).where(F.col("share") > most)


def mass_conserved(parts: DataFrame, whole: str, magnitude: str, allocated: str, tolerance: float = 1e-6) -> DataFrame:
    """Wholes whose allocated parts do not add up to their magnitude."""
    return parts.groupBy(whole).agg(F.max(magnitude).alias("magnitude"), F.sum(allocated).alias("allocated")).where(F.abs(F.col("magnitude") - F.col("allocated")) > tolerance * F.greatest(F.abs("magnitude"), F.lit(1.0)))


def publish_gate(new: DataFrame, live: DataFrame, key: str, least_ratio: float, floor: int, least_overlap: float, never_null: list[str]) -> DataFrame:
    """gate, value, passed: row ratio to the live table, rows at a cold start, share of live keys kept, nulls in key columns."""
    n = new.agg(F.count(F.lit(1)).alias("new_n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in never_null])
    old = live.agg(F.count(F.lit(1)).alias("old_n"))
    kept = live.select(key).distinct().join(new.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left").agg(F.avg(F.col("__k").isNotNull().cast("double")).alias("kept"))
    one = n.crossJoin(old).crossJoin(kept)  # one row each
    gates = [
        ("row_ratio", F.try_divide(F.col("new_n").cast("double"), F.col("old_n").cast("double")), lambda v: v.isNull() | (v >= least_ratio)),
        ("cold_start", F.col("new_n").cast("double"), lambda v: (F.col("old_n") > 0) | (v >= floor)),
        ("key_overlap", F.col("kept"), lambda v: v.isNull() | (v >= least_overlap)),
        *[(f"null_{c}", F.col(f"null_{c}").cast("double"), lambda v: v == 0) for c in never_null],
    ]
    return one.select(F.explode(F.array(*[F.struct(F.lit(g).alias("gate"), v.alias("value"), ok(v).alias("passed")) for g, v, ok in gates])).alias("g")).select("g.*")
