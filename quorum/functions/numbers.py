"""Ratios, intervals and dates that may be malformed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the least number of ballots that is projected.
FLOOR_BALLOTS = 3


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def wilson(k: Column, n: Column, z: float = 1.96) -> list[Column]:
    """point_pct, lo_pct and hi_pct of k successes in n trials; null for n = 0 and for k outside 0..n."""
    ok = (n > 0) & (k >= 0) & (k <= n)
    p = F.when(ok, k / n)
    den, centre = 1 + z * z / n, p + z * z / (2 * n)
    margin = z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n)
    pct = lambda c: F.when(ok, F.round(100 * c, 1))
    return [pct(p).alias("point_pct"), pct((centre - margin) / den).alias("lo_pct"), pct((centre + margin) / den).alias("hi_pct")]


def clamp(c: Column, low: float, high: float) -> Column:
    """c within the bounds; NaN, which is greater than every number in Spark, becomes null first."""
    return F.least(F.greatest(F.nanvl(c, F.lit(None).cast("double")), F.lit(low)), F.lit(high))


def projection_interval(projected: Column, size: Column, q_low: Column, q_high: Column, taper_top: Column) -> list[Column]:
    """point, lower and upper of a projected count: bounds in rate space, floored, and enclosing the point.

    Missing quantiles give no bounds.
    """
    rate = F.when(size > 0, clamp(projected / size, 0.0, 1.0))
    width = F.when(taper_top, F.sqrt(1 - rate)).otherwise(F.sqrt(rate * (1 - rate)))
    point = F.greatest(F.round(projected), F.lit(float(FLOOR_BALLOTS)))
    bound = lambda q: F.when(q.isNotNull() & rate.isNotNull(), F.greatest(F.round(clamp(rate + q * width, 0.0, 1.0) * size), F.lit(float(FLOOR_BALLOTS))))
    low, high = bound(q_low), bound(q_high)
    return [point.alias("point"), F.when(low.isNotNull(), F.least(low, point)).alias("lower"), F.when(high.isNotNull(), F.greatest(high, point)).alias("upper")]


def parse_date(c: Column, patterns: list[str], earliest: str, latest: str) -> Column:
    """The first pattern's reading of a date, if it lies between the two days; else null. Never raises."""
    d = F.coalesce(c.try_cast("date"), *[F.try_to_date(c, p) for p in patterns])
    return F.when(d.between(F.lit(earliest).cast("date"), F.lit(latest).cast("date")), d)
