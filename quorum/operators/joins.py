"""Joins beyond equality, each with an equality to shuffle on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_providers(providers: dict[str, DataFrame], key: str, columns: dict[str, list[str]], sources: str = "sources") -> DataFrame:
    """Full outer merge of providers on a key: every column from the first of its listed providers that has it.

    Each provider has at most one row per key (null keys match nothing and stay single). ``sources`` lists the
    providers of a row in the order given.
    """
    names = list(providers)
    parts = [df.select(F.col(key).alias(f"{n}__k"), F.lit(n).alias(f"{n}__n"), *[F.col(c).alias(f"{n}__{c}") for c in df.columns if c != key]) for n, df in providers.items()]

    def on(left: DataFrame, right: DataFrame) -> DataFrame:
        known = F.coalesce(*[F.col(c) for c in left.columns if c.endswith("__k")])
        return left.join(right, known == F.col(next(c for c in right.columns if c.endswith("__k"))), "full")

    merged = reduce(on, parts)
    return merged.select(
        F.coalesce(*[F.col(f"{n}__k") for n in names]).alias(key),
        *[F.coalesce(*[F.col(f"{n}__{c}") for n in order]).alias(c) for c, order in columns.items()],
        F.array_compact(F.array(*[F.col(f"{n}__n") for n in names])).alias(sources),
    )


def anti_on_any(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left that match right on none of the keys: one hash anti-join per key, never one join on an OR. Null keys match nothing."""
    for k in keys:
        left = left.join(right.select(F.col(k).alias("__k")).where(F.col("__k").isNotNull()).distinct(), F.col(k) == F.col("__k"), "left_anti")
    return left


def carve_union(owner: DataFrame, legacy: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of owner, and those of legacy whose key owner does not have."""
    return owner.unionByName(legacy.join(owner.select(*keys).distinct(), keys, "left_anti"))


def nearest_within(left: DataFrame, right: DataFrame, left_id: str, right_id: str, on: list[str], left_day: str, right_day: str, days: int) -> DataFrame:
    """Pairs of left and right rows with the same ``on`` whose days differ by at most ``days``, and diff.

    The day line is cut into blocks of ``days`` days and right rows are put into their block and its two
    neighbours, so that the join is an equality and a hot key is spread over the blocks.
    """
    block = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01")) / max(days, 1))
    a = left.select(F.col(left_id).alias("left_id"), *on, F.col(left_day).alias("__l"), block(left_day).alias("__b"))
    b = right.select(F.col(right_id).alias("right_id"), *on, F.col(right_day).alias("__r"), F.explode(F.array(*[block(right_day) + d for d in (-1, 0, 1)])).alias("__b"))
    both = a.join(b, [*on, "__b"]).withColumn("diff", F.abs(F.datediff("__l", "__r")))
    return both.where(F.col("diff") <= days).select("left_id", "right_id", *on, "diff")


def best_right(pairs: DataFrame) -> DataFrame:
    """The nearest right row of each left row; ties go to the smaller right_id. An aggregate, combined before the shuffle."""
    return pairs.groupBy("left_id").agg(F.min(F.struct("diff", "right_id")).alias("m")).select("left_id", "m.right_id", "m.diff")


def one_to_one(pairs: DataFrame) -> DataFrame:
    """Two passes: the best right of each left, then the best left of each right; losers are dropped, not assigned again."""
    return best_right(pairs).groupBy("right_id").agg(F.min(F.struct("diff", "left_id")).alias("m")).select("m.left_id", "right_id", "m.diff")


def events_before(anchors: DataFrame, events: DataFrame, key: str, anchor: str, at: str, floor: Column, aggregates: list[Column]) -> DataFrame:
    """Every anchor row with aggregates over the key's events at or after ``floor`` and strictly before the anchor; null without any."""
    a = anchors.select(F.col(key).alias("__k"), F.col(anchor).alias("__a"), *[c for c in anchors.columns if c not in (key, anchor)])
    seen = anchors.select(F.col(key).alias("__k"), F.col(anchor).alias("__a")).distinct().join(events.where(F.col(at) >= floor), (F.col("__k") == F.col(key)) & (F.col(at) < F.col("__a")))
    agg = seen.groupBy("__k", "__a").agg(*aggregates)
    return a.join(agg, ["__k", "__a"], "left").withColumnsRenamed({"__k": key, "__a": anchor})


def covered_on(points: DataFrame, spans: DataFrame, key: str, day: str, start: str, end: str, verdict: Column) -> DataFrame:
    """points with covered: verdict aggregated over the spans of the key that hold the day; null without any.

    A null end is open, a null start never holds. How many spans are open on a day is a running sum of starts
    and ends, first over the months of a key and then within a month: spans and points of a hot key never
    meet, and no task sorts more than a month of it.
    """
    s = spans.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))).select(F.col(key).alias("__k"), F.col(start).cast("date").alias("__s"), F.col(end).cast("date").alias("__e"), F.coalesce(verdict, F.lit(False)).cast("int").alias("__v"), verdict.isNotNull().cast("int").alias("__u"))
    moves = s.select("__k", F.col("__s").alias("__d"), F.col("__u").alias("__any"), "__v").unionByName(s.where("__e IS NOT NULL").select("__k", F.date_add("__e", 1).alias("__d"), (-F.col("__u")).alias("__any"), (-F.col("__v")).alias("__v")))
    daily = moves.groupBy("__k", "__d").agg(F.sum("__any").alias("__any"), F.sum("__v").alias("__v"))
    days = points.select(F.col(key).alias("__k"), F.col(day).cast("date").alias("__d")).where("__k IS NOT NULL AND __d IS NOT NULL").distinct()
    all_ = daily.withColumn("__asked", F.lit(0)).unionByName(days.select("__k", "__d", F.lit(0).cast("bigint").alias("__any"), F.lit(0).cast("bigint").alias("__v"), F.lit(1).alias("__asked")))
    all_ = all_.withColumn("__m", F.trunc("__d", "month"))
    before = Window.partitionBy("__k").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    months = all_.groupBy("__k", "__m").agg(F.sum("__any").alias("__any"), F.sum("__v").alias("__v")).select("__k", "__m", F.coalesce(F.sum("__any").over(before), F.lit(0)).alias("__any0"), F.coalesce(F.sum("__v").over(before), F.lit(0)).alias("__v0"))
    within = Window.partitionBy("__k", "__m").orderBy("__d", "__asked").rowsBetween(Window.unboundedPreceding, 0)
    open_ = all_.withColumns({"__any": F.sum("__any").over(within), "__v": F.sum("__v").over(within)}).where("__asked = 1").join(months, ["__k", "__m"])
    got = open_.where("__any + __any0 > 0").select(F.col("__k").alias(key), F.col("__d").alias("__day"), (F.col("__v") + F.col("__v0") > 0).alias("covered"))
    return points.withColumn("__day", F.col(day).cast("date")).join(got, [key, "__day"], "left").drop("__day")


def in_range(points: DataFrame, ranges: DataFrame, on: list[str], value: str, low: str, high: str, width: float) -> DataFrame:
    """Rows of points with the rows of ranges that have the same ``on`` and low <= value <= high.

    Values are cut into bins of ``width`` and a range is put into each of its bins, so that the join is an
    equality and never a nested loop. Ranges with a null bound or low > high hold nothing.
    """
    bin_of = lambda c: F.floor(F.col(c) / width)
    r = ranges.where(F.col(low) <= F.col(high)).withColumn("__b", F.explode(F.sequence(bin_of(low), bin_of(high))))
    return points.withColumn("__b", bin_of(value)).join(r, [*on, "__b"]).where(F.col(value).between(F.col(low), F.col(high))).drop("__b")


def wildcard_lookup(facts: DataFrame, rules: DataFrame, required: list[str], optional: list[str], order: list[Column]) -> DataFrame:
    """Each fact with its best rule: ``required`` columns are equal, a null in an ``optional`` column of the rule fits all.

    Rules with more set columns win, then ``order``. Facts without a rule stay, with nulls. ``rules`` has its
    columns as r_..., and facts a unique column fact_id.
    """
    fits = F.lit(True)
    for c in required:
        fits = fits & (F.col(c) == F.col(f"r_{c}"))
    for c in optional:
        fits = fits & (F.col(f"r_{c}").isNull() | (F.col(f"r_{c}") == F.col(c)))
    n_set = reduce(lambda x, y: x + y, [F.col(f"r_{c}").isNotNull().cast("int") for c in optional], F.lit(0))
    w = Window.partitionBy("fact_id").orderBy(n_set.desc(), *order)
    return facts.join(rules, fits, "left").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def blocked_pairs(a: DataFrame, b: DataFrame, rules: list[list[Column]], a_id: str, b_id: str) -> DataFrame:
    """Distinct (id_l, id_r) of rows that agree on all keys of at least one rule; null keys agree with nothing.

    Each rule is a list of expressions that both sides are evaluated for: a union of equi-joins, as an OR of
    rules would be a nested loop.
    """
    out = None
    for rule in rules:
        key = F.when(reduce(lambda x, y: x & y, [k.isNotNull() for k in rule]), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(rule)]))
        l, r = (t.select(F.col(i).alias(n), key.alias("__k")).where(F.col("__k").isNotNull()) for t, i, n in ((a, a_id, "id_l"), (b, b_id, "id_r")))
        pairs = l.join(r, "__k").select("id_l", "id_r")
        out = pairs if out is None else out.unionAll(pairs)
    return out.distinct()
