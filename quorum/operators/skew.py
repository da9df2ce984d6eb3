"""Per-key results when a few keys hold most rows.

Repeats of a (key, secondary) pair are folded first, in the tasks that read them and then by pair, so that no
pair is heavy. The pairs are range-partitioned on (key, secondary) by sampled quantiles, so a heavy key is
split over as many partitions as its pairs need. Each partition folds its pairs to one state per key; the
states of a key at partition boundaries are stitched in a last, tiny exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def folded_pairs(df: DataFrame, key: Column, secondary: Column, latest: Column) -> DataFrame:
    """_k, _s, _n, _t: how often a pair occurs and its greatest ``latest``; repeats are folded in the tasks that read them."""
    rows = df.select(key.alias("_k"), secondary.alias("_s"), latest.alias("_t"))
    return rows.groupBy("_k", "_s").agg(F.count(F.lit(1)).alias("_n"), F.max("_t").alias("_t"))


def balanced_by_key(df: DataFrame, key: Column, secondary: Column, latest: Column) -> DataFrame:
    """One row per key (null is a key too): key, n_rows, n_distinct, latest.

    n_rows counts rows, n_distinct the distinct non-null ``secondary`` values, latest is the greatest
    non-null ``latest``. The work of a task is bounded by the sampled range bounds, whatever the keys' sizes:
    repeats of a pair, (key, null) too, are folded where they are read, then each range is folded to states.
    An empty table gives no rows.
    """
    pairs = folded_pairs(df, key, secondary, latest).repartitionByRange("_k", "_s")
    return (
        pairs.groupBy("_k")
        .agg(F.sum("_n").alias("n_rows"), F.count("_s").alias("n_distinct"), F.max("_t").alias("latest"))
        .withColumnRenamed("_k", "key")
    )


def key_shares(df: DataFrame, key: Column) -> DataFrame:
    """Rows and share of all rows per key, for judging the skew."""
    n = df.select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))
    total = n.agg(F.sum("n_rows").alias("_total"))  # one row
    return n.crossJoin(F.broadcast(total)).select("key", "n_rows", (F.col("n_rows") / F.col("_total")).alias("share"))
