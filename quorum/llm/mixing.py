"""Mixing sources to target weights.

Tokens are summed per source; from them and the weights follows how often each source's documents are to be
used. A document is emitted floor(rate) times and once more if its seeded hash, read as a number in [0, 1),
is below the rate's fraction. Only one row per source moves between the passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.operators.sizes import broadcast_if_small
from quorum.session import cut

TWO_52 = 1 << 52


def repetition_rates(sizes: DataFrame, weights: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row per weighted source: source, n_docs, n_tokens, target_share, max_repeats, rate.

    ``sizes`` has source and n_tokens of each document, ``weights`` source, target_weight and max_repeats.
    Without ``total_tokens`` the mix is as large as it can be with every source at its share and none used
    more than max_repeats times. With it, sources that cannot fill their share are used max_repeats times
    and fall short; the report of actual shares shows it.
    Sources without tokens, with a null or non-positive weight, or not in ``weights`` (null too) have no part;
    the shares of the others are their weights over the sum of these. A source listed twice has the sum of
    its weights and the least max_repeats; null max_repeats is 1, less than 0 is 0.
    """
    have = cut(sizes.where(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens").cast("bigint")).alias("n_tokens")))  # one row per source: the texts are counted once
    want = (
        weights.where(F.col("target_weight") > 0)
        .groupBy("source")
        .agg(F.sum("target_weight").alias("_w"), F.greatest(F.min(F.coalesce(F.col("max_repeats"), F.lit(1))), F.lit(0)).alias("max_repeats"))
        .where(F.col("max_repeats") > 0)
    )
    both = want.join(have.where(F.col("n_tokens") > 0), "source")
    limit = both.agg(F.sum("_w").alias("_sum"), F.min(F.col("max_repeats") * F.col("n_tokens") / F.col("_w")).alias("_a_weight"))
    total = F.lit(total_tokens).cast("double") if total_tokens is not None else F.col("_a_weight") * F.col("_sum")
    share = F.col("_w") / F.col("_sum")
    return both.crossJoin(F.broadcast(limit)).select(  # limit is one row
        "source", "n_docs", "n_tokens", share.alias("target_share"), "max_repeats",
        F.least(F.col("max_repeats").cast("double"), total * share / F.col("n_tokens")).alias("rate"),
    )


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on key and seed only."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(TWO_52)) / F.lit(float(TWO_52))


def mix(docs: DataFrame, doc_id: str, source: str, rates: DataFrame, seed: int = 0) -> DataFrame:
    """docs, each row as often as it is drawn, with copy_no (1, 2, ...) and the columns of docs.

    Rows of equal doc_id are drawn alike. Empty tables give no rows.
    """
    # inner names that no column of docs can have
    few = broadcast_if_small(rates.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), F.col("max_repeats").alias("__most")))
    copies = F.floor("__rate") + (uniform(F.col(doc_id), seed) < F.col("__rate") - F.floor("__rate")).cast("int")
    return (
        docs.join(few, F.col(source) == F.col("__source"))
        .withColumn("__copies", F.least(copies, F.col("__most")).cast("int"))
        .where(F.col("__copies") > 0)
        .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .drop("__source", "__rate", "__most", "__copies")
    )


def actual_shares(sizes: DataFrame, rates: DataFrame, seed: int = 0) -> DataFrame:
    """Per weighted source the target, what the mix has, and how often its documents are used at most.

    ``sizes`` has doc_id, source and n_tokens.
    """
    made = mix(sizes.select("doc_id", "source", "n_tokens"), "doc_id", "source", rates, seed).groupBy("source").agg(
        F.countDistinct("doc_id").alias("used_docs"), F.count(F.lit(1)).alias("mixed_docs"), F.sum(F.col("n_tokens").cast("bigint")).alias("mixed_tokens"), F.max("copy_no").alias("most_repeats")
    )
    all_ = made.agg(F.sum("mixed_tokens").alias("_all"))
    return (
        rates.join(made, "source", "left")
        .crossJoin(F.broadcast(all_))
        .select("source", "n_docs", "n_tokens", "target_share", "max_repeats", "rate", "used_docs", "mixed_docs", "mixed_tokens", "most_repeats", (F.col("mixed_tokens") / F.col("_all")).alias("actual_share"))
    )
