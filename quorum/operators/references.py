"""References to records that do not exist.

The distinct non-null foreign keys of a child table, each with its first and last time of use, are
anti-joined with the parent's keys; what is left over, with the keys used before their parent arrived or
after it was deleted, is a short list that is joined back to the child rows for the rows and counts.
Only that list meets the child table again, so a hot key costs one pre-aggregated row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS_AND_BRACES = "{} \t\r\n"


def plain_id(c: Column) -> Column:
    """An id without letter case, braces and surrounding blanks; blank ids are null."""
    return F.nullif(F.lower(F.btrim(c, F.lit(BLANKS_AND_BRACES))), F.lit(""))


def parent_lifespans(parent: DataFrame, key: Column, created: Column, deleted: Column | None = None) -> DataFrame:
    """One row (_key, _born, _died) per non-null parent key; of several rows of a key the earliest times hold."""
    return (
        parent.select(key.alias("_key"), created.alias("_born"), (deleted if deleted is not None else F.lit(None).cast("timestamp")).alias("_died"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min("_born").alias("_born"), F.min("_died").alias("_died"))
    )


def orphan_references(child: DataFrame, fk: Column, at: Column, parents: DataFrame, keep: dict[str, Column] | None = None) -> DataFrame:
    """Child rows whose reference fails: columns of ``keep``, _fk, _at and reason.

    ``parents`` comes from parent_lifespans. reason is the first that holds: missing (no such parent),
    deleted (the parent's _died is not after the row's time), late (the parent's _born is after it).
    A null key refers to nothing and gives no row. A null time can only be missing. Repeated child rows
    are all returned. An empty child gives no rows; with empty parents every reference is missing.
    """
    rows = child.select(fk.alias("_fk"), at.alias("_at"), *[c.alias(n) for n, c in (keep or {}).items()]).where(F.col("_fk").isNotNull())
    used = rows.groupBy("_fk").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    missing = used.join(parents, F.col("_fk") == F.col("_key"), "left_anti").select("_fk", F.lit(None).cast("timestamp").alias("_born"), F.lit(None).cast("timestamp").alias("_died"), F.lit(True).alias("_missing"))
    misused = (
        used.join(parents, F.col("_fk") == F.col("_key"))
        .where((F.col("_last") >= F.col("_died")) | (F.col("_first") < F.col("_born")))
        .select("_fk", "_born", "_died", F.lit(False).alias("_missing"))
    )
    reason = F.when(F.col("_missing"), "missing").when(F.col("_died") <= F.col("_at"), "deleted").when(F.col("_born") > F.col("_at"), "late")
    return rows.join(missing.unionByName(misused), "_fk").withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_born", "_died", "_missing")


def orphan_counts(orphans: DataFrame, by: list[str]) -> DataFrame:
    """Orphan rows per ``by``, month of the referring row (first day, or null) and reason."""
    return orphans.groupBy(*by, F.date_format(F.date_trunc("month", "_at"), "yyyy-MM").alias("month"), "reason").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("_fk").alias("n_keys"))
