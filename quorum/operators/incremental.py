"""Keeping derived tables up to date: watermarks, upserts, histories, stable ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quorum.functions.ids import fingerprint, salted_uuid


def newer_than(source: DataFrame, target: DataFrame, at: str, inclusive: bool = False) -> DataFrame:
    """Source rows after the target's last ``at`` (or at it, if inclusive); all of them for an empty target.

    The watermark, one value, is read first, so that the filter is a constant that reaches the scan.
    """
    last = target.agg(F.max(at)).first()[0]
    if last is None:
        return source
    return source.where(F.col(at) >= F.lit(last) if inclusive else F.col(at) > F.lit(last))


def newer_than_per_key(source: DataFrame, target: DataFrame, key: str, at: str) -> DataFrame:
    """Source rows after the last ``at`` of their key in the target; all rows of new keys."""
    last = target.groupBy(F.col(key).alias("__k")).agg(F.max(at).alias("__last"))
    return source.join(last, F.col(key) == F.col("__k"), "left").where(F.col("__last").isNull() | (F.col(at) > F.col("__last"))).drop("__k", "__last")


def run_if_any(increment: DataFrame, build: Callable[[DataFrame], DataFrame], schema: StructType | str) -> DataFrame:
    """build(increment), or nothing of the same schema without running it where there is no increment. One row is read to know."""
    return increment.sparkSession.createDataFrame([], schema) if increment.isEmpty() else build(increment)


def affected(source: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """All source rows of the keys that changed, for computing those keys anew from all their rows."""
    return source.join(changes.select(*keys).distinct(), keys, "left_semi")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], deleted: Column | None = None) -> DataFrame:
    """The target with the updates' rows in place of its own of the same keys; unchanged keys stay, stale ones too.

    Rows of ``updates`` for which ``deleted`` holds remove their key. Updates have one row per key.
    """
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.where(~F.coalesce(deleted, F.lit(False))) if deleted is not None else updates)


def keep_stored(updates: DataFrame, target: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Updates with the target's value of ``col`` wherever it has one."""
    stored = target.select(*keys, F.col(col).alias("__stored"))
    return updates.join(stored, keys, "left").withColumn(col, F.coalesce("__stored", col)).drop("__stored")


def latest_versions(stream: DataFrame, entity: str, context: list[str], at: str) -> DataFrame:
    """One row per version of an entity: its id (fingerprint of the context), its latest row, and is_latest.

    ``at`` should be unique per entity.
    """
    rest = [c for c in stream.columns if c != entity]
    v = stream.withColumn("version_id", fingerprint(entity, *context)).groupBy(entity, "version_id").agg(F.max(F.struct(at, *[c for c in rest if c != at])).alias("r"))
    flat = v.select(entity, "version_id", *[F.col(f"r.{c}").alias(c) for c in rest])
    return flat.withColumn("is_latest", F.col(at) == F.max(at).over(Window.partitionBy(entity)))


def history(snapshots: DataFrame, key: str, at: str, checked: list[str]) -> DataFrame:
    """key, the checked columns, valid_from, valid_to (null: still valid) from successive full snapshots.

    A row is closed when a checked column changes (null-safe) or the key is missing from the next snapshot.
    """
    days = snapshots.select(at).distinct().select(F.col(at).alias("__d"), F.lead(at).over(Window.orderBy(at)).alias("__next"), F.lag(at).over(Window.orderBy(at)).alias("__prev"))  # one row per snapshot
    w = Window.partitionBy(key).orderBy(at)
    seen = snapshots.join(F.broadcast(days), F.col(at) == F.col("__d")).withColumn("__f", fingerprint(*checked))
    same = (F.lag("__f").over(w) == F.col("__f")) & (F.lag(at).over(w) == F.col("__prev"))
    runs = seen.withColumn("__new", F.coalesce((~same).cast("int"), F.lit(1))).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(key, "__run", *checked).agg(F.min(at).alias("valid_from"), F.max(F.struct(at, "__next")).getField("__next").alias("valid_to")).drop("__run")


def apply_snapshot(hist: DataFrame, snapshot: DataFrame, key: str, checked: list[str], at: Column) -> DataFrame:
    """A history (key, checked, valid_from, valid_to) after one more snapshot: changed and missing keys are closed at ``at``, new states opened."""
    now = snapshot.select(F.col(key).alias("__k"), fingerprint(*checked).alias("__now"))
    open_, closed = hist.where("valid_to IS NULL"), hist.where("valid_to IS NOT NULL")
    ended = open_.join(now, F.col(key) == F.col("__k"), "left").withColumn("valid_to", F.when(F.col("__now").isNull() | (F.col("__now") != fingerprint(*checked)), at)).drop("__k", "__now")
    was = open_.select(F.col(key).alias("__k"), fingerprint(*checked).alias("__was"))
    fresh = snapshot.join(was, (F.col(key) == F.col("__k")) & (fingerprint(*checked) == F.col("__was")), "left_anti").select(key, *checked, at.alias("valid_from"), F.lit(None).cast(hist.schema["valid_to"].dataType).alias("valid_to"))
    return closed.unionByName(ended).unionByName(fresh)


def mint_ids(members: DataFrame, group: str, member: str, seen_at: str, pinned: DataFrame | None = None) -> DataFrame:
    """group, anchor, canonical_id: an id from the earliest seen member of a group (the smaller of ties), so that later members do not change it.

    ``pinned`` (group, anchor) fixes anchors that were given out before; the least counts.
    """
    first = members.groupBy(group).agg(F.min(F.struct(seen_at, member)).getField(member).alias("anchor"))
    if pinned is not None:
        old = pinned.groupBy(F.col(group).alias("__g")).agg(F.min("anchor").alias("__a"))
        first = first.join(old, F.col(group) == F.col("__g"), "left").select(group, F.coalesce("__a", "anchor").alias("anchor"))
    return first.withColumn("canonical_id", salted_uuid("anchor", salt="canonical"))
