"""The incremental patterns over Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quorum.operators.windows import latest_by_struct
from quorum.session import cut


def weekly(events: DataFrame, at: str, keys: list[str], late: str = "7 days") -> DataFrame:
    """Events per week (Monday to Sunday) and key; weeks are final once the watermark has passed."""
    monday = F.window(at, "7 days", startTime="4 days")  # the epoch was a Thursday
    return events.withWatermark(at, late).groupBy(monday, *keys).agg(F.count(F.lit(1)).alias("n_events")).select(F.col("window.start").alias("week_start"), *keys, "n_events")


def sessions(events: DataFrame, at: str, user: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of a user: events not more than ``gap`` apart."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), user).agg(F.count(F.lit(1)).alias("n_events")).select(user, F.col("session_window.start").alias("started"), "n_events")


def run_available(stream: DataFrame, to_table: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Takes all there is in micro-batches, once each, and ends."""
    q = stream.writeStream.foreachBatch(to_table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def upsert_into(path: str, keys: list[str], order: list[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the latest row of each key under ``path``, in buckets of keys (column ``_bucket``).

    A batch reads and rewrites the buckets it has keys of, and no others. One that is taken again changes
    nothing, and late data does not undo newer.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        rows = cut(latest_by_struct(batch, keys, order).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
            have = spark.read.schema(rows.schema).parquet(path).where(F.col("_bucket").isin(touched))
            rows = cut(latest_by_struct(have.unionByName(rows), keys, order))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)

    return sink
