"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.session import cut, estimated_bytes

#: bytes on disk, compressed; in memory a table may have ten times as many
MOST_BYTES = 2 << 20


def broadcast_if_small(df: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """df, written once, with a broadcast hint if its files have at most ``most_bytes``; else without, for a shuffled join.

    Adaptive execution still splits skewed partitions of the shuffled join.
    """
    done = cut(df)
    return F.broadcast(done) if estimated_bytes(done) <= most_bytes else done
