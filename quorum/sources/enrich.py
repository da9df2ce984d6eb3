"""Enrichment from a service by batches, with placeholders for misses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, key: str, schema: str, fetch: Callable[[list], dict], batch: int = 100, missing: int = -1) -> DataFrame:
    """key and the fetched columns (``schema``, an id column first) of every distinct non-null key that the service knows.

    ``fetch`` takes a list of keys and returns key -> tuple; keys that it leaves out get a row with the id
    ``missing``, which is dropped after the call, so that a miss does not fail a batch.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    kind = dict(df.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keys = f[key].tolist()
            rows = []
            for at in range(0, len(keys), batch):
                some = keys[at : at + batch]
                got = fetch(some)
                rows += [(k, *(got.get(k) or (missing, *[None] * (len(names) - 1)))) for k in some]
            yield pd.DataFrame(rows, columns=[key, *names])

    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.mapInPandas(run, f"{key} {kind}, {schema}").where(F.col(names[0]) != missing)
