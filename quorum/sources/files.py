"""Delimited files in, delimited files and published tables out.

Paths are read and written through Hadoop's file systems, so they may lie on any store the cluster reaches.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quorum.operators.graph import cut_and_sum
from quorum.operators.windows import latest_per_key

# File types by the end of a file's name, the first that fits decides.
FILE_TYPES = [
    ("%VOTEHISTORY.tab", "vote_history"), ("%DEMOGRAPHIC.tab", "demographic"),
    ("%VOTEHISTORY_DataDictionary.csv", "vote_history_data_dictionary"), ("%DEMOGRAPHIC_DataDictionary.csv", "demographic_data_dictionary"),
    ("VM2Uniform%.tab", "uniform"), ("VM2Uniform%DataDictionary.csv", "uniform_data_dictionary"),
]


def read_delimited(spark: SparkSession, path: str, loaded_at: Column | None = None) -> DataFrame:
    """A tab-separated (.tab, .tsv) or comma-separated file with a header, every column text so that leading zeros survive, with loaded_at."""
    sep = "\t" if re.search(r"\.(tab|tsv)(\.gz)?$", path.lower()) else ","
    df = spark.read.csv(path, header=True, sep=sep, inferSchema=False, quote='"', escape='"', multiLine=False)
    return df.withColumn("loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())


def file_type(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for pattern, kind in reversed(FILE_TYPES):
        out = F.when(name.like(pattern), kind).otherwise(out)
    return out


def latest_files(listing: DataFrame, by: list[str], name: str, at: str) -> DataFrame:
    """Of each ``by`` and file type the latest file; files of no known type are left out."""
    typed = listing.withColumn("file_type", file_type(F.col(name))).where(F.col("file_type").isNotNull())
    return latest_per_key(typed, [*by, "file_type"], [F.col(at).desc(), F.col(name)])


def table_name_of(file_name: str, state: str, prefix: str = "l2_s3") -> str:
    """The table a file is loaded into."""
    kind = next((k for p, k in FILE_TYPES if re.fullmatch(p.replace("_", ".").replace("%", ".*"), file_name)), None)
    if kind is None:
        raise ValueError(f"no file type fits {file_name}")
    return f"{prefix}_{state.lower()}_{kind}"


def write_delimited(df: DataFrame, path: str, order: list[tuple[str, str]], partition: tuple[str, str] | None = None) -> None:
    """A CSV folder with a pinned format: columns in the given order and type (absent ones are null), nested ones as JSON,
    '"' doubled inside quotes, null as nothing, '' as "". With ``partition`` (column, value) only its rows."""
    rows = df if partition is None else df.where(F.col(partition[0]) == partition[1])
    kinds = dict(rows.dtypes)

    def out(c: str, kind: str) -> Column:
        if c not in kinds:
            return F.lit(None).cast(kind).alias(c)
        nested = kinds[c].startswith(("struct", "array", "map"))
        return (F.to_json(c) if nested else F.col(c).cast(kind)).alias(c)

    rows.select(*[out(c, k) for c, k in order]).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue='""')


def content(df: DataFrame) -> tuple[int, int]:
    """(rows, sum of the rows' hashes): equal for tables of the same rows in any order, and all but surely different for others."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("h")).first()
    return r.n, int(r.h or 0)


def overwrite_partition(df: DataFrame, path: str, column: str, value: str) -> str:
    """Loads one partition idempotently: 'skipped' if the partition holds the same rows already, else its rows are replaced."""
    spark, new = df.sparkSession, df.where(F.col(column) == value)
    fs, at = _file_system(spark, path)
    if fs.exists(at(path)):
        have = spark.read.parquet(path).where(F.col(column) == value)
        if set(have.columns) == set(df.columns) and content(have.select(df.columns)) == content(new):
            return "skipped"
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    return "loaded"


def overwrite_table(df: DataFrame, path: str) -> None:
    """The table at ``path`` becomes df, schema included; df may read the table itself. Readers see the old or the new files' list, by their own start."""
    publish({"table": df}, path)


def append_log(df: DataFrame, path: str, keys: list[str]) -> int:
    """Adds the rows of df whose keys the log does not hold yet, repeats of df once, and returns their number. Nothing in the log is changed."""
    spark, fresh = df.sparkSession, df.dropDuplicates(keys)
    fs, at = _file_system(spark, path)
    if fs.exists(at(path)):
        fresh = fresh.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    fresh, n = cut_and_sum(fresh, F.lit(1))
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def partitions_of(df: DataFrame, column: str) -> Iterator[tuple[object, DataFrame]]:
    """(value, rows) of one partition after the other, in order of the values; a filter on a partition column reads that partition alone."""
    values = [r[0] for r in df.select(column).distinct().sort(column).collect()]  # partitions, not rows
    for v in values:
        yield v, df.where(F.col(column).eqNullSafe(F.lit(v)))


def batches_of(df: DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    """The rows as frames of at most ``rows``; the driver holds one partition at a time."""
    some: list = []
    for r in df.toLocalIterator():
        some.append(r)
        if len(some) == rows:
            yield pd.DataFrame(some, columns=df.columns)
            some = []
    if some:
        yield pd.DataFrame(some, columns=df.columns)


def read_records(spark: SparkSession, name: str) -> DataFrame:
    """Records to link: a delimited file or folder of them by its ending, a parquet folder by its path, else a table of the catalogue by its name."""
    if re.search(r"\.(csv|tab|tsv)(\.gz)?$", name.lower()):
        return read_delimited(spark, name).drop("loaded_at")
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def write_records(df: DataFrame, name: str) -> None:
    """Linked records to where ``read_records`` finds them; a file's name gives a folder of that name."""
    if re.search(r"\.(csv|tab|tsv)$", name.lower()):
        write_delimited(df, name, df.dtypes)
    elif "/" in name:
        df.write.mode("overwrite").parquet(name)
    else:
        df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def publish(tables: dict[str, DataFrame], root: str, gates: dict[str, DataFrame] | None = None) -> dict:
    """Writes all tables under a new version and then moves one pointer, so that readers see all of them or none.

    ``gates`` are results of quality.publish_gate; if one fails nothing is moved. Returns the manifest, which is
    written beside the version before the pointer moves.
    """
    spark = next(iter(tables.values())).sparkSession
    failed = {t: [r.gate for r in g.where("NOT passed").collect()] for t, g in (gates or {}).items()}  # a few rows a table
    if any(failed.values()):
        return {"published": False, "failed": {t: f for t, f in failed.items() if f}}
    version = uuid.uuid4().hex
    manifest: dict = {"published": True, "version": version, "tables": {}}
    for name, df in tables.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(f"{root}/{version}/{name}")
        manifest["tables"][name] = {"rows": seen.get["n"]}
    fs, path = _file_system(spark, root)

    def put(where: str, text: str) -> None:
        stream = fs.create(path(where), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    put(f"{root}/{version}/manifest.json", json.dumps(manifest))
    fs.mkdirs(path(f"{root}/LIVE"))
    numbers = [int(x.getPath().getName()) for x in fs.listStatus(path(f"{root}/LIVE"))]
    put(f"{root}/NEXT-{version}", version)
    # one rename makes the pointer of the next number, the older ones stay: there is a live version at any time
    if not fs.rename(path(f"{root}/NEXT-{version}"), path(f"{root}/LIVE/{max(numbers, default=0) + 1:012d}")):
        raise RuntimeError("another publication has moved the pointer")
    return manifest


def live_version(spark: SparkSession, root: str) -> str | None:
    """The version that the pointer with the greatest number names; None before the first publication."""
    fs, path = _file_system(spark, root)
    if not fs.exists(path(f"{root}/LIVE")):
        return None
    last = max((x.getPath().getName() for x in fs.listStatus(path(f"{root}/LIVE"))), default=None)
    return last and spark.read.text(f"{root}/LIVE/{last}").first().value


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{live_version(spark, root)}/{name}")
