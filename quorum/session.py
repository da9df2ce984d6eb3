"""Sessions, the shared folder for cut lineage, and table access."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: temporary folders of local sessions, by application
_own: dict[str, str] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the library is tested under (UTC, ANSI, adaptive execution)."""
    b = SparkSession.builder.master(master).appName("quorum")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("QUORUM_DRIVER_MEMORY", "8g"),
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only where that setting is absent and the master is local, as in tests, a temporary folder is made.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or _own.get(sc.applicationId)
    if not named:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quorum-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = _own[sc.applicationId] = "file://" + folder
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and go on from there; the folder is emptied when the application ends.

    Plans stay short, a lost executor loses nothing, and what is read later are the columns used, with the size
    that the table really has: estimates do not multiply from cut to cut, and joins with small tables are
    planned as broadcasts by that size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quorum-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer takes for the size of df; for a table and what ``cut`` gives, the size of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """A scan over at least as many tasks as there are cores, for work that is heavy per row: small files are dealt out, large ones stay.

    df reads files, with projections and filters at most: its partitions are known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
