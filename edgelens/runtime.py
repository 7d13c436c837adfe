"""Session helpers shared by every operator: scratch tables, worker imports, input paths."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch on its way to Python, where the session has Spark's default of 64 MiB.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4194304b")
PACKAGE_ROOT = str(Path(__file__).resolve().parent.parent)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, read by Spark so that any file system works."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


#: Rows of a task after spread(): a wide projection takes some 200 us a row, so that a task takes seconds at any size.
SPREAD_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """df over all cores and in tasks of about SPREAD_ROWS rows where its files give too few partitions for that, so that a wide
    projection is not one task's and tasks do not grow with the table. Of a Parquet table the rows are counted by its footers."""
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's checkout (clusters: --py-files), and bound the
    bytes of the batches that they are sent: rows of a batch may hold texts of any length."""
    key, default, bound = ARROW_BYTES
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, bound)
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a temporary one, in local mode only."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="edgelens-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and return the table: lineage ends here,
    so a lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
