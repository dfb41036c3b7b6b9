"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime SQL settings every job of this package relies on.
RUNTIME_CONF = {
    # Partition keys, envelope timestamps and dates are all rendered in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lets a REBALANCE split a hot partition before a partitioned write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Folders are listed by so many tasks at most; one task for each would cost more than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
    # A CSV header may name a column twice; the last value is kept.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Spark takes it at its start only, so it is never set here, only read.
CHECKPOINT_DIR = "spark.checkpoint.dir"


def build(app: str, cores: str = "*", memory: str = "8g", partitions: int = 16) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@functools.cache
def _local_folder() -> str:
    """One temporary folder for all sessions of this process."""
    return tempfile.mkdtemp(prefix="auditlake-")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach, below ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be invisible to the other executors.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder()
    return f"{base.rstrip('/')}/auditlake/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    Used where several jobs consume one expensive result; the written table
    survives the loss of any executor.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A frame without rows. From a list, even an empty one, Spark would start a further Python worker on every core."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none where it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in store.listStatus(path)] if store.exists(path) else []
