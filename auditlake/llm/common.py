"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.session import workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: several jobs use it, and the
    loss of an executor never makes it anew."""
    spark, path = df.sparkSession, workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the folders of a staged frame that no later job reads."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that would clash with an operator's results."""
    return df.drop(*names)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a bijection."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def token_lists(column) -> list[list[bytes]]:
    """Words of each text: A-Z lower-cased, cut at ASCII white space; none for null."""
    return [t.encode().lower().split() if t else [] for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Parts of Arrow batches, so that few texts at a time are Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
