"""Shards by jump consistent hashing (Lamping and Veach)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import without

# Hexadecimal digits of a key's hash that name its block: 4096 blocks in each shard.
BLOCK_DIGITS = 3


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key. Going from n to n+1 shards moves a key to the
    new shard or leaves it where it is."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = keys.astype(np.uint64, copy=True)
    at = np.full(len(key), -1, np.int64)
    to = np.zeros(len(key), np.int64)
    while (go := np.flatnonzero(to < shards)).size:
        at[go] = to[go]
        key[go] = key[go] * np.uint64(2862933555777941757) + np.uint64(1)
        step = np.float64(1 << 31) / ((key[go] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        to[go] = ((at[go] + 1) * step).astype(np.int64)
    return at.astype(np.int32)


def key_digest(key: Column) -> Column:
    """Hexadecimal hash of a key's text; all null keys share one."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("\0null")))


def shard_of(digest: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def jump(high: pd.Series, low: pd.Series) -> pd.Series:
        halves = [h.to_numpy().astype(np.uint64) for h in (high, low)]
        return pd.Series(jump_hash((halves[0] << np.uint64(32)) | halves[1], shards))

    def half(start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")

    return jump(half(1), half(9))


def assign_shards(rows: DataFrame, key: str, shards: int, tie: str | None = None) -> DataFrame:
    """``rows`` with ``shard``, ``slot`` and ``grown_shard`` (its shard if there were one more).

    Only the key and the number of shards decide: a shard's slots run from 0 without gaps in the
    order of the keys' hashes, then of key and ``tie``. Null keys share one shard, so do
    repeated keys; equal rows get slots of their own in any order. No rows, no result. Columns
    of ``rows`` with the three names are replaced.

    A shard is cut into 4096 blocks by hash. Ranks are taken inside a block, whose start is the
    sum of the counts before it, so no task holds a whole shard.
    """
    rows = without(rows, "shard", "slot", "grown_shard", "__digest", "__block", "__start")
    digest = F.col("__digest")
    rows = (
        rows.withColumn("__digest", key_digest(F.col(key)))
        .withColumn("shard", shard_of(digest, shards))
        .withColumn("grown_shard", shard_of(digest, shards + 1))
        .withColumn("__block", F.substring(digest, 1, BLOCK_DIGITS))
    )
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "__block").count()
        .select("shard", "__block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy("shard", "__block").orderBy(
        "__digest", key, *([tie] if tie else [])
    )
    return (
        rows.join(starts, ["shard", "__block"])
        .withColumn("slot", F.col("__start") + F.row_number().over(inside) - 1)
        .drop("__digest", "__block", "__start")
    )
