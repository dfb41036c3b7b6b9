"""De-duplication, unions and ordered views of archived records."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.functions.times import ts_lit
from auditlake.operators.filters import partition_filter


# What makes two stored rows the same event: an id means nothing outside its source and org.
EVENT_KEYS = ("source", "org_id", "instance", "event_type", "event_id")


def dedup(df: DataFrame, key: str = "event_id", keys: Sequence[str] = ()) -> DataFrame:
    """One row per id; rows without an id are all kept and not shuffled.

    ``keys`` are further columns that have to be equal; nulls are equal to each other. Rows are brought
    together first: a task would else sort all that it reads, to find the few repeats of its own.
    """
    keyless = F.coalesce(F.col(key), F.lit("")) == ""
    same = Window.partitionBy(*keys, key).orderBy(key)
    numbered = df.where(~keyless).repartition(*keys, key).withColumn("__copy", F.row_number().over(same))
    return numbered.where(F.col("__copy") == 1).drop("__copy").unionByName(df.where(keyless))


def duplicate_report(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Ids stored more than once and how many copies are surplus."""
    return (
        df.where(F.coalesce(F.col(key), F.lit("")) != "")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .withColumn("extra", F.col("copies") - 1)
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """Records of all sources in one frame; columns a source lacks are NULL."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def order_catalog(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc("CreatedDate"), F.asc("Id"))


def good_prefix(outcomes: DataFrame, created: str = "created", tie: str = "Id", failed: str = "failed") -> DataFrame:
    """Rows before the first failure in ``(created, tie)`` order.

    The first failure is one minimum, found without bringing the rows into order.
    """
    place = F.struct(F.col(created), F.col(tie))
    stop = outcomes.where(F.col(failed)).agg(F.min(place)).scalar()
    return outcomes.where(stop.isNull() | (place < stop))


def advance_watermark(
    outcomes: DataFrame,
    current: Column | None = None,
    created: str = "created",
    tie: str = "Id",
    failed: str = "failed",
) -> DataFrame:
    """New watermark: the newest creation time of the good prefix, never below the
    current one; NULL when there is neither."""
    newest = F.max(created)
    value = newest if current is None else F.greatest(newest, current)
    return good_prefix(outcomes, created, tie, failed).agg(value.alias("watermark"))


def timeline(
    df: DataFrame, day: datetime, user: str, user_field: Column, time: str = "timestamp", slack_hours: int | None = None
) -> DataFrame:
    """Everything one user did on one day, in order. Where the rows have the archive's partition
    keys, hours that lie more than a day before it are passed over. Events may arrive at any time
    later, by a backfill or a late file; with ``slack_hours`` only those that arrived within so many hours
    around the day are read."""
    end = day + timedelta(days=1)
    if "part_hour" in df.columns:
        df = partition_filter(df, day, end, slack_hours, time)
    return df.where((F.col(time) >= ts_lit(day)) & (F.col(time) < ts_lit(end)) & (user_field == user)).orderBy(time)
