"""Flushes: a batch stored in parts of at most so many events, each with a position range of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlake.session import stage

# `monotonically_increasing_id` keeps the place inside a task in its lower bits.
_PLACE_BITS = 33


def in_flushes(records: DataFrame, limit: int, order: str = "seq", unit: str = "object_name") -> DataFrame:
    """``records`` with the number of their flush at the end of their unit's name.

    Events are dealt to ranges of their order and sorted there; a place in the batch is the number of
    events in earlier ranges and the place in its own, so no task sees the whole batch. The order is
    that of the landed files, whatever splits they are read in: a repeated batch has the same flushes.
    """
    if limit < 1:
        raise ValueError("a flush needs at least one event")
    ranged = records.repartitionByRange(order).sortWithinPartitions(order)
    placed = stage(ranged.withColumn("__at", F.monotonically_increasing_id()), "flushes")
    part = F.shiftright("__at", _PLACE_BITS)
    # One row for each task.
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col("__at").bitwiseAND((1 << _PLACE_BITS) - 1)
    number = F.lpad(F.floor(place / limit).cast("string"), 9, "0")
    return (
        placed.withColumn("__part", part)
        .join(starts, "__part")
        .withColumn(unit, F.concat(unit, F.lit("-"), number))
        .select(*records.columns)
    )
