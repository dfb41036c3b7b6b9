"""Positions whose events are gone: files that a stream has taken note of but not yet archived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.session import child_names, empty

# How Spark's file source notes a file in its checkpoint.
_ENTRY = "path string, timestamp bigint, batchId bigint"


class OutsideRetentionError(RuntimeError):
    """Events between the stored position and what is still there cannot be read any more."""


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that was archived; -1 where there is none."""
    done = [int(n) for n in child_names(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()]
    return max(done, default=-1)


def pending_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path, batch_id): files noted for a batch that was not committed, from the source's own log."""
    log = f"{checkpoint.rstrip('/')}/sources/0"
    if not any(n.partition(".")[0].isdigit() for n in child_names(spark, log)):
        return empty(spark, "path string, batch_id bigint")
    entry = F.from_json("value", _ENTRY)
    # The first line of a log file names its format.
    return (
        spark.read.text(log).where(F.col("value").startswith("{"))
        .select(entry.alias("e")).select(F.col("e.path").alias("path"), F.col("e.batchId").alias("batch_id"))
        .where(F.col("batch_id") > last_commit(spark, checkpoint))
        .distinct()
    )


def _plain(path: Column) -> Column:
    """A path with one slash behind its scheme, as some listings write `file:/x` and others `file:///x`."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def lost_files(spark: SparkSession, landed: DataFrame, checkpoint: str) -> DataFrame:
    """Pending files that are not among the ``landed`` ones (`path`)."""
    pending = pending_files(spark, checkpoint)
    there = landed.select(_plain(F.col("path")).alias("there"))
    return pending.join(there, _plain(F.col("path")) == F.col("there"), "left_anti")


def require_retained(spark: SparkSession, landed: DataFrame, checkpoint: str, shown: int = 5) -> None:
    """Stop where a pending file is gone: going on would leave a gap that nobody notices."""
    lost = lost_files(spark, landed, checkpoint)
    examples = [r.path for r in lost.orderBy("path").limit(shown).collect()]
    if examples:
        raise OutsideRetentionError(
            f"{lost.count()} landed file(s) were removed before they were archived, such as {', '.join(examples)}"
        )
