"""Parquet copy of the archive for everyday queries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.times import ts_lit
from auditlake.operators.records import EVENT_KEYS, dedup
from auditlake.session import child_names, delete_path, path_exists, stage
from auditlake.sources.archive import object_folders, object_versions, read_archive

CURATED = [
    "event_id", "timestamp", "source", "env", "org_id", "instance", "replay_id", "payload",
    "quarantined", "object_key", "user_id", "event_date", "event_type",
]
# Members that name the user of an event, by source.
USER_FIELDS = ("USER_ID", "UserId")
# Payloads with structure of their own, beside their exact text.
DOCUMENT = "document"
# Users that a file's Bloom filter is made for.
USERS_IN_FILE = 100_000
# What tells a row from others with its id: an id belongs to its source, org, instance and event type. A line
# kept in quarantine is another kind of record than a row parsed from the same file, even under one id.
ROW_KEYS = [*EVENT_KEYS[:-1], "quarantined"]
LEDGER = "object_key string, compressed bigint, modified timestamp"
VERSION = ["object_key", "compressed", "modified"]


def copy_rows(archived: DataFrame) -> DataFrame:
    """Archived records with the columns of the copy, repeats and all."""
    kind = F.col("part_unit").endswith("-quarantine") if "part_unit" in archived.columns else F.lit(False)
    rows = archived.withColumn("quarantined", F.coalesce(kind, F.lit(False)))
    user = F.coalesce(*[F.get_json_object("payload", f"$.{f}") for f in USER_FIELDS])
    return rows.withColumn("user_id", user).withColumn("event_date", F.to_date("timestamp")).select(*CURATED)


def curated_rows(archived: DataFrame) -> DataFrame:
    """De-duplicated records with their event date."""
    return dedup(copy_rows(archived), keys=ROW_KEYS)


def compact_to_parquet(
    spark: SparkSession, root: str, out: str, paths: Sequence[str] | None = None, units: bool = True
) -> None:
    """Rewrite archived records as Parquet by event date and type, and note which objects the copy holds.

    The archive is partitioned by arrival, the copy by event time. ``paths`` names hour
    folders that have something new: the event dates found there are rewritten from what the copy has of
    them and the records of these folders, so no other folder of the archive is read. A busy
    date or type is split over several files by REBALANCE.
    """
    if paths:
        _unite(spark, out, read_archive(spark, root, paths, units))
        return
    # Listed before it is read: an object that lands meanwhile is taken for new later, which does no harm.
    listed = stage(object_versions(spark, root), "compacted")
    _write(curated_rows(read_archive(spark, root, units=units)), out)
    listed.write.mode("overwrite").parquet(_ledger(out))


def update_copy(spark: SparkSession, root: str, out: str, units: bool = True) -> int:
    """Bring the copy up to date with all objects that it does not hold yet; returns their number.

    New objects are those whose key, size and time are not in the ledger beside the copy. Only their
    folders are read, and of the copy only the dates of their records. What a unit's folder
    held before it was written again makes room for what it holds now. A run that was cut off is noticed by the next, which makes
    the copy from the whole archive.
    """
    pending = f"{_ledger(out)}-pending"
    if not path_exists(spark, f"{_ledger(out)}/_SUCCESS") or path_exists(spark, pending):
        count = object_versions(spark, root).count()
        compact_to_parquet(spark, root, out, units=units)
        delete_path(spark, pending)
        return count
    held = spark.read.schema(LEDGER).parquet(_ledger(out))
    listed = object_versions(spark, root)
    new = stage(listed.join(held, VERSION, "left_anti"), "new-objects")
    count = new.count()
    if not count:
        return 0
    # Bounded by the units of what is new, like the list of folders that Spark's commit keeps.
    folders = object_folders(new, root)
    rows = read_archive(spark, root, folders, units).join(new.select("object_key"), "object_key", "left_semi")
    # A unit's folder that is written again has objects of other names; its former ones are gone.
    folder = F.regexp_extract("object_key", "^(.*)/[^/]*$", 1).alias("folder")
    same_unit = held.select("object_key", folder).join(new.select(folder).distinct(), "folder", "left_semi")
    unchanged = listed.join(held, VERSION, "left_semi").select("object_key")
    replaced = stage(same_unit.select("object_key").distinct().join(unchanged, "object_key", "left_anti"), "replaced")
    new.write.parquet(pending)
    _unite(spark, out, rows, None if replaced.isEmpty() else replaced)
    new.write.mode("append").parquet(_ledger(out))
    delete_path(spark, pending)
    return count


def _ledger(out: str) -> str:
    return f"{out.rstrip('/')}-objects"


def _in_dates(dates: Sequence) -> Column:
    # As texts: the year 1 stands for no time, and Python's dates of it do not reach Spark.
    known = [F.lit(d.isoformat()).cast("date") for d in dates if d is not None]
    found = F.col("event_date").isin(known) if known else F.lit(False)
    return found | F.col("event_date").isNull() if None in dates else found


def _unite(spark: SparkSession, out: str, archived: DataFrame, replaced: DataFrame | None = None) -> None:
    """Replace the dates of new records by what the copy has of them and the new records."""
    rows = stage(copy_rows(archived), "new-records")
    dates = [r.event_date for r in rows.select("event_date").distinct().collect()]  # calendar days
    if not path_exists(spark, out) or not child_names(spark, out):
        _write(dedup(rows, keys=ROW_KEYS), out)
        return
    stored = spark.read.parquet(out)
    if replaced is not None:
        # Former rows of a replaced object may have other dates.
        of_replaced = stored.select("event_date", "object_key").join(replaced, "object_key", "left_semi")
        dates = list({*dates, *(r.event_date for r in of_replaced.select("event_date").distinct().collect())})
    held = stored.where(_in_dates(dates)).select(*CURATED)
    if replaced is not None:
        held = held.join(replaced, "object_key", "left_anti").select(*CURATED)
    # Written down first: the folders that are read are the ones to be replaced.
    merged = stage(dedup(held.unionByName(rows), keys=ROW_KEYS), "united")
    emptied = [] if replaced is None else _emptied(stored.where(_in_dates(dates)), merged)
    _write(merged, out)
    for folder in emptied:
        delete_path(spark, folder)


def _emptied(stored: DataFrame, merged: DataFrame) -> list[str]:
    """Folders of the copy that lose all their rows: a write replaces only folders that get some."""
    keys = ["event_date", "event_type"]
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1).alias("folder")
    left = merged.select(*[F.col(k).alias(f"m_{k}") for k in keys]).distinct()
    same = F.col("event_date").eqNullSafe(F.col("m_event_date")) & F.col("event_type").eqNullSafe(F.col("m_event_type"))
    return [r.folder for r in stored.select(*keys, folder).distinct().join(left, same, "left_anti").collect()]


def _write(rows: DataFrame, out: str) -> None:
    """Files sorted by user, with a Bloom filter of the users: one user's day reads few pages of few files."""
    keys = ["event_date", "event_type"]
    (
        rows.withColumn(DOCUMENT, F.try_parse_json("payload"))
        .hint("rebalance", *keys)
        .sortWithinPartitions(*keys, "user_id")
        .write.partitionBy(*keys)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#user_id", "true")
        .option("parquet.bloom.filter.expected.ndv#user_id", str(USERS_IN_FILE))
        .parquet(out)
    )


def member(path: str, kind: str) -> Column:
    """A member of the payload at any depth, such as ``$.props.k``; NULL where it is not there or of another kind.

    The copy holds payloads taken apart, so no text is parsed.
    """
    return F.try_variant_get(F.col(DOCUMENT), path, kind)


def copy_timeline(spark: SparkSession, out: str, day: datetime, user: str) -> DataFrame:
    """Everything one user did on one day, in order, from the copy: one date's folders, and there the files
    and pages that can hold the user."""
    start, end = ts_lit(day), ts_lit(day + timedelta(days=1))
    days = F.col("event_date").between(F.to_date(start), F.to_date(end))
    rows = spark.read.parquet(out).where(days & (F.col("user_id") == user))
    return rows.where((F.col("timestamp") >= start) & (F.col("timestamp") < end)).orderBy("timestamp")
