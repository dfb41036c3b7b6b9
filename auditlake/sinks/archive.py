"""Archive writers: objects first, then their manifests."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.envelope import to_envelope
from auditlake.functions.layout import MANIFESTS, partition_columns, sanitize_key
from auditlake.functions.times import rfc3339, utc
from auditlake.schemas import (
    COLLECTOR,
    COLLECTOR_VERSION,
    HOUR_KEYS,
    MANIFEST_VERSION,
    PART_KEYS,
)
from auditlake.session import stage
from auditlake.sources.archive import describe_stored, raw_root

DEFAULT_RECORDS_PER_OBJECT = 10_000

# Files a task writes side by side, each with a gzip buffer.
OPEN_FILES = 32
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def unique_unit(now: datetime) -> str:
    """Collision-resistant object name for sources that only append."""
    return f"{int(utc(now).timestamp() * 1000)}-{uuid.uuid4().hex[:16]}"


def part_keys() -> dict[str, Column]:
    """Partition keys of a normalised record; the object's type names its folder."""
    keys = partition_columns(
        F.col("source"),
        F.col("org_id"),
        F.coalesce("object_type", "event_type"),
        F.col("partition_time"),
    )
    return {**keys, "unit": sanitize_key(F.col("object_name"), "object")}


def object_meta(records: DataFrame, lineage: Column | None = None) -> DataFrame:
    """Units of a set of records, per hour folder, with one lineage for all."""
    return (
        records.select(
            "source", "org_id", "instance",
            F.coalesce("object_type", "event_type").alias("object_type"),
            F.date_trunc("hour", "partition_time").alias("partition_time"),
            "object_name",
        )
        .distinct()
        .withColumn(
            "lineage", F.lit(None).cast("map<string,string>") if lineage is None else lineage
        )
    )


def _keyed_meta(meta: DataFrame) -> DataFrame:
    meta = meta.withColumn("event_type", F.col("object_type"))
    return meta.select(
        *[c.alias(k) for k, c in part_keys().items()],
        F.col("source").alias("m_source"),
        F.col("org_id").alias("m_org"),
        F.col("instance").alias("m_instance"),
        F.col("object_type").alias("m_type"),
        "lineage",
    )


def touched_hours(root: str, meta: DataFrame) -> list[str]:
    """Hour folders of a write. Bounded by event types x hours, as is the list of
    output folders Spark's own commit keeps on the driver."""
    hours = _keyed_meta(meta).select(*HOUR_KEYS).distinct()
    return [
        "/".join([raw_root(root), *[f"{k}={row[k]}" for k in HOUR_KEYS]])
        for row in hours.toLocalIterator()
    ]


def write_archive(
    records: DataFrame,
    root: str,
    records_per_object: int = DEFAULT_RECORDS_PER_OBJECT,
) -> None:
    """Write normalised records as gzip NDJSON objects below the Hive layout.

    A unit (`object_name`) owns its folder, so writing it again replaces its objects
    and nothing else; sources that only append give every write a unique name. Each
    write is staged on its own, so several may run into one archive at a time.
    REBALANCE brings the rows of one folder together and lets Spark
    split a folder that holds far more than the others, so one busy event type
    becomes several objects written side by side.
    """
    lines = records.select(
        to_envelope().alias("value"), *[c.alias(f"k_{k}") for k, c in part_keys().items()]
    ).select("value", *[F.col(f"k_{k}").alias(k) for k in PART_KEYS])
    writer = (
        lines.hint("rebalance", *PART_KEYS)
        .write.partitionBy(*PART_KEYS)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_object)
    )
    _replace_folders(records.sparkSession, writer, raw_root(root))


def _replace_folders(spark: SparkSession, writer, target: str) -> None:
    """Replace exactly the folders that receive rows.

    Tasks keep the files of up to `OPEN_FILES` folders open instead of sorting all their rows by folder
    first; rows of further folders are sorted.
    """
    before = spark.conf.get(_OPEN_FILES, None)
    spark.conf.set(_OPEN_FILES, str(OPEN_FILES))
    try:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").text(target)
    finally:
        spark.conf.unset(_OPEN_FILES) if before is None else spark.conf.set(_OPEN_FILES, before)


def key_part(object_key: Column, name: str) -> Column:
    return F.regexp_extract(object_key, rf"/{name}=([^/]*)", 1)


def describe_objects(facts: DataFrame, meta: DataFrame) -> DataFrame:
    """Manifest records of scanned objects and the units they belong to."""
    keyed = facts.select("*", *[key_part(F.col("object_key"), k).alias(k) for k in PART_KEYS])
    return keyed.join(_keyed_meta(meta), PART_KEYS).select(
        F.lit(MANIFEST_VERSION).alias("manifestVersion"),
        F.lit(COLLECTOR).alias("collector"),
        F.lit(COLLECTOR_VERSION).alias("collectorVersion"),
        F.col("m_source").alias("source"),
        F.coalesce("m_org", F.lit("")).alias("orgId"),
        F.coalesce("m_instance", F.lit("")).alias("instance"),
        F.col("m_type").alias("eventType"),
        F.col("object_key").alias("objectKey"),
        F.col("records").alias("recordCount"),
        F.col("uncompressed").alias("uncompressedBytes"),
        F.col("compressed").alias("compressedBytes"),
        "sha256",
        rfc3339(F.col("first_ts")).alias("firstTimestamp"),
        rfc3339(F.col("last_ts")).alias("lastTimestamp"),
        rfc3339(F.current_timestamp()).alias("ingestedAt"),
        "lineage",
    )


def write_manifests(
    spark: SparkSession,
    root: str,
    meta: DataFrame,
    unit: str | None = None,
) -> None:
    """One manifest file per object of a finished write, below its own prefix.

    The objects are read back, so a manifest states what is stored, not what was
    meant to be stored. ``meta`` has one row per unit and hour; ``unit`` narrows the
    scan where a write has a single one.
    """
    meta = stage(meta, "units")  # a row per unit and hour, used twice
    facts = describe_stored(spark, root, touched_hours(root, meta), unit)
    put_manifests(describe_objects(facts, meta), root)


def put_manifests(manifests: DataFrame, root: str) -> None:
    keyed = manifests.select(
        F.to_json(F.struct(*manifests.columns)).alias("value"),
        *[key_part(F.col("objectKey"), k).alias(k) for k in PART_KEYS],
    )
    # Each row becomes a file, so the number of files sets the cost, not their bytes, and they
    # are dealt by object: one unit may hold nearly all of them.
    slots = manifests.sparkSession.sparkContext.defaultParallelism
    spread = keyed.withColumn("key", F.xxhash64("value")).repartition(slots, "key").drop("key")
    writer = spread.write.partitionBy(*PART_KEYS).option("maxRecordsPerFile", 1)
    _replace_folders(manifests.sparkSession, writer, f"{root.rstrip('/')}/{MANIFESTS}")


def archive_units(
    records: DataFrame,
    root: str,
    meta: DataFrame | None = None,
    unit: str | None = None,
    records_per_object: int = DEFAULT_RECORDS_PER_OBJECT,
) -> None:
    """Objects, then manifests. Callers move watermarks only after this returns."""
    meta = object_meta(records) if meta is None else meta
    write_archive(records, root, records_per_object)
    write_manifests(records.sparkSession, root, meta, unit)
