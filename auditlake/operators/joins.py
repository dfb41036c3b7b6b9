"""Equi-joins of the archive and the verifier.

No side is broadcast by hand: Spark broadcasts what it measures to be small and
splits skewed partitions of the rest. Rows without a key bypass the joins, where
they would otherwise gather in one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_objects(objects: DataFrame, manifests: DataFrame, key: str = "object_key") -> DataFrame:
    """Objects and manifests side by side; `side` tells which of them exist."""
    left = objects.withColumn("has_object", F.lit(True))
    right = manifests.withColumn("has_manifest", F.lit(True))
    side = (
        F.when(F.col("has_object") & F.col("has_manifest"), F.lit("matched"))
        .when(F.col("has_object"), F.lit("object_only"))
        .otherwise(F.lit("manifest_only"))
    )
    return left.join(right, key, "full_outer").withColumn("side", side).drop("has_object", "has_manifest")


def missing_ids(expected: DataFrame, seen: DataFrame) -> DataFrame:
    keys = ["source", "grp", "id"]
    return expected.join(seen.select(*keys), keys, "left_anti")


def unexpected_ids(seen: DataFrame, expected: DataFrame) -> DataFrame:
    """Archived ids nobody listed."""
    keys = ["source", "grp", "id"]
    return seen.join(expected.select(*keys).distinct(), keys, "left_anti")


def skip_processed(files: DataFrame, markers: DataFrame, key: str = "Id") -> DataFrame:
    """Files that carry no live marker."""
    return files.join(markers.select(F.col("key").alias(key)), key, "left_anti")


def skip_archived_rows(rows: DataFrame, markers: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Rows that were not archived before; rows without a key are always kept."""
    keyless = F.coalesce(F.col(key), F.lit("")) == ""
    fresh = rows.where(~keyless).join(markers.select(F.col("key").alias(key)), key, "left_anti")
    return fresh.select(*rows.columns).unionByName(rows.where(keyless))


def attach_catalog(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Log-file rows with the listing columns of their file."""
    return rows.join(catalog.withColumnRenamed("Id", "file_id"), "file_id")


def attach_lineage(lines: DataFrame, manifests: DataFrame) -> DataFrame:
    """Lines with the topic of their object; empty where no manifest exists."""
    topics = manifests.select(
        F.col("objectKey").alias("object_key"),
        F.try_element_at("lineage", F.lit("topic")).alias("topic"),
    )
    return lines.join(topics, "object_key", "left").withColumn(
        "topic", F.coalesce("topic", F.lit(""))
    )


def attach_schema(events: DataFrame, schemas: DataFrame, key: str = "schema_id") -> DataFrame:
    """Events with the name of their schema. An unknown schema stops the job before
    anything is committed: it is a lookup that has to be repeated, not a bad event."""
    joined = events.join(
        schemas.select(key, F.col("schema_name").alias("found_name")), key, "left"
    )
    missing = F.raise_error(
        F.concat(F.lit("no schema is known by the id "), F.coalesce(F.col(key), F.lit("(none)")))
    ).cast("string")
    name: Column = F.when(F.col("found_name").isNull(), missing).otherwise(F.col("found_name"))
    return joined.withColumn("schema_name", name).drop("found_name")
