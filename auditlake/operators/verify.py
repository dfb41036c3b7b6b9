"""Comparison rules of the verifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions.times import parse_rfc3339
from auditlake.operators.aggregates import duplicate_object_keys
from auditlake.operators.filters import unsupported_manifests
from auditlake.schemas import MANIFEST_VERSION

FINDING = ["kind", "key", "detail"]


def _number_diff(what: str, actual: Column, stated: Column) -> Column:
    return F.when(
        ~actual.eqNullSafe(stated),
        F.concat(
            F.lit(f"{what}: "), actual.cast("string"),
            F.lit(" found, "), F.coalesce(stated.cast("string"), F.lit("none")), F.lit(" stated"),
        ),
    )


def manifest_diff(
    records: Column, compressed: Column, uncompressed: Column, sha256: Column,
    first: Column, last: Column, manifest: Column,
) -> Column:
    """Every way an object differs from its manifest, joined by `; `; empty if none.
    Times are compared as instants and two missing ones are equal."""
    times_equal = first.eqNullSafe(parse_rfc3339(manifest["firstTimestamp"])) & last.eqNullSafe(
        parse_rfc3339(manifest["lastTimestamp"])
    )
    return F.concat_ws(
        "; ",
        _number_diff("lines", records, manifest["recordCount"]),
        _number_diff("stored bytes", compressed, manifest["compressedBytes"]),
        _number_diff("bytes of text", uncompressed, manifest["uncompressedBytes"]),
        F.when(~sha256.eqNullSafe(manifest["sha256"]), F.lit("another checksum")),
        F.when(~times_equal, F.lit("another time range")),
    )


def unreadable_manifests(manifests: DataFrame) -> DataFrame:
    return manifests.where(F.col("manifest").isNull()).select(
        F.lit("unreadable_manifest").alias("kind"),
        F.col("manifest_path").alias("key"),
        F.lit("manifest cannot be parsed").alias("detail"),
    )


def _keyed(manifests: DataFrame) -> DataFrame:
    return manifests.where(F.col("manifest").isNotNull())


def manifests_without_key(manifests: DataFrame) -> DataFrame:
    return _keyed(manifests).where(F.coalesce("manifest.objectKey", F.lit("")) == "").select(
        F.lit("manifest_mismatch").alias("kind"),
        F.col("manifest_path").alias("key"),
        F.lit("manifest has no objectKey").alias("detail"),
    )


def usable_manifests(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First manifest of every object key, and findings about the later ones."""
    keyed = _keyed(manifests).where(F.coalesce("manifest.objectKey", F.lit("")) != "").select(
        "manifest_path", F.col("manifest.objectKey").alias("objectKey"), "manifest"
    )
    surplus = duplicate_object_keys(keyed)
    findings = surplus.select(
        F.lit("manifest_mismatch").alias("kind"),
        F.col("manifest_path").alias("key"),
        F.concat(F.lit("duplicate objectKey "), "objectKey").alias("detail"),
    )
    firsts = keyed.join(surplus.select("manifest_path"), "manifest_path", "left_anti")
    return firsts, findings


def unsupported(firsts: DataFrame) -> DataFrame:
    """Manifests of another format; their objects are not compared."""
    version = F.coalesce("manifest.manifestVersion", F.lit(0))
    listed = unsupported_manifests(
        firsts.withColumn("manifestVersion", F.col("manifest.manifestVersion"))
    )
    return listed.select(
        F.lit("unsupported_manifest").alias("kind"),
        F.col("manifest_path").alias("key"),
        F.concat(
            F.lit("manifestVersion "), version.cast("string"),
            F.lit(f", this verifier reads {MANIFEST_VERSION}"),
        ).alias("detail"),
    )


def object_findings(matched: DataFrame) -> DataFrame:
    """One finding per object or manifest that does not pass; an unreadable object is
    reported once, never also as mismatched or missing."""
    supported = F.coalesce(F.col("manifest.manifestVersion") == MANIFEST_VERSION, F.lit(True))
    diff = manifest_diff(
        F.col("records"), F.col("compressed"), F.col("uncompressed"), F.col("sha256"),
        F.col("first_ts"), F.col("last_ts"), F.col("manifest"),
    )
    kind = (
        F.when(F.col("side") == "manifest_only", F.lit("manifest_without_object"))
        .when(~supported, F.lit(None))
        .when(F.col("error").isNotNull(), F.lit("unreadable_object"))
        .when(F.col("side") == "object_only", F.lit("object_without_manifest"))
        .when(diff != "", F.lit("manifest_mismatch"))
    )
    detail = (
        F.when(kind == "unreadable_object", F.col("error"))
        .when(kind == "manifest_mismatch", diff)
        .otherwise(F.lit(""))
    )
    return matched.select(
        kind.alias("kind"), F.col("object_key").alias("key"), detail.alias("detail")
    ).where(F.col("kind").isNotNull())


def unreadable_objects(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("kind") == "unreadable_object")


def manifests_without_object(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("kind") == "manifest_without_object")


def objects_without_manifest(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("kind") == "object_without_manifest")


def sorted_findings(findings: DataFrame) -> DataFrame:
    return findings.orderBy("kind", "key", "detail")
