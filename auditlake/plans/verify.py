"""Verification of a stored archive against its manifests and an expected-id list."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.layout import MANIFESTS
from auditlake.operators import verify as checks
from auditlake.operators.aggregates import (
    gap_report,
    line_ref,
    missing_examples,
    records_by_source,
    scanned_ids,
)
from auditlake.operators.joins import attach_lineage, match_objects, missing_ids
from auditlake.schemas import MANIFEST, MANIFEST_VERSION
from auditlake.session import empty, path_exists, stage
from auditlake.sources.archive import object_facts, object_folders, object_versions, read_manifests, scan_objects

# Finding kinds that fail a verification; an object without manifest fails only in
# strict mode, because a repeated batch may leave one behind.
FAILING = [
    "manifest_mismatch",
    "manifest_without_object",
    "unreadable_object",
    "unreadable_manifest",
    "unsupported_manifest",
]
ORPHAN = "object_without_manifest"


@dataclass(frozen=True)
class Verification:
    """Detail tables of one run; `report` condenses them into one row."""

    findings: DataFrame
    records_by_source: DataFrame
    objects: DataFrame
    manifests: DataFrame
    gaps: DataFrame | None
    examples: DataFrame | None
    strict: bool

    def report(self) -> DataFrame:
        return verify_report(
            self.findings, self.records_by_source, self.objects, self.manifests, self.gaps, self.strict
        )


def scanned(spark: SparkSession, root: str, ledger: str, line_ref) -> DataFrame:
    """What each object holds, from the ledger where an object is unchanged since it was read.

    The ledger keeps the counters of every object by key, size and time; with ``line_ref`` also those of its
    identifiers, in a part of its own. Only objects that are not there in this version are inflated: their
    folders alone are read. Of an object's versions the last that was read counts.
    """
    stored = f"{ledger.rstrip('/')}/{'lines' if line_ref is None else 'identifiers'}"
    listed = stage(object_versions(spark, root), "listed-objects")
    version = ["object_key", "compressed", "modified"]
    if path_exists(spark, stored):
        noted = spark.read.parquet(stored)
        newest = noted.groupBy(*version).agg(F.max("run").alias("run"))
        noted = noted.join(newest, [*version, "run"], "left_semi").join(listed, version, "left_semi")
        new = stage(listed.join(newest, version, "left_anti"), "unverified-objects")
    else:
        noted, new = None, listed
    if new.isEmpty():
        return noted.drop("modified", "run") if noted is not None else scan_objects(spark, root, line_ref=line_ref)
    paths = None if noted is None else object_folders(new, root)
    found = scan_objects(spark, root, paths, line_ref=line_ref).join(new.select("object_key"), "object_key", "left_semi")
    found = stage(found, "scan")
    # An object that was replaced while it was read is not noted, and so read again.
    found.join(new, ["object_key", "compressed"]).withColumn("run", F.current_timestamp()).write.mode("append").parquet(stored)
    # The noted part was listed before the new one was written.
    return found if noted is None else noted.drop("modified", "run").unionByName(found)


def verify_archive(
    spark: SparkSession, root: str, expected: DataFrame | None = None, strict: bool = False, ledger: str | None = None
) -> Verification:
    """Check every object against its manifest and, where ``expected`` (`source, grp,
    ord, id`) is given, every archived id against that list. The objects are read once, or, with the
    folder of a ``ledger``, only those that are new or changed since it was last used."""
    if path_exists(spark, f"{root.rstrip('/')}/{MANIFESTS}"):
        manifests = read_manifests(spark, root)
    else:
        manifests = empty(spark, f"manifest_path string, manifest struct<{_struct(MANIFEST)}>")
    manifests = stage(manifests, "manifests")
    ref = line_ref if expected is not None else None
    scan = scan_objects(spark, root, line_ref=ref) if ledger is None else scanned(spark, root, ledger, ref)
    scan = stage(scan, "scan")
    objects = object_facts(scan)
    firsts, surplus = checks.usable_manifests(manifests)
    firsts = stage(firsts, "first-manifests")
    matched = match_objects(objects, firsts.withColumnRenamed("objectKey", "object_key"))
    findings = functools.reduce(
        DataFrame.unionByName,
        [
            checks.object_findings(matched),
            surplus,
            checks.manifests_without_key(manifests),
            checks.unreadable_manifests(manifests),
            checks.unsupported(firsts),
        ],
    )
    findings = stage(findings, "findings")
    skipped = findings.where(F.col("kind") == "unreadable_object").select(
        F.col("key").alias("object_key")
    ).unionByName(
        firsts.where(
            F.coalesce("manifest.manifestVersion", F.lit(0)) != MANIFEST_VERSION
        ).select(F.col("objectKey").alias("object_key"))
    )
    by_source = records_by_source(
        scan.where(F.col("line_source").isNotNull()).join(skipped, "object_key", "left_anti")
    )
    gaps = examples = None
    if expected is not None:
        # Damaged objects are left out here: they are findings already.
        counted = scan.join(skipped, "object_key", "left_anti")
        counted = attach_lineage(counted, firsts.select("objectKey", "manifest.lineage"))
        seen = stage(scanned_ids(counted), "seen")
        gaps = stage(gap_report(expected, seen), "gaps")
        examples = missing_examples(missing_ids(expected, seen))
    return Verification(findings, by_source, objects, manifests, gaps, examples, strict)


def _struct(schema: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ", 1) for f in schema.split(", ")))


def verify_report(
    findings: DataFrame,
    by_source: DataFrame,
    objects: DataFrame,
    manifests: DataFrame,
    gaps: DataFrame | None,
    strict: bool = False,
) -> DataFrame:
    """One row: how many of each finding, and whether the archive is complete."""
    # Each input becomes (measure, n) rows of its own, summed up together.
    measures = [
        objects.agg(F.count(F.lit(1)).alias("n")).select(F.lit("objects").alias("measure"), "n"),
        manifests.agg(F.count(F.lit(1)).alias("n")).select(F.lit("manifests").alias("measure"), "n"),
        by_source.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).select(
            F.lit("records").alias("measure"), "n"
        ),
        findings.groupBy(F.col("kind").alias("measure")).agg(F.count(F.lit(1)).alias("n")),
    ]
    if gaps is not None:
        measures.append(
            gaps.agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("n")).select(
                F.lit("missing").alias("measure"), "n"
            )
        )
    table = functools.reduce(DataFrame.unionByName, measures)
    names = ["objects", "manifests", "records", *FAILING, ORPHAN, "missing"]
    wide = table.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).cast("bigint").alias(m)
            for m in names
        ]
    )
    failing = [*FAILING, "missing", *([ORPHAN] if strict else [])]
    ok = functools.reduce(lambda a, b: a & b, [F.col(m) == 0 for m in failing])
    return wide.withColumn("ok", ok)
