"""Aggregates over archived lines, batches, manifests and failure logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditlake.functions.ids import json_string_field
from auditlake.functions.times import ZERO_TIME_TEXT, parse_rfc3339, ts_lit
from auditlake.schemas import EVENTLOG, SOQL, STREAM


def known_time(ts: Column) -> Column:
    """NULL for the zero time, which would make every range start at year 1."""
    return F.when(ts > F.lit(ZERO_TIME_TEXT).cast("timestamp"), ts)


def object_stats(lines: DataFrame, *keys: str, time: str = "timestamp") -> DataFrame:
    """Record count and time range per object; NULL range if no time is known."""
    ts = known_time(F.col(time))
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def records_by_source(scan: DataFrame) -> DataFrame:
    """Records per source from per-object counters; the caller leaves out objects
    that cannot be read or have an unsupported format."""
    return scan.groupBy(F.col("line_source").alias("source")).agg(
        F.sum("records").alias("records")
    )


LEDGER_SOURCES = (STREAM, EVENTLOG, SOQL)


def line_ref(source: Column, payload: Column) -> Column:
    """The identifier that a ledger lists a line by; blank where it is missing or no text."""
    def ref(name: str) -> Column:
        return F.coalesce(json_string_field(payload, name), F.lit(""))

    return (
        F.when(source == STREAM, ref("EventIdentifier"))
        .when(source == EVENTLOG, ref("REQUEST_ID"))
        .when(source == SOQL, ref("Id"))
    )


def ledger_group(source: Column, topic: Column, event_type: Column) -> Column:
    """Streams are grouped by topic, log files pooled, query rows grouped by event type."""
    return (
        F.when(source == STREAM, F.coalesce(topic, F.lit("")))
        .when(source == SOQL, event_type)
        .otherwise(F.lit(""))
    )


def record_refs(lines: DataFrame) -> DataFrame:
    """`(source, grp, id)` of archived lines, the identifiers a ledger lists; limits carry none."""
    source = F.col("source")
    return lines.where(source.isin(*LEDGER_SOURCES)).select(
        source,
        ledger_group(source, F.col("topic"), F.col("event_type")).alias("grp"),
        line_ref(source, F.col("payload")).alias("id"),
    )


def scanned_ids(scan: DataFrame) -> DataFrame:
    """`id_occurrences` from the counters of `scan_objects` (with `topic`)."""
    source = F.col("line_source")
    rows = scan.where(source.isin(*LEDGER_SOURCES)).select(
        source.alias("source"),
        ledger_group(source, F.col("topic"), F.coalesce("line_type", F.lit(""))).alias("grp"),
        F.col("line_id").alias("id"),
        "records",
    )
    return rows.groupBy("source", "grp", "id").agg(F.sum("records").alias("n"))


def id_occurrences(refs: DataFrame) -> DataFrame:
    """How often each identifier was archived."""
    return refs.groupBy("source", "grp", "id").agg(F.count(F.lit(1)).alias("n"))


def gap_report(expected: DataFrame, seen: DataFrame) -> DataFrame:
    """Expected ids against archived ones, per source and group of the ledger.

    Both sides are counted per id before they meet, so one id repeated without end
    is a single row in the join. `expected` counts list entries, `archived_unique`
    distinct archived ids, listed or not.
    """
    keys = ["source", "grp", "id"]
    listed = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("listed"))
    both = listed.join(seen.select(*keys, "n"), keys, "full_outer")
    groups = expected.select("source", "grp").distinct()
    gaps = both.groupBy("source", "grp").agg(
        F.coalesce(F.sum("listed"), F.lit(0)).cast("bigint").alias("expected"),
        F.count("n").alias("archived_unique"),
        F.coalesce(F.sum(F.when(F.col("n").isNull(), F.col("listed"))), F.lit(0))
        .cast("bigint").alias("missing"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )
    return gaps.join(groups, ["source", "grp"], "left_semi")


def missing_examples(missing: DataFrame, order: str = "ord", n: int = 10) -> DataFrame:
    """The first ``n`` missing ids of each group in list order, then sorted."""
    # Spark keeps only n rows per group and task before it shuffles.
    ranked = missing.withColumn(
        "rank", F.row_number().over(W.partitionBy("source", "grp").orderBy(order, "id"))
    ).where(F.col("rank") <= n)
    return ranked.groupBy("source", "grp").agg(
        F.sort_array(F.collect_list("id")).alias("missing_examples")
    )


def duplicate_object_keys(manifests: DataFrame) -> DataFrame:
    """Second and later manifests, in path order, that name one object key."""
    firsts = (
        manifests.groupBy("objectKey")
        .agg(F.min("manifest_path").alias("first_path"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
    return (
        manifests.join(firsts, "objectKey")
        .where(F.col("manifest_path") != F.col("first_path"))
        .select("manifest_path", "objectKey")
    )


def batch_range(events: DataFrame, *keys: str, position: str = "replay_id", order: str = "seq") -> DataFrame:
    """First and last position per key in arrival order."""
    return events.groupBy(*keys).agg(
        F.min_by(position, order).alias("first_position"),
        F.max_by(position, order).alias("last_position"),
        F.count(F.lit(1)).alias("records"),
    )


def commit_position(events: DataFrame, position: str = "replay_id", order: str = "seq") -> DataFrame:
    """Position of the last event of the batch, whatever its type."""
    return events.agg(F.max_by(position, order).alias("commit_position"))


def newest_event_time(events: DataFrame, *keys: str, time: str = "timestamp") -> DataFrame:
    return events.groupBy(*keys).agg(F.max(time).alias("newest_event"))


def attempt_counts(failures: DataFrame, attempts: DataFrame) -> DataFrame:
    """Consecutive failures per key including this one."""
    return failures.join(attempts.select("key", "n"), "key", "left").withColumn(
        "attempts", F.coalesce(F.col("n"), F.lit(0)) + 1
    ).drop("n")


def top_values(df: DataFrame, key: Column, name: str = "value", condition: Column | None = None) -> DataFrame:
    """Counts per value, most frequent first."""
    rows = df if condition is None else df.where(condition)
    return (
        rows.groupBy(key.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(name))
    )


def batch_metrics() -> list[Column]:
    """Measures taken while a batch flows by, for `DataFrame.observe`."""
    return [
        F.count(F.lit(1)).alias("records"),
        F.max("timestamp").alias("newest_event"),
        F.count_if(F.coalesce("event_id", F.lit("")) == "").alias("without_id"),
    ]


def throughput_table(manifests: DataFrame) -> DataFrame:
    """Records and objects by source and name: topic of a stream, queried object of a
    query, event type otherwise."""
    name = F.coalesce(
        F.when(F.col("source") == STREAM, F.try_element_at("lineage", F.lit("topic"))),
        F.when(F.col("source") == SOQL, F.try_element_at("lineage", F.lit("from"))),
        F.col("eventType"),
    )
    return manifests.groupBy("source", name.alias("name")).agg(
        F.sum("recordCount").alias("records"), F.count(F.lit(1)).alias("objects")
    )


def freshness_table(
    manifests: DataFrame, now: datetime, warn_seconds: int = 43_200, page_seconds: int = 86_400
) -> DataFrame:
    """Newest committed event and last commit per topic, with their ages."""
    topic = F.try_element_at("lineage", F.lit("topic"))
    table = (
        manifests.where(F.col("source") == STREAM)
        .groupBy(topic.alias("topic"))
        .agg(
            F.max(parse_rfc3339(F.col("lastTimestamp"))).alias("newest_event"),
            F.max(parse_rfc3339(F.col("ingestedAt"))).alias("last_commit"),
        )
    )
    age = F.unix_seconds(ts_lit(now)) - F.unix_seconds("newest_event")
    return table.select(
        "topic", "newest_event", "last_commit", age.alias("replay_age_seconds"),
        F.when(age > page_seconds, F.lit("page"))
        .when(age > warn_seconds, F.lit("warn"))
        .otherwise(F.lit("ok")).alias("state"),
    )


def watermark_ages(watermarks: DataFrame, now: datetime, limit_seconds: int) -> DataFrame:
    """Age of every current watermark against its limit."""
    value = F.timestamp_millis(F.col("value").cast("bigint"))
    age = F.unix_seconds(ts_lit(now)) - F.unix_seconds(value)
    return watermarks.select(
        "instance", "kind", "scope", value.alias("watermark"), age.alias("age_seconds"),
        (age > limit_seconds).alias("late"),
    )


def incident_table(manifests: DataFrame) -> DataFrame:
    """Quarantined and unavailable files per event type."""
    has = lambda name: F.map_contains_key("lineage", F.lit(name))
    file_id = F.try_element_at("lineage", F.lit("eventLogFileId"))
    files = manifests.where(F.col("lineage").isNotNull()).select(
        "eventType",
        F.when(has("quarantineReason"), F.lit("quarantined"))
        .when(has("unavailableReason"), F.lit("unavailable")).alias("incident"),
        file_id.alias("file_id"),
    )
    # A quarantined file may be stored as several objects but is one incident.
    return (
        files.where(F.col("incident").isNotNull())
        .distinct()
        .groupBy("eventType", "incident")
        .agg(F.count(F.lit(1)).alias("files"))
    )
