"""Operating tables derived from manifests and state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.times import rfc3339
from auditlake.operators.aggregates import (
    freshness_table,
    incident_table,
    object_stats,
    throughput_table,
    top_values,
    watermark_ages as ages_of,
)
from auditlake.operators.filters import supported_manifests as supported, unsupported_manifests
from auditlake.queries.registry import events, orders, query, table, text6


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of three sources: one object per hour and type of events, and per
    day and status of orders, which arrive as query rows or as file rows."""
    streams = object_stats(
        events(spark, sf_dir).withColumn("slot", F.date_trunc("hour", "ts")), "event_type", "slot", time="ts"
    ).select(
        F.lit("stream").alias("source"), F.col("event_type").alias("eventType"),
        F.col("records").alias("recordCount"), "first_ts", "last_ts",
        F.create_map(F.lit("topic"), F.concat(F.lit("/event/"), "event_type")).alias("lineage"),
    )
    by_day = object_stats(
        orders(spark, sf_dir), "o_orderstatus", "o_orderpriority", "o_orderdate", time="o_orderdate"
    )
    rows = by_day.select(
        F.when(F.col("o_orderstatus") == "O", F.lit("soql")).otherwise(F.lit("eventlog")).alias("source"),
        F.col("o_orderpriority").alias("eventType"),
        F.col("records").alias("recordCount"), "first_ts", "last_ts",
        F.when(F.col("o_orderstatus") == "O", F.create_map(F.lit("from"), F.lit("Order")))
        .otherwise(F.create_map(F.lit("eventLogFileId"), F.date_format("o_orderdate", "yyyyMMdd"))).alias("lineage"),
    )
    return streams.unionByName(rows).select(
        "source", "eventType", "recordCount", "lineage",
        rfc3339(F.col("first_ts")).alias("firstTimestamp"), rfc3339(F.col("last_ts")).alias("lastTimestamp"),
        rfc3339(F.col("last_ts") + F.expr("INTERVAL 1 MINUTE")).alias("ingestedAt"),
    )


@query("""
    SELECT 'stream' AS source, '/event/' || event_type AS name, CAST(count(*) AS BIGINT) AS records,
           CAST(count(DISTINCT date_trunc('hour', ts)) AS BIGINT) AS objects FROM events GROUP BY event_type
    UNION ALL
    SELECT CASE WHEN o_orderstatus = 'O' THEN 'soql' ELSE 'eventlog' END AS s,
           CASE WHEN o_orderstatus = 'O' THEN 'Order' ELSE o_orderpriority END AS n, count(*),
           count(DISTINCT o_orderstatus || o_orderpriority || strftime(o_orderdate, '%Y%m%d')) FROM orders GROUP BY s, n""")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throughput_table(_manifests(spark, sf_dir))


@query("""
    SELECT '/event/' || event_type AS topic, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest_event,
           strftime(max(ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS last_commit,
           CAST(epoch_us(TIMESTAMP '2024-01-31 12:00:00') // 1000000 - epoch_us(max(ts)) // 1000000 AS BIGINT) AS replay_age_seconds,
           CASE WHEN epoch_us(TIMESTAMP '2024-01-31 12:00:00') // 1000000 - epoch_us(max(ts)) // 1000000 > 43500 THEN 'page'
                WHEN epoch_us(TIMESTAMP '2024-01-31 12:00:00') // 1000000 - epoch_us(max(ts)) // 1000000 > 43300 THEN 'warn'
                ELSE 'ok' END AS state
    FROM events GROUP BY event_type""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = freshness_table(_manifests(spark, sf_dir), datetime(2024, 1, 31, 12), 43_300, 43_500)
    return table_.select(
        "topic", text6(F.col("newest_event")).alias("newest_event"),
        text6(F.col("last_commit")).alias("last_commit"), "replay_age_seconds", "state",
    )


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS scope, strftime(max(o_orderdate), '%Y-%m-%d') AS watermark,
           CAST(epoch_us(TIMESTAMP '2001-08-02') // 1000000 - epoch_us(max(o_orderdate)) // 1000000 AS BIGINT) AS age_seconds,
           epoch_us(TIMESTAMP '2001-08-02') // 1000000 - epoch_us(max(o_orderdate)) // 1000000 > 86400 * 30 AS late
    FROM orders GROUP BY o_custkey""")
def watermark_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = orders(spark, sf_dir).groupBy(F.col("o_custkey").cast("string").alias("scope")).agg(
        F.unix_millis(F.max("o_orderdate")).cast("string").alias("value")
    ).select(F.lit("main").alias("instance"), F.lit("query").alias("kind"), "scope", "value")
    return ages_of(marks, datetime(2001, 8, 2), 86_400 * 30).select(
        "scope", F.date_format("watermark", "yyyy-MM-dd").alias("watermark"), "age_seconds", "late"
    )


@query("""
    SELECT o_orderpriority AS "eventType", CASE o_orderstatus WHEN 'F' THEN 'quarantined' ELSE 'unavailable' END AS incident,
           CAST(count(DISTINCT o_custkey) AS BIGINT) AS files
    FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL""")
def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined and unavailable files; a file in several objects counts once."""
    reason = F.when(F.col("o_orderstatus") == "F", F.lit("quarantineReason")).when(
        F.col("o_orderstatus") == "P", F.lit("unavailableReason")
    ).otherwise(F.lit("interval"))
    manifests = orders(spark, sf_dir).select(
        F.col("o_orderpriority").alias("eventType"),
        F.create_map(
            F.lit("eventLogFileId"), F.col("o_custkey").cast("string"), reason, F.lit("because")
        ).alias("lineage"),
    )
    return incident_table(manifests)


@query("""
    SELECT o_orderkey AS n, o_orderstatus = 'P' AS other FROM orders""")
def manifest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests this format reads, and the others."""
    manifests = orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("n"),
        F.when(F.col("o_orderstatus") == "P", F.lit(1)).otherwise(F.lit(2)).alias("manifestVersion"),
    )
    return (
        supported(manifests).withColumn("other", F.lit(False))
        .unionByName(unsupported_manifests(manifests).withColumn("other", F.lit(True)))
        .select("n", "other")
    )


@query("""
    SELECT l_returnflag || l_linestatus AS pair, CAST(count(*) AS BIGINT) AS n FROM lineitem
    WHERE l_quantity > 10 GROUP BY 1""")
def top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered counts, most frequent first."""
    items = table(spark, sf_dir, "lineitem")
    return top_values(items, F.concat("l_returnflag", "l_linestatus"), "pair", F.col("l_quantity") > 10)
