"""Poll windows, markers and watermarks over the test tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.ids import dedup_key, row_version_id
from auditlake.functions.times import rfc3339_seconds
from auditlake.operators.filters import (
    finished_in_window as finished,
    in_window,
    select_fields,
    where,
)
from auditlake.operators.joins import skip_archived_rows, skip_processed
from auditlake.operators.records import advance_watermark, good_prefix
from auditlake.queries.registry import events, orders, query, table, text6
from auditlake.session import workspace
from auditlake.state import QUERY, State, live_markers

SINCE, UNTIL = datetime(1996, 3, 1), datetime(1997, 9, 30, 23, 59, 59, 900_000)


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1997-09-30 23:59:59'""")
def window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one poll window, both ends included."""
    return in_window(orders(spark, sf_dir), "o_orderdate", SINCE, UNTIL).select(
        "o_orderkey", text6(F.col("o_orderdate")).alias("created")
    )


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate >= o_orderdate AND l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate <= TIMESTAMP '1997-09-30 23:59:59'""")
def finished_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that shipped in the window, whenever they were ordered."""
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    rows = finished(items, "l_shipdate", SINCE, UNTIL).join(
        orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rows.where(F.col("l_shipdate") >= F.col("o_orderdate")).select("l_orderkey", "l_partkey", "l_linenumber")


@query("""
    SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, o_orderstatus FROM orders
    WHERE o_totalprice > 100000 AND o_custkey > 10 AND (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT')""")
def user_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured predicate, AND a group of alternatives, then a checked select list."""
    rows = where(
        orders(spark, sf_dir), "o_totalprice > 100000", F.col("o_custkey") > 10, "",
        any_group=["o_orderstatus = 'F'", F.col("o_orderpriority") == "1-URGENT"],
    )
    fields = select_fields(rows, [" o_orderkey", "O_ORDERDATE", "o_orderstatus"], "o_orderdate")
    return fields.select("o_orderkey", F.date_format("O_ORDERDATE", "yyyy-MM-dd").alias("day"), "o_orderstatus")


@query("""
    WITH t AS (SELECT o_orderkey, o_orderdate, o_orderstatus, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderkey || '@' || ts END AS event_id, 1 AS poll
    FROM t WHERE o_orderdate <= TIMESTAMP '1998-01-01'
    UNION ALL
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderkey || '@' || ts END, 2
    FROM t WHERE o_orderdate >= TIMESTAMP '1997-10-01' AND (o_orderdate > TIMESTAMP '1998-01-01' OR o_orderstatus = 'P')""")
def overlapping_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping windows. Repeats are skipped by their markers; rows without an
    id carry none and come twice."""
    rows = orders(spark, sf_dir)
    row_id = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderkey").cast("string"))
    ts = rfc3339_seconds(F.col("o_orderdate"))
    keyed = rows.select(
        "o_orderkey", "o_orderdate", row_version_id(row_id, ts).alias("event_id"),
        dedup_key(F.lit("main"), F.lit("0123456789abcdef"), row_id, ts).alias("dedup_key"),
    )
    first = in_window(keyed, "o_orderdate", datetime(1995, 1, 1), datetime(1998, 1, 1))
    state = State(spark, workspace(spark, "markers"))
    now = datetime(2024, 3, 1)
    state.mark(
        first.where(F.col("dedup_key") != "").select(F.col("dedup_key").alias("key")), "main", QUERY, "q", now
    )
    second = in_window(keyed, "o_orderdate", datetime(1997, 10, 1), datetime(2002, 1, 1))
    fresh = skip_archived_rows(second, state.markers("main", QUERY, "q", now + timedelta(hours=1)))
    both = first.withColumn("poll", F.lit(1)).unionByName(fresh.withColumn("poll", F.lit(2)))
    return both.select("o_orderkey", "event_id", "poll")


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS "Id" FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a marker; every returned item marks its order."""
    files = orders(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("Id"))
    marked = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").cast("string").alias("key")
    )
    return skip_processed(files, marked)


@query("""
    SELECT o_orderkey FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-01-08' - INTERVAL 7 DAY""")
def marker_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker exactly as old as its lifetime is gone."""
    marks = orders(spark, sf_dir).withColumnRenamed("o_orderdate", "marked_at")
    return live_markers(marks, datetime(1998, 1, 8)).select("o_orderkey")


FAILED_SQL = "(event_type = 'error' AND user_id = 8 AND ts > TIMESTAMP '2024-01-10')"


@query(f"""
    SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark, CAST(count(*) AS BIGINT) AS archived FROM events
    WHERE (ts, event_id) < (SELECT (ts, event_id) FROM events WHERE {FAILED_SQL} ORDER BY ts, event_id LIMIT 1)""")
def watermark_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a poll gets: up to the row before the first failure."""
    failed = (F.col("event_type") == "error") & (F.col("user_id") == 8) & (
        F.col("ts") > F.lit("2024-01-10 00:00:00").cast("timestamp")
    )
    outcomes = events(spark, sf_dir).select(
        F.col("ts").alias("created"), F.col("event_id").alias("Id"), failed.alias("failed")
    )
    done = good_prefix(outcomes).agg(F.count(F.lit(1)).alias("archived"))
    mark = advance_watermark(outcomes, F.lit("2000-01-01 00:00:00").cast("timestamp"))
    return done.select(text6(mark.scalar()).alias("watermark"), "archived")


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS scope, strftime(max(o_orderdate), '%Y-%m-%d') AS watermark
    FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey) GROUP BY o_custkey""")
def current_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value per key of an append-only log of watermark changes."""
    log = orders(spark, sf_dir).select(
        F.lit("main").alias("instance"), F.lit("query").alias("kind"),
        F.col("o_custkey").cast("string").alias("scope"),
        F.unix_millis("o_orderdate").cast("string").alias("value"),
        F.col("o_orderkey").alias("version"),
    )
    root = workspace(spark, "watermarks")
    log.write.parquet(f"{root}/watermarks")
    current = State(spark, root).watermarks()
    return current.select(
        "scope", F.date_format(F.timestamp_millis(F.col("value").cast("bigint")), "yyyy-MM-dd").alias("watermark")
    )
