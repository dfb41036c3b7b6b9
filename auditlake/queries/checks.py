"""Reconciliation and verification operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.times import rfc3339
from auditlake.operators import verify as checks
from auditlake.operators.aggregates import (
    batch_metrics,
    batch_range,
    commit_position,
    duplicate_object_keys,
    gap_report as gaps_of,
    id_occurrences,
    missing_examples as examples_of,
    newest_event_time,
    object_stats,
    record_refs,
    records_by_source as by_source,
)
from auditlake.operators.joins import (
    attach_schema,
    match_objects,
    missing_ids as missing_of,
    unexpected_ids as unexpected_of,
)
from auditlake.operators.records import dedup, duplicate_report as duplicates_of, union_sources
from auditlake.queries.registry import event_payload, events, orders, query, table, text6
from auditlake.session import workspace

FIRST_LAST = "strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts"


@query(f"""
    SELECT event_type, strftime(ts, '%Y-%m-%d %H') AS hour, CAST(count(*) AS BIGINT) AS records, {FIRST_LAST}
    FROM events GROUP BY ALL""")
def manifest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and time range per event type and hour."""
    rows = events(spark, sf_dir).withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    stats = object_stats(rows, "event_type", "hour", time="ts")
    return stats.select(
        "event_type", "hour", "records",
        text6(F.col("first_ts")).alias("first_ts"), text6(F.col("last_ts")).alias("last_ts"),
    )


@query("""
    WITH t AS (SELECT event_id, event_type, user_id,
                      CASE WHEN event_type = 'error' THEN TIMESTAMP '0001-01-01' ELSE ts END AS ts FROM events)
    SELECT user_id, CAST(count(*) AS BIGINT) AS records,
           strftime(min(ts) FILTER (event_type <> 'error'), '%Y-%m-%d %H:%M:%S.%f') AS first_ts,
           strftime(max(ts) FILTER (event_type <> 'error'), '%Y-%m-%d %H:%M:%S.%f') AS last_ts
    FROM t GROUP BY user_id""")
def zero_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a known time are counted but do not stretch the range."""
    zero = F.lit("0001-01-01 00:00:00").cast("timestamp")
    rows = events(spark, sf_dir).withColumn(
        "ts", F.when(F.col("event_type") == "error", zero).otherwise(F.col("ts"))
    )
    stats = object_stats(rows, "user_id", time="ts")
    return stats.select(
        "user_id", "records",
        text6(F.col("first_ts")).alias("first_ts"), text6(F.col("last_ts")).alias("last_ts"),
    )


@query("""
    WITH o AS (SELECT user_id AS k, count(*) AS n, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1),
         m AS (SELECT user_id AS k, count(*) AS n, min(ts) AS a, max(ts) AS b FROM events
               WHERE value < 60 GROUP BY 1)
    SELECT CAST(o.k AS VARCHAR) AS key,
           concat_ws('; ',
             CASE WHEN o.n <> m.n THEN 'lines: ' || o.n || ' found, ' || m.n || ' stated' END,
             CASE WHEN o.n <> m.n THEN 'stored bytes: ' || o.n * 7 || ' found, ' || m.n * 7 || ' stated' END,
             CASE WHEN o.n <> m.n THEN 'bytes of text: ' || o.n * 70 || ' found, ' || m.n * 70 || ' stated' END,
             CASE WHEN o.n <> m.n THEN 'another checksum' END,
             CASE WHEN o.a <> m.a OR o.b <> m.b THEN 'another time range' END) AS detail
    FROM o JOIN m USING (k)""")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects (all events of a user) against manifests that know only the small ones."""
    rows = events(spark, sf_dir)
    objects = object_stats(rows, "user_id", time="ts")
    stated = object_stats(rows.where(F.col("value") < 60), "user_id", time="ts")
    digest = lambda n: F.sha2(n.cast("string"), 256)
    manifests = stated.select(
        "user_id",
        F.struct(
            F.col("records").alias("recordCount"),
            (F.col("records") * 7).alias("compressedBytes"),
            (F.col("records") * 70).alias("uncompressedBytes"),
            digest(F.col("records")).alias("sha256"),
            rfc3339(F.col("first_ts")).alias("firstTimestamp"),
            rfc3339(F.col("last_ts")).alias("lastTimestamp"),
        ).alias("manifest"),
    )
    n = F.col("records")
    diff = checks.manifest_diff(
        n, n * 7, n * 70, digest(n), F.col("first_ts"), F.col("last_ts"), F.col("manifest")
    )
    return objects.join(manifests, "user_id").select(
        F.col("user_id").cast("string").alias("key"), diff.alias("detail")
    )


@query("""
    WITH o AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS k FROM orders WHERE o_orderstatus = 'F'),
         m AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS k FROM orders WHERE o_orderstatus = 'P')
    SELECT coalesce(o.k, m.k) AS object_key,
           CASE WHEN o.k IS NOT NULL AND m.k IS NOT NULL THEN 'matched'
                WHEN o.k IS NOT NULL THEN 'object_only' ELSE 'manifest_only' END AS side
    FROM o FULL JOIN m ON o.k = m.k""")
def object_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = orders(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("object_key"), "o_orderstatus"
    )
    objects = keys.where(F.col("o_orderstatus") == "F").select("object_key").distinct()
    manifests = keys.where(F.col("o_orderstatus") == "P").select("object_key").distinct()
    return match_objects(objects, manifests).select("object_key", "side")


# --- expected ids --------------------------------------------------------------------


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.lit("stream").alias("source"), F.concat(F.lit("/event/"), "event_type").alias("grp"),
        F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("id"),
    )


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an archive holds that lost the large values and stored purchases twice."""
    lines = events(spark, sf_dir).select(
        F.lit("stream").alias("source"), "event_type", "value",
        F.concat(F.lit("/event/"), "event_type").alias("topic"), event_payload().alias("payload"),
    )
    twice = lines.where(F.col("event_type") == "purchase")
    return id_occurrences(record_refs(lines.where(F.col("value") < 60).unionByName(twice)))


SEEN_SQL = """
    expected AS (SELECT '/event/' || event_type AS grp, event_id AS ord, CAST(event_id AS VARCHAR) AS id FROM events),
    lines AS (SELECT event_type, event_id FROM events WHERE value < 60
              UNION ALL SELECT event_type, event_id FROM events WHERE event_type = 'purchase'),
    seen AS (SELECT '/event/' || event_type AS grp, CAST(event_id AS VARCHAR) AS id, count(*) AS n
             FROM lines GROUP BY ALL)"""


@query(f"WITH {SEEN_SQL} SELECT 'stream' AS source, grp, id, CAST(n AS BIGINT) AS n FROM seen")
def archived_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seen(spark, sf_dir)


@query(f"""
    WITH {SEEN_SQL}
    SELECT 'stream' AS source, grp, CAST(count(e.id) AS BIGINT) AS expected,
           CAST(count(s.id) AS BIGINT) AS archived_unique,
           CAST(count(*) FILTER (s.id IS NULL) AS BIGINT) AS missing,
           CAST(coalesce(sum(s.n - 1), 0) AS BIGINT) AS duplicates
    FROM expected e FULL JOIN seen s USING (grp, id) GROUP BY grp""")
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps_of(_expected(spark, sf_dir), _seen(spark, sf_dir))


@query(f"""
    WITH {SEEN_SQL}
    SELECT 'stream' AS source, grp, array_to_string(list_sort(list(id)), ',') AS missing_examples FROM (
        SELECT grp, id, row_number() OVER (PARTITION BY grp ORDER BY ord) AS rn
        FROM expected ANTI JOIN seen USING (grp, id)) WHERE rn <= 10 GROUP BY grp""")
def missing_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten missing ids of each topic: a report, not the list of all of them."""
    examples = examples_of(missing_of(_expected(spark, sf_dir), _seen(spark, sf_dir)))
    return examples.withColumn("missing_examples", F.array_join("missing_examples", ","))


@query(f"""
    WITH {SEEN_SQL} SELECT 'stream' AS source, grp, ord, id FROM expected ANTI JOIN seen USING (grp, id)""")
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_of(_expected(spark, sf_dir), _seen(spark, sf_dir)).select("source", "grp", "ord", "id")


@query(f"""
    WITH {SEEN_SQL}
    SELECT 'stream' AS source, grp, id, CAST(n AS BIGINT) AS n FROM seen
    ANTI JOIN (SELECT * FROM expected WHERE ord IN (SELECT event_id FROM events WHERE value >= 10)) USING (grp, id)""")
def unexpected_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived ids that a list without the smallest values does not name."""
    large = events(spark, sf_dir).where(F.col("value") >= 10).select(F.col("event_id").alias("ord"))
    listed = _expected(spark, sf_dir).join(large, "ord", "left_semi")
    return unexpected_of(_seen(spark, sf_dir), listed)


# --- duplicates -------------------------------------------------------------------------


@query("""
    SELECT manifest_path, CAST(o_custkey AS VARCHAR) AS "objectKey" FROM (
        SELECT o_custkey, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS manifest_path,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
    WHERE rn > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as manifests of their customer: all but the first are surplus."""
    manifests = orders(spark, sf_dir).select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("manifest_path"),
        F.col("o_custkey").cast("string").alias("objectKey"),
    )
    return duplicate_object_keys(manifests)


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases stored twice; errors stored twice as well, but without an id."""
    rows = events(spark, sf_dir).select(
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_id").cast("string"))
        .alias("event_id"),
        "event_type", "user_id", event_payload().alias("payload"),
    )
    return rows.unionByName(rows.where(F.col("event_type").isin("purchase", "error")))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, user_id FROM events WHERE event_type <> 'error'
    UNION ALL SELECT '', event_type, user_id FROM events WHERE event_type = 'error'
    UNION ALL SELECT '', event_type, user_id FROM events WHERE event_type = 'error'""")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(_repeated(spark, sf_dir)).select("event_id", "event_type", "user_id")


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(2 AS BIGINT) AS copies, CAST(1 AS BIGINT) AS extra
    FROM events WHERE event_type = 'purchase'""")
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates_of(_repeated(spark, sf_dir))


# --- sources, batches, schemas -------------------------------------------------------------


def _all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope for four kinds of source."""
    streams = events(spark, sf_dir).select(
        F.lit("stream").alias("source"), F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("timestamp"), F.lit("x").alias("replay_id"),
    )
    files = table(spark, sf_dir, "lineitem").select(
        F.lit("eventlog").alias("source"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
    rows = orders(spark, sf_dir).select(
        F.lit("soql").alias("source"), F.col("o_orderkey").cast("string").alias("event_id"),
        F.col("o_orderdate").alias("timestamp"),
    )
    limits = table(spark, sf_dir, "customer").select(
        F.lit("limits").alias("source"), F.col("c_name").alias("event_id")
    )
    return union_sources(streams, files, rows, limits)


@query("""
    WITH u AS (
        SELECT 'stream' AS source, ts AS t, 'x' AS r FROM events
        UNION ALL SELECT 'eventlog', l_shipdate, NULL FROM lineitem
        UNION ALL SELECT 'soql', o_orderdate, NULL FROM orders
        UNION ALL SELECT 'limits', NULL, NULL FROM customer)
    SELECT source, CAST(count(*) AS BIGINT) AS records, CAST(count(r) AS BIGINT) AS positions,
           strftime(max(t), '%Y-%m-%d %H:%M:%S.%f') AS newest
    FROM u GROUP BY source""")
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_sources(spark, sf_dir).groupBy("source").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("replay_id").alias("positions"),
        text6(F.max("timestamp")).alias("newest"),
    )


@query("""
    SELECT 'stream' AS source, CAST(count(*) AS BIGINT) AS records FROM events
    UNION ALL SELECT 'eventlog', count(*) FROM lineitem
    UNION ALL SELECT 'soql', count(*) FROM orders
    UNION ALL SELECT 'limits', count(*) FROM customer""")
def records_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per source out of per-object counters."""
    per_object = (
        _all_sources(spark, sf_dir)
        .withColumn("object_key", F.date_format("timestamp", "yyyy-MM"))
        .groupBy("object_key", F.col("source").alias("line_source"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return by_source(per_object)


@query("""
    SELECT event_type, to_base64(encode(CAST(min(event_id) AS VARCHAR))) AS first_position,
           to_base64(encode(CAST(max(event_id) AS VARCHAR))) AS last_position,
           CAST(count(*) AS BIGINT) AS records,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest_event
    FROM events GROUP BY event_type
    UNION ALL
    SELECT '(commit)', NULL, to_base64(encode(CAST(max(event_id) AS VARCHAR))), NULL, NULL FROM events""")
def batch_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position range and newest time per type, and the position to commit."""
    rows = events(spark, sf_dir).select(
        "event_type", "ts", F.col("event_id").alias("seq"),
        F.base64(F.col("event_id").cast("string").cast("binary")).alias("replay_id"),
    )
    newest = newest_event_time(rows, "event_type", time="ts")
    types = batch_range(rows, "event_type").join(newest, "event_type").withColumn(
        "newest_event", text6(F.col("newest_event"))
    )
    commit = commit_position(rows).select(
        F.lit("(commit)").alias("event_type"), F.col("commit_position").alias("last_position")
    )
    return union_sources(types, commit)


@query("""
    SELECT CAST(count(*) AS BIGINT) AS records, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest_event,
           CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS without_id FROM events""")
def observed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures taken while the events are written, without a pass of their own."""
    rows = events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("event_id"),
    )
    measures = Observation()
    rows.observe(measures, *batch_metrics()).write.parquet(workspace(spark, "observed"))
    seen = measures.get
    return spark.createDataFrame(
        [(seen["records"], seen["newest_event"], seen["without_id"])],
        "records bigint, newest_event timestamp, without_id bigint",
    ).withColumn("newest_event", text6(F.col("newest_event")))


@query("""
    SELECT event_id, 'org.events.' || upper(event_type) || 'Event' AS schema_name,
           upper(event_type) || 'Event' AS event_type FROM events""")
def schema_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events find the name of their schema by id; the type is its last part."""
    from auditlake.functions.payload import stream_event_type

    rows = events(spark, sf_dir)
    schemas = rows.select(F.sha2("event_type", 256).alias("schema_id"), "event_type").distinct().select(
        "schema_id", F.concat(F.lit("org.events."), F.upper("event_type"), F.lit("Event")).alias("schema_name")
    )
    named = attach_schema(rows.select("event_id", F.sha2("event_type", 256).alias("schema_id")), schemas)
    return named.select("event_id", "schema_name", stream_event_type(F.col("schema_name")).alias("event_type"))
