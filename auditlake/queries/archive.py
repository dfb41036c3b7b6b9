"""Writing an archive, reading it back, verifying and compacting it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.envelope import to_envelope
from auditlake.functions.layout import object_keys, partition_columns, partition_path
from auditlake.functions.payload import lineage_stream, payload_map
from auditlake.operators.aggregates import top_values
from auditlake.operators.filters import partition_filter
from auditlake.operators.joins import attach_lineage
from auditlake.operators.records import timeline
from auditlake.plans.compaction import compact_to_parquet, copy_timeline, member
from auditlake.plans.verify import verify_archive
from auditlake.queries.registry import (
    ARRIVAL,
    EVENT_PAYLOAD_SQL,
    event_payload,
    event_records,
    events,
    query,
    text6,
)
from auditlake.session import workspace
from auditlake.sinks.archive import archive_units, object_meta, write_archive
from auditlake.sources.archive import list_objects, read_archive, read_manifests
from auditlake.streaming.topics import (
    EARLIEST,
    LATEST,
    Topic,
    archive_stream,
    dedup_stream,
    read_event_stream,
)

TS6 = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
RFC3339 = "regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z'"


def stored_events(spark: SparkSession, sf_dir: str, name: str, by_noon: bool = False) -> str:
    """Root of a fresh archive that holds all test events; ``by_noon``: each arrived on the noon that
    follows it, else all in one hour."""
    root, records = workspace(spark, name), event_records(events(spark, sf_dir))
    if by_noon:
        noon = F.date_trunc("day", "timestamp") + F.make_dt_interval(hours=F.lit(12))
        next_noon = noon + F.make_dt_interval(days=F.lit(1))
        records = records.withColumn("partition_time", F.when(F.col("timestamp") < noon, noon).otherwise(next_noon))
    write_archive(records, root)
    return root


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           '{{"event_id":"' || event_id || '","event_type":"' || event_type || '","timestamp":"' || {RFC3339}
           || '","source":"stream","env":"prod","org_id":"00D000000000001","instance":"main","replay_id":"'
           || to_base64(encode(CAST(event_id AS VARCHAR))) || '","payload":' || {EVENT_PAYLOAD_SQL} || '}}' AS line,
           'raw/source=stream/org_id=00D000000000001/event_type=' || event_type
           || strftime(ts, '/year=%Y/month=%m/day=%d/hour=%H/') || event_id || '.json.gz' AS data_key,
           'manifests/source=stream/org_id=00D000000000001/event_type=' || event_type
           || strftime(ts, '/year=%Y/month=%m/day=%d/hour=%H/') || event_id || '.manifest.json' AS manifest_key
    FROM events""")
def envelope_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(events(spark, sf_dir))
    keys = partition_columns(*[F.col(c) for c in ("source", "org_id", "event_type", "timestamp")])
    data_key, manifest_key = object_keys(partition_path(keys), F.col("event_id"))
    return records.select(
        "event_id", to_envelope().alias("line"),
        data_key.alias("data_key"), manifest_key.alias("manifest_key"),
    )


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, {TS6} AS ts, 'stream' AS source,
           'prod' AS env, '00D000000000001' AS org_id, 'main' AS instance,
           to_base64(encode(CAST(event_id AS VARCHAR))) AS replay_id, {EVENT_PAYLOAD_SQL} AS payload,
           event_type AS part_event_type, '2024' AS part_year, '03' AS part_hour
    FROM events""")
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = stored_events(spark, sf_dir, "roundtrip")
    return read_archive(spark, root).select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts"), "source", "env", "org_id",
        "instance", "replay_id", "payload", "part_event_type", "part_year", "part_hour",
    )


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, count(*) AS copies FROM events GROUP BY ALL""")
def rewritten_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storing the same units again, all at once and then one type alone, leaves
    every record once."""
    root = workspace(spark, "rewrite")
    records = event_records(events(spark, sf_dir))
    write_archive(records, root)
    write_archive(records.where(F.col("event_type") == "error"), root)
    return read_archive(spark, root).groupBy("event_id", "event_type").agg(
        F.count(F.lit(1)).alias("copies")
    )


@query("""
    SELECT event_type AS "eventType", CAST(count(*) AS BIGINT) AS records,
           strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts,
           TRUE AS within_limit, TRUE AS sizes_agree, '/event/Test' AS topic
    FROM events GROUP BY event_type""")
def archive_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of a finished write, no object above the record limit."""
    root = workspace(spark, "manifests")
    records = event_records(events(spark, sf_dir))
    lineage = lineage_stream(F.lit("/event/Test"), F.lit(""), F.lit(""))
    archive_units(records, root, meta=object_meta(records, lineage), records_per_object=5000)
    manifests = read_manifests(spark, root).select("manifest.*")
    sizes = list_objects(spark, root).select(F.col("object_key").alias("objectKey"), "compressed")
    ts = lambda c: F.col(c).cast("timestamp")
    return manifests.join(sizes, "objectKey").groupBy("eventType").agg(
        F.sum("recordCount").alias("records"),
        text6(F.min(ts("firstTimestamp"))).alias("first_ts"),
        text6(F.max(ts("lastTimestamp"))).alias("last_ts"),
        (F.max("recordCount") <= 5000).alias("within_limit"),
        F.bool_and(F.col("compressed") == F.col("compressedBytes")).alias("sizes_agree"),
        F.max(F.col("lineage")["topic"]).alias("topic"),
    )


@query("""
    SELECT CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS manifest_mismatch,
           CAST(0 AS BIGINT) AS manifest_without_object, CAST(0 AS BIGINT) AS unreadable_object,
           CAST(0 AS BIGINT) AS object_without_manifest,
           CAST(0 AS BIGINT) AS missing, TRUE AS ok, TRUE AS all_described
    FROM events""")
def verify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole verification run against the list of all event ids."""
    root = workspace(spark, "verified")
    test_events = events(spark, sf_dir)
    records = event_records(test_events)
    lineage = lineage_stream(F.lit("/event/Test"), F.lit(""), F.lit(""))
    archive_units(records, root, meta=object_meta(records, lineage))
    expected = test_events.select(
        F.lit("stream").alias("source"), F.lit("/event/Test").alias("grp"),
        F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("id"),
    )
    report = verify_archive(spark, root, expected).report()
    return report.select(
        "records", "manifest_mismatch", "manifest_without_object", "unreadable_object",
        "object_without_manifest", "missing", "ok",
        (F.col("objects") == F.col("manifests")).alias("all_described"),
    )


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
           CASE WHEN event_type = 'error' THEN '' ELSE '/event/' || event_type END AS topic
    FROM events""")
def lineage_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived lines with the topic of their object; the objects of one type were
    left without manifests."""
    root = workspace(spark, "lineage")
    records = event_records(events(spark, sf_dir))
    write_archive(records.where(F.col("event_type") == "error"), root)
    described = records.where(F.col("event_type") != "error")
    topic = F.concat(F.lit("/event/"), "object_type")
    meta = object_meta(described, lineage_stream(topic, F.lit(""), F.lit("")))
    archive_units(described, root, meta=meta)
    manifests = read_manifests(spark, root).select("manifest.*")
    return attach_lineage(read_archive(spark, root), manifests).select("event_id", "event_type", "topic")


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS event_date, event_type, CAST(count(*) AS BIGINT) AS records,
           CAST(count(DISTINCT event_id) AS BIGINT) AS ids
    FROM events GROUP BY ALL""")
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet copy by event date of an archive that holds some records twice."""
    root, out = workspace(spark, "compact"), workspace(spark, "curated")
    records = event_records(events(spark, sf_dir))
    write_archive(records, root)
    repeated = records.where(F.col("event_type") == "purchase").withColumn("object_name", F.lit("batch-2"))
    write_archive(repeated, root)
    compact_to_parquet(spark, root, out)
    return (
        spark.read.parquet(out)
        .groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "event_type")
        .agg(F.count(F.lit(1)).alias("records"), F.count_distinct("event_id").alias("ids"))
    )


@query("""
    SELECT CAST(user_id AS VARCHAR) AS "USER_ID", CAST(count(*) AS BIGINT) AS n
    FROM events
    WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'
    GROUP BY user_id""")
def top_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures by user on one day: archive, read back, prune, filter, count."""
    rows = read_archive(spark, stored_events(spark, sf_dir, "failures", by_noon=True))
    day = partition_filter(rows, datetime(2024, 1, 15), datetime(2024, 1, 16))
    fields = payload_map(F.col("payload"))
    return top_values(day, fields["USER_ID"], "USER_ID", fields["LOGIN_STATUS"] == "error")


@query(f"""
    SELECT {TS6} AS ts, event_type, CAST(event_id AS VARCHAR) AS event_id, props
    FROM events
    WHERE user_id = 8 AND ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-03'""")
def user_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_archive(spark, stored_events(spark, sf_dir, "timeline", by_noon=True))
    fields = payload_map(F.col("payload"))
    return timeline(rows, datetime(2024, 1, 2), "8", fields["USER_ID"]).select(
        text6(F.col("timestamp")).alias("ts"), "event_type", "event_id",
        F.regexp_replace(fields["props"], ":", ": ").alias("props"),
    )


@query(f"""
    SELECT {TS6} AS ts, event_type, CAST(event_id AS VARCHAR) AS event_id, props
    FROM events
    WHERE user_id = 8 AND ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-03'""")
def user_timeline_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user's day from the Parquet copy."""
    out = workspace(spark, "timeline-copy")
    compact_to_parquet(spark, stored_events(spark, sf_dir, "timeline-archive"), out)
    return copy_timeline(spark, out, datetime(2024, 1, 2), "8").select(
        text6(F.col("timestamp")).alias("ts"), "event_type", "event_id",
        F.regexp_replace(F.get_json_object("payload", "$.props"), ":", ": ").alias("props"),
    )


@query("""
    SELECT event_type, CAST(count(*) AS BIGINT) AS records, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS k,
           CAST(count(props->>'$.none') AS BIGINT) AS without, max(CAST(user_id AS VARCHAR)) AS user
    FROM events GROUP BY event_type""")
def payload_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of nested payloads, from the copy that holds them taken apart."""
    out = workspace(spark, "members-copy")
    compact_to_parquet(spark, stored_events(spark, sf_dir, "members-archive"), out)
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(member("$.props.k", "bigint")).alias("k"),
        F.count(member("$.props.none", "string")).alias("without"),
        F.max(member("$.USER_ID", "string")).alias("user"),
    )


# --- streams ---------------------------------------------------------------------------


def landed_topic(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, T.StructType]:
    """Test events landed as files of a topic."""
    landing = workspace(spark, name)
    landed = events(spark, sf_dir).select(
        F.col("event_id").cast("string").cast("binary").alias("replay_id"),
        F.concat(F.lit("org.events."), "event_type").alias("schema_name"),
        F.struct(
            F.col("event_id").cast("string").alias("EventUuid"),
            F.unix_millis("ts").alias("EventDate"),
            F.col("user_id").cast("string").alias("UserId"),
            F.col("props").alias("Props"),
        ).alias("payload"),
    )
    landed.write.parquet(landing)
    return landing, landed.schema


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
           strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%f') AS ts,
           to_base64(encode(CAST(event_id AS VARCHAR))) AS replay_id,
           '{"EventUuid":"' || event_id || '","EventDate":' || (epoch_us(ts) // 1000)
           || ',"UserId":"' || user_id || '","Props":"' || replace(props, '"', '\\"') || '"}' AS payload
    FROM events""")
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed topic archived by a streaming query, then read back."""
    landing, schema = landed_topic(spark, sf_dir, "landing")
    root, checkpoint = workspace(spark, "topic"), workspace(spark, "topic-checkpoint")
    stream = read_event_stream(spark, landing, schema, fmt="parquet")
    topic = Topic("/event/Test", "main", "00D000000000001", "prod")
    archive_stream(stream, topic, root, checkpoint, initial=EARLIEST, once=True).awaitTermination()
    return read_archive(spark, root).select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts"), "replay_id", "payload"
    )


STREAMED = "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, instance FROM events, (SELECT {} AS instance) {}"


def _run_topic(spark: SparkSession, landing: str, schema: T.StructType, root: str, checkpoint: str, start: str, name="main"):
    stream = read_event_stream(spark, landing, schema, start, "parquet", checkpoint=checkpoint)
    topic = Topic("/event/Test", name, "00D000000000001", "prod")
    archive_stream(stream, topic, root, checkpoint, initial=start, once=True).awaitTermination()


def _streamed(spark: SparkSession, root: str) -> DataFrame:
    return read_archive(spark, root).select("event_id", "event_type", "instance")


def _thirds(spark: SparkSession, sf_dir: str, name: str) -> tuple[list[DataFrame], str]:
    """Landed test events in three parts, and an empty landing folder."""
    source, schema = landed_topic(spark, sf_dir, f"{name}-events")
    rows = spark.read.schema(schema).parquet(source)
    third = F.col("payload.EventUuid").cast("bigint") % 3
    return [rows.where(third == i) for i in range(3)], workspace(spark, name)


@query(STREAMED.format("'main'", "WHERE event_id % 3 <> 0"))
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic started with LATEST, stopped, and started again with the same settings twice,
    with events landing while it was down."""
    parts, landing = _thirds(spark, sf_dir, "restart-landing")
    root, checkpoint = workspace(spark, "restart"), workspace(spark, "restart-checkpoint")
    for part in parts:
        part.write.mode("append").parquet(landing)
        _run_topic(spark, landing, part.schema, root, checkpoint, LATEST)
    return _streamed(spark, root)


@query(STREAMED.format("'main'", ""))
def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic taken up with a new checkpoint each time replaces no earlier batch."""
    parts, _ = _thirds(spark, sf_dir, "unused")
    root = workspace(spark, "checkpoints")
    for part in parts:
        landing = workspace(spark, "checkpoint-landing")
        part.write.parquet(landing)
        _run_topic(spark, landing, part.schema, root, workspace(spark, "new-checkpoint"), EARLIEST)
    return _streamed(spark, root)


@query(STREAMED.format("unnest(['one', 'two'])", ""))
def stream_two_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two instances archive one topic side by side; each has all its events."""
    landing, schema = landed_topic(spark, sf_dir, "instances-landing")
    root = workspace(spark, "instances")
    for name in ("one", "two"):
        _run_topic(spark, landing, schema, root, workspace(spark, f"instance-{name}"), EARLIEST, name)
    return _streamed(spark, root)


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, {TS6} AS ts FROM events""")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed with repeats, each passed on once by a streaming query."""
    landing, out = workspace(spark, "repeats"), workspace(spark, "once")
    rows = event_records(events(spark, sf_dir)).select("event_id", "event_type", "timestamp")
    # Parts that land one after the other, each file a batch; the second has repeats of both others.
    again = rows.where(F.col("event_type").isin("purchase", "error"))
    for part in (rows.where("event_id % 2 = 0"), again, rows.where("event_id % 2 = 1")):
        part.write.mode("append").parquet(landing)
    (
        dedup_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing))
        .writeStream.format("parquet")
        .option("checkpointLocation", workspace(spark, "once-checkpoint"))
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.schema(rows.schema).parquet(out).select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts")
    )


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, {EVENT_PAYLOAD_SQL} AS payload FROM events""")
def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload cut out of envelope lines without parsing it."""
    from auditlake.functions.envelope import header_of, payload_of

    lines = event_records(events(spark, sf_dir)).select(to_envelope().alias("line"))
    return lines.select(
        header_of(F.col("line"))["event_id"].alias("event_id"), payload_of(F.col("line")).alias("payload")
    )
