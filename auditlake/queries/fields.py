"""Column functions: identifiers, times, keys and payload rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions import times
from auditlake.functions.ids import (
    composite_id,
    csv_row_id,
    dedup_key,
    encode_position,
    json_string_field,
    query_fingerprint,
    row_version_id,
    stream_event_id,
)
from auditlake.functions.layout import partition_columns, partition_path, sanitize_key
from auditlake.functions.payload import (
    apply_field_mapping,
    csv_event_type,
    drop_metadata,
    lineage_file,
    lineage_query,
    normalize_payload,
    payload_map,
    query_event_type,
    stream_event_type,
)
from auditlake.operators.filters import has_row_limit, limits_named
from auditlake.plans.polls import limit_records
from auditlake.queries.registry import ARRIVAL, events, orders, query, table, text6
from auditlake.session import workspace
from auditlake.sources.api import read_limits

TS6 = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


@query("""
    SELECT event_id, substring(sha256(strftime(ts, '%Y%m%d') || '|' || event_id), 1, 32) AS row_id FROM events""")
def row_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return rows.select(
        "event_id", csv_row_id(F.date_format("ts", "yyyyMMdd"), F.col("event_id")).alias("row_id")
    )


@query("""
    SELECT o_orderkey, sha256(length(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey || '|'
        || length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey || '|') AS composite FROM orders""")
def composite_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        "o_orderkey", composite_id([F.col("o_custkey"), F.col("o_orderkey")]).alias("composite")
    )


@query("""
    WITH t AS (SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
                      o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ts, o_orderstatus AS s FROM orders)
    SELECT o_orderkey,
           CASE WHEN id = '' THEN '' ELSE id || '@' || ts END AS version_id,
           CASE WHEN id = '' THEN '' ELSE id || '@' || ts || '@' || CASE WHEN s = 'F' THEN ts ELSE '<nil>' END END AS ended_id,
           CASE WHEN id = '' THEN '' ELSE 'main_soql_0123456789abcdef_' || id || '_' || ts END AS dedup_key,
           CASE WHEN id = '' THEN '' ELSE 'main_soql_0123456789abcdef_' || id || '_' || ts || '|'
                || CASE WHEN s = 'F' THEN ts ELSE '<nil>' END END AS ended_key
    FROM t""")
def row_version_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    row_id = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderkey").cast("string"))
    ts = times.rfc3339_seconds(F.col("o_orderdate"))
    end = F.when(F.col("o_orderstatus") == "F", ts)
    name = [F.lit("main"), F.lit("0123456789abcdef"), row_id, ts]
    return rows.select(
        "o_orderkey",
        row_version_id(row_id, ts).alias("version_id"),
        row_version_id(row_id, ts, end).alias("ended_id"),
        dedup_key(*name).alias("dedup_key"),
        dedup_key(*name, end).alias("ended_key"),
    )


@query("""
    SELECT p_partkey, substring(sha256(array_to_string(list_transform([
            p_brand,
            array_to_string(list_transform(list_sort([lower(trim(p_type)), lower(p_brand), 'p' || p_size]),
                                           lambda v: strlen(v) || ':' || v || '|'), ''),
            'p_size > ' || p_size, 'ORDER BY Id', 'CreatedDate', '', 'rest'],
        lambda v: strlen(v) || ':' || v || '|'), '')), 1, 16) AS fingerprint FROM part""")
def query_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of query specifications made of part rows."""
    size = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        query_fingerprint(
            F.col("p_brand"),
            F.array(F.concat(F.lit(" "), "p_type"), F.upper("p_brand"), F.concat(F.lit("P"), size)),
            F.concat(F.lit("p_size > "), size), F.lit("ORDER BY Id"),
            F.lit("CreatedDate"), F.lit(""), F.lit("rest"),
        ).alias("fingerprint"),
    )


@query("""
    WITH t AS (SELECT o_orderkey, o_orderdate, o_orderpriority AS p, regexp_replace(o_orderpriority, '[^A-Za-z0-9_.-]', '_', 'g') AS c FROM orders)
    SELECT o_orderkey, 'source=soql/org_id=unknown/event_type='
        || CASE WHEN c <> p THEN c || '-' || substring(sha256(p), 1, 6) ELSE c END
        || strftime(o_orderdate, '/year=%Y/month=%m/day=%d/hour=%H') AS path FROM t""")
def sanitized_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = partition_columns(F.lit("soql"), F.lit("  "), F.col("o_orderpriority"), F.col("o_orderdate"))
    return orders(spark, sf_dir).select("o_orderkey", partition_path(keys).alias("path"))


@query("""
    WITH t AS (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS v FROM documents),
         c AS (SELECT doc_id, v, regexp_replace(v, '[^A-Za-z0-9_.-]', '_', 'g') AS c FROM t)
    SELECT doc_id, sha256(CASE WHEN c = '' THEN 'unknown' WHEN c <> v THEN c || '-' || substring(sha256(v), 1, 6) ELSE c END)
        AS key_hash FROM c""")
def sanitized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys made of whole texts in several languages."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(sanitize_key(F.col("text")), 256).alias("key_hash")
    )


@query(f"""
    SELECT event_id, {TS6} AS compact6, strftime(ts, '%Y-%m-%d %H:%M:%S.') || strftime(ts, '%f')[1:3] || '000' AS compact3,
           strftime(ts, '%Y-%m-%d %H:%M:%S.000000') AS compact0, {TS6} AS zulu, {TS6} AS offset_short,
           strftime(ts - INTERVAL 10 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS offset_long,
           CAST(NULL AS VARCHAR) AS not_a_date, CAST(NULL AS VARCHAR) AS wrong_layout, {TS6} AS row_time,
           {TS6} AS derived_time, epoch_us(ts) // 1000 AS millis,
           strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%f') AS stream_time
    FROM events""")
def timestamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time rendered in each accepted layout and parsed again."""
    ts = F.col("ts")
    compact = lambda fraction: F.date_format(ts, f"yyyyMMddHHmmss{fraction}")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zulu = F.concat(iso, F.lit("Z"))
    row = F.create_map(F.lit("TIMESTAMP"), compact(".SSSSSS"), F.lit("TIMESTAMP_DERIVED"), F.lit("2020-01-01T00:00:00Z"))
    derived = F.create_map(F.lit("TIMESTAMP"), F.col("props"), F.lit("TIMESTAMP_DERIVED"), zulu)
    parsed = {
        "compact6": times.parse_compact_timestamp(compact(".SSSSSS")),
        "compact3": times.parse_compact_timestamp(compact(".SSS")),
        "compact0": times.parse_compact_timestamp(compact("")),
        "zulu": times.parse_api_date(zulu),
        "offset_short": times.parse_api_date(F.concat(iso, F.lit("+0000"))),
        "offset_long": times.parse_api_date(F.concat(iso, F.lit("+10:00"))),
        "not_a_date": times.parse_api_date(F.col("props")),
        "wrong_layout": times.parse_compact_timestamp(zulu),
        "row_time": times.csv_event_time(row),
        "derived_time": times.csv_event_time(derived),
        "stream_time": times.stream_event_time(F.lit(None).cast("bigint"), F.unix_millis(ts)),
    }
    return events(spark, sf_dir).select(
        "event_id", *[text6(c).alias(n) for n, c in parsed.items()], times.watermark_millis(ts).alias("millis")
    )


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN '2024-03-01 11:30:45' ELSE strftime(o_orderdate - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') END AS since,
           '2024-03-01 12:30:45' AS until, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE epoch_ms(o_orderdate) END AS millis
    FROM orders""")
def poll_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window of the next poll for each stored watermark (none for some)."""
    stored = F.when(F.col("o_orderstatus") != "P", times.watermark_millis(F.col("o_orderdate")).cast("string"))
    mark = times.watermark_time(stored)
    now = F.lit("2024-03-01 12:30:45.678").cast("timestamp")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return orders(spark, sf_dir).select(
        "o_orderkey",
        F.date_format(F.date_trunc("second", times.since(mark, now)), fmt).alias("since"),
        F.date_format(times.until(now), fmt).alias("until"),
        times.watermark_millis(mark).alias("millis"),
    )


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE to_base64(encode(CAST(event_id AS VARCHAR))) END AS position
    FROM events""")
def position_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_id").cast("string"))
    return events(spark, sf_dir).select("event_id", encode_position(raw.cast("binary")).alias("position"))


@query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN 'uuid-' || event_id WHEN 'view' THEN 'ident-' || event_id
        WHEN 'signup' THEN 'ident-' || event_id ELSE '' END AS id FROM events""")
def stream_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-empty text identifier; numbers and missing fields do not count."""
    uuid, ident = (F.concat(F.lit(p), F.col("event_id").cast("string")) for p in ("uuid-", "ident-"))
    both = lambda a, b: F.concat(F.lit('{"EventUuid":'), a, F.lit(',"EventIdentifier":'), b, F.lit("}"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    kind = F.col("event_type")
    payload = (
        F.when(kind == "click", both(quoted(uuid), quoted(ident)))
        .when(kind == "view", both(F.lit('""'), quoted(ident)))
        .when(kind == "signup", F.concat(F.lit('{"EventIdentifier":'), quoted(ident), F.lit("}")))
        .when(kind == "error", F.concat(F.lit('{"EventUuid":'), F.col("event_id").cast("string"), F.lit("}")))
        .otherwise(F.lit("{}"))
    )
    found = stream_event_id(json_string_field(payload, "EventUuid"), json_string_field(payload, "EventIdentifier"))
    return events(spark, sf_dir).select("event_id", found.alias("id"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'Fallback' ELSE event_type END AS event_type,
           CASE event_type
             WHEN 'click' THEN 'EVENT_TYPE,REQUEST_ID,USER_ID'
             WHEN 'error' THEN 'EVENT_TYPE,PROPS,REQUEST_ID'
             ELSE 'EVENT_TYPE,PROPS,REQUEST_ID,USER_ID,VALUE_GROUP' END AS kept,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id
    FROM events""")
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column selection per event type; types match in any case, columns exactly."""
    mapping = {"Click": ["USER_ID", "props"], "ERROR": ["PROPS", "TIMESTAMP"], "purchase": []}
    row = F.create_map(
        F.lit("EVENT_TYPE"), F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")),
        F.lit("REQUEST_ID"), F.col("event_id").cast("string"),
        F.lit("USER_ID"), F.col("user_id").cast("string"),
        F.lit("PROPS"), F.col("props"),
        F.lit("VALUE_GROUP"), F.floor("value").cast("string"),
    )
    kept = apply_field_mapping(F.col("row"), F.col("event_type"), mapping)
    return events(spark, sf_dir).withColumn("row", row).select(
        "event_id",
        csv_event_type(F.col("row"), F.lit("Fallback")).alias("event_type"),
        F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("kept"),
        F.try_element_at(kept, F.lit("USER_ID")).alias("user_id"),
    )


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN '{"Id":"' || o_orderkey || '","Total":1.10}'
                ELSE '{"Id":"' || o_orderkey || '","Total":1.10,"Nested":{"attributes":1}}' END AS payload,
           CASE WHEN o_orderstatus = 'P' THEN 'Fallback' ELSE 'Order' || o_orderstatus END AS event_type
    FROM orders""")
def query_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API rows lose their top-level metadata member and nothing else."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    head = F.concat(F.lit('{"attributes":{"type":"Order'), status, F.lit('","url":"/o/{'), key, F.lit('}"},'))
    body = F.concat(F.lit('"Id":"'), key, F.lit('","Total":1.10'))
    row = F.when(status == "P", F.concat(F.lit("{"), body, F.lit("}"))).otherwise(
        F.concat(head, body, F.lit(',"Nested":{"attributes":1}}'))
    )
    return orders(spark, sf_dir).select(
        "o_orderkey", drop_metadata(row).alias("payload"),
        query_event_type(row, F.lit("Fallback")).alias("event_type"),
    )


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS short_type FROM events""")
def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload as map, and the short name of a dotted schema name."""
    return events(spark, sf_dir).select(
        "event_id", payload_map(F.col("props"))["k"].alias("k"),
        stream_event_type(F.concat(F.lit("org.model."), "event_type")).alias("short_type"),
    )


@query("""
    SELECT o_orderkey, '{"key":' || o_orderkey || ',"placed":' || epoch_ms(o_orderdate)
        || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","price":"'
        || CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(38,18)) AS VARCHAR)
        || '","nested":{"status":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END
        || ',"days":["' || strftime(o_orderdate, '%Y-%m-%d') || '",null]},"tags":{"string":"' || o_orderpriority
        || '"},"raw":"' || to_base64(encode(o_orderstatus)) || '","waited":' || o_custkey * 1000 || '}' AS payload
    FROM orders""")
def payload_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested typed event as JSON: schema-driven, every field kept."""
    event = F.struct(
        F.col("o_orderkey").alias("key"),
        F.col("o_orderdate").alias("placed"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.struct(
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
            F.array(F.to_date("o_orderdate"), F.lit(None).cast("date")).alias("days"),
        ).alias("nested"),
        F.create_map(F.lit("string"), F.col("o_orderpriority")).alias("tags"),
        F.col("o_orderstatus").cast("binary").alias("raw"),
        F.make_dt_interval(secs=F.col("o_custkey").cast("decimal(18,6)")).alias("waited"),
    )
    rows = orders(spark, sf_dir).select("o_orderkey", event.alias("event"))
    return rows.select("o_orderkey", normalize_payload(F.col("event"), rows.schema["event"].dataType).alias("payload"))


@query("""
    SELECT o_orderkey, 'createdDate,eventLogFileId,interval,logDate,sequence' AS file_keys,
           o_custkey || '/' || o_orderkey AS file_values, 'from,since,until' AS query_keys,
           o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS query_values
    FROM orders""")
def lineage_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("o_orderdate")
    by_file = lineage_file(
        F.col("o_orderkey").cast("string"), F.lit(None).cast("string"), times.rfc3339(ts),
        F.lit("Hourly"), F.col("o_custkey"),
    )
    by_query = lineage_query(F.col("o_orderpriority"), ts, ts)
    keys = lambda m: F.array_join(F.array_sort(F.map_keys(m)), ",")
    return orders(spark, sf_dir).select(
        "o_orderkey",
        keys(by_file).alias("file_keys"),
        F.concat_ws("/", by_file["sequence"], by_file["eventLogFileId"]).alias("file_values"),
        keys(by_query).alias("query_keys"),
        F.concat_ws("/", by_query["from"], by_query["until"]).alias("query_values"),
    )


@query("""
    SELECT c_name || '@2024-02-01T03:10:00Z' AS event_id, 'Limits' AS event_type, '2024-02-01 03:10:00.000000' AS ts,
           '{"limitName":"' || c_name || '","limitMax":' || c_custkey || ',"limitRemaining":' || c_nationkey || '}' AS payload
    FROM customer""")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed limit snapshots as archive records."""
    from datetime import datetime

    landing = workspace(spark, "limits")
    entry = F.struct(F.col("c_custkey").alias("Max"), F.col("c_nationkey").alias("Remaining"))
    table(spark, sf_dir, "customer").select(F.to_json(F.create_map("c_name", entry))).write.text(landing)
    now = datetime.fromisoformat(ARRIVAL.replace("Z", "+00:00"))
    records = limit_records(read_limits(spark, landing, per_line=True), now)
    return records.select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts"), F.col("payload_json").alias("payload")
    )


@query("""
    SELECT p_partkey, p_type AS name FROM part WHERE p_type IN ('SMALL', 'PROMO', 'NONE SUCH')""")
def limits_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with a listed name; names nobody has are passed over."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("name"))
    return limits_named(rows, ["SMALL", "PROMO", "NONE SUCH"])


@query("""
    SELECT p_partkey, p_type IN ('SMALL', 'ECONOMY') AS refused FROM part""")
def row_limit_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query tails with LIMIT or OFFSET, in any case and spacing, are refused."""
    tail = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.col("p_name"), F.lit("\tlimit\n"), F.col("p_size").cast("string")))
        .when(F.col("p_type") == "ECONOMY", F.concat(F.lit("ORDER BY x OFFSET "), F.col("p_size").cast("string")))
        .otherwise(F.concat(F.lit("ORDER BY Limit__c, "), F.col("p_name")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", has_row_limit(tail).alias("refused"))
