"""Landed files: CSV log files, malformed and lost files, listings and result pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.ids import csv_row_id
from auditlake.functions.payload import payload_map
from auditlake.functions.times import rfc3339, rfc3339_seconds
from auditlake.operators.aggregates import attempt_counts as count_attempts
from auditlake.operators.filters import (
    event_types_in,
    hourly_only,
    incomplete_downloads as partial_downloads,
    permanent_failures,
)
from auditlake.operators.joins import attach_catalog
from auditlake.operators.records import order_catalog
from auditlake.plans.polls import (
    Collector,
    LogFileSpec,
    QuerySpec,
    file_outcomes as outcomes_of,
    poll_all,
    poll_limits as run_limits,
    poll_log_files as run_log_files,
    poll_query as run_query,
    tombstone_records,
)
from auditlake.queries.registry import events, orders, query, table, text6
from auditlake.session import stage, workspace
from auditlake.sources.api import (
    incomplete_result_sets as incomplete_of,
    read_log_catalog,
    read_pages,
    read_query_pages,
)
from auditlake.sources.archive import read_archive
from auditlake.sources.logfiles import (
    csv_lines,
    csv_rows as rows_of,
    file_status,
    malformed_files as malformed_of,
    read_log_files,
    read_raw_lines,
)
from auditlake.state import State

ID_HASH = "substring(sha256({}), 1, 32)"


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations")
def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations through CSV files whose quoted texts hold commas and line breaks."""
    landing = workspace(spark, "csv")
    table(spark, sf_dir, "conversations").write.option("header", "true").option("escape", '"').csv(landing)
    rows = read_log_files(spark, landing)
    return rows.select(*[F.col("row")[c].alias(c) for c in ("conv_id", "turn", "role", "text")])


def _day_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Test events as daily CSV log files in their order of arrival."""
    landing = workspace(spark, name)
    rows = events(spark, sf_dir).select(
        F.date_format("ts", "yyyyMMdd").alias("file_id"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.date_format("ts", "yyyyMMddHHmmss.SSSSSS").alias("TIMESTAMP"),
        F.col("event_id").cast("string").alias("REQUEST_ID"),
        F.col("user_id").cast("string").alias("USER_ID"),
        F.lit("").alias("EMPTY"),
        F.concat(F.lit('say "'), F.col("props"), F.lit('", twice\nend')).alias("NOTE"),
        "event_id",
    )
    (
        rows.repartition("file_id")
        .sortWithinPartitions("file_id", "event_id")
        .drop("event_id")
        .write.partitionBy("file_id")
        .option("header", "true").option("escape", '"').option("emptyValue", "")
        .csv(landing)
    )
    return landing


@query(f"""
    WITH t AS (SELECT *, strftime(ts, '%Y%m%d') AS file_id,
                      row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY event_id) + 1 AS line FROM events)
    SELECT file_id, CAST(line AS BIGINT) AS line, {ID_HASH.format("file_id || '|' || line")} AS row_id,
           CAST(event_id AS VARCHAR) AS request_id, 'say "' || props || '", twice' || chr(10) || 'end' AS note,
           '' AS empty
    FROM t""")
def csv_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers and ids of rows that span lines, one file per day."""
    rows = read_log_files(spark, _day_files(spark, sf_dir, "daily"))
    return rows.select(
        "file_id", "line", csv_row_id(F.col("file_id"), F.col("line")).alias("row_id"),
        F.col("row")["REQUEST_ID"].alias("request_id"), F.col("row")["NOTE"].alias("note"),
        F.col("row")["EMPTY"].alias("empty"),
    )


@query("""
    SELECT o_orderpriority AS priority, o_orderstatus AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'wrong number of fields'
                                WHEN '2-HIGH' THEN 'bare or unterminated quote' END AS reason
    FROM orders GROUP BY ALL""")
def malformed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV files per priority and status. Urgent ones start with a short
    row, high ones hold a stray quote: each bad row condemns its whole file."""
    landing = workspace(spark, "ragged")
    number = F.col("o_orderkey").cast("string")
    # The first line of a file is its header and sets the number of fields.
    header = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus").distinct()
    lines = (
        header.select("*", F.lit("number,text").alias("line"), F.lit(-1).alias("place"))
        .unionByName(
            orders(spark, sf_dir).select(
                "o_orderpriority", "o_orderstatus",
                F.when(F.col("o_orderpriority") == "1-URGENT", number)
                .when(F.col("o_orderpriority") == "2-HIGH", F.concat(number, F.lit(',12" pipe')))
                .otherwise(F.concat(number, F.lit(',"a ""quoted"", text"'))).alias("line"),
                F.col("o_orderkey").alias("place"),
            )
        )
    )
    (
        lines.repartition("o_orderpriority", "o_orderstatus")
        .sortWithinPartitions("o_orderpriority", "o_orderstatus", "place")
        .drop("place")
        .write.partitionBy("o_orderpriority", "o_orderstatus").text(landing)
    )
    status = stage(file_status(stage(csv_lines(spark, landing), "lines")), "status")
    bad = malformed_of(status).select("path", F.split("reason", ": ")[1].alias("reason"))
    part = lambda k: F.url_decode(F.regexp_extract("path", rf"/{k}=([^/]*)/", 1))
    return status.select("path").join(bad, "path", "left").select(
        part("o_orderpriority").alias("priority"), part("o_orderstatus").alias("status"), "reason"
    )


@query("""
    WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT sha256(line || chr(10)) AS line_hash, CAST(count(*) AS BIGINT) AS n FROM l GROUP BY 1""")
def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every physical line of files that hold whole documents, line ends included."""
    landing = workspace(spark, "documents")
    table(spark, sf_dir, "documents").select("text").write.text(landing)
    lines = read_raw_lines(csv_lines(spark, landing))
    return lines.groupBy(F.sha2("raw_line", 256).alias("line_hash")).agg(F.count(F.lit(1)).alias("n"))


# --- outcomes of files ---------------------------------------------------------------------


def _listed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listed log files."""
    return orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("Id"), F.col("o_orderstatus").alias("EventType"),
        F.col("o_orderdate").alias("created"), F.lit("not-a-date").alias("LogDate"),
        F.lit(100.0).alias("LogFileLength"), "o_custkey",
    )


def _failure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier failures per file: one per line item of the order."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("key")).agg(
        F.count(F.lit(1)).cast("int").alias("n")
    )


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(coalesce(n, 0) + 1 AS INTEGER) AS attempts FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def attempt_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = orders(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("key"))
    return count_attempts(files, _failure_log(spark, sf_dir)).select("key", "attempts")


OUTCOME_SQL = """
    WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
    f AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p, o_orderdate AS created, coalesce(n, 0) + 1 AS attempts
          FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilled orders are gone for good, pending ones refused for now, open ones
    landed - the urgent ones malformed, the high ones too short."""
    pending = _listed_orders(spark, sf_dir)
    by_key = orders(spark, sf_dir).withColumn("file_id", F.col("o_orderkey").cast("string"))
    is_open = F.col("o_orderstatus") == "O"
    landed = by_key.where(is_open).select(
        "file_id", F.when(F.col("o_orderpriority") == "2-HIGH", F.lit(99)).otherwise(F.lit(100)).alias("length")
    )
    fetches = by_key.where(~is_open).select(
        "file_id", F.when(F.col("o_orderstatus") == "F", F.lit(404)).otherwise(F.lit(503)).alias("status"),
        F.lit("gone").alias("body"),
    )
    bad = by_key.where(is_open & (F.col("o_orderpriority") == "1-URGENT")).select(
        "file_id", F.lit("broken in line 2: wrong number of fields").alias("reason")
    )
    failures = _failure_log(spark, sf_dir)
    return outcomes_of(pending, landed, fetches, bad, failures, failures, LogFileSpec())


@query(f"""{OUTCOME_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
           CASE WHEN s = 'F' AND attempts >= 5 THEN 'tombstone' WHEN s <> 'O' OR p = '2-HIGH' THEN 'fail'
                WHEN p = '1-URGENT' AND attempts >= 3 THEN 'quarantine' WHEN p = '1-URGENT' THEN 'fail' ELSE 'archive' END AS action,
           CASE WHEN s = 'F' THEN 'HTTP 404: gone' WHEN s = 'P' THEN 'HTTP 503: gone'
                WHEN p = '2-HIGH' THEN 'has 99 bytes where its listing says 100'
                WHEN p = '1-URGENT' THEN 'broken in line 2: wrong number of fields' END AS reason,
           CAST(attempts AS INTEGER) AS attempts,
           CASE WHEN s = 'F' THEN 'unavailable' WHEN s = 'O' AND p = '1-URGENT' THEN 'malformed' END AS counter
    FROM f""")
def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).select("file_id", "action", "reason", "attempts", "counter")


@query(f"""{OUTCOME_SQL}
    SELECT {ID_HASH.format("o_orderkey || '|0'")} AS event_id, s AS event_type,
           strftime(created, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           '{{"unavailable":true,"eventLogFileId":"' || o_orderkey || '","unavailableReason":"HTTP 404: gone","attempts":'
           || attempts || '}}' AS payload, 'elf-' || o_orderkey || '-unavailable' AS object_name
    FROM f WHERE s = 'F' AND attempts >= 5""")
def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records left for files the source will never serve."""
    gone = _outcomes(spark, sf_dir).where(F.col("action") == "tombstone").withColumn("partition_time", F.col("created"))
    return tombstone_records(gone).select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts"),
        F.col("payload_json").alias("payload"), "object_name",
    )


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def permanent_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only 400, 404 and 410 are for good."""
    status = F.when(F.col("o_orderstatus") == "F", F.lit(404)).when(F.col("o_orderstatus") == "P", F.lit(410)).otherwise(
        F.lit(403)
    )
    rows = orders(spark, sf_dir).withColumn("status", status)
    return permanent_failures(rows).select("o_orderkey", "o_orderstatus")


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS file_id, strlen(text) AS length, CAST(n_chars AS DOUBLE) AS "LogFileLength"
    FROM documents WHERE n_chars > 0 AND strlen(text) <> n_chars""")
def incomplete_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose size in bytes is not the declared one."""
    docs = table(spark, sf_dir, "documents")
    file_id = F.col("doc_id").cast("string")
    catalog = docs.select(file_id.alias("Id"), F.col("n_chars").cast("double").alias("LogFileLength"))
    files = docs.select(file_id.alias("file_id"), F.octet_length("text").cast("bigint").alias("length"))
    return partial_downloads(catalog, files).select("file_id", "length", "LogFileLength")


# --- listings and pages ----------------------------------------------------------------------

PAGE_ROWS = 2000


def _write_pages(rows: DataFrame, landing: str, per_folder: str, number: str) -> None:
    """Rows (`row` struct or text) as pages of bounded size, one page per line."""
    page = F.floor(F.col(number) / PAGE_ROWS)
    totals = rows.groupBy(per_folder).agg(F.count(F.lit(1)).alias("total"), F.max(page).alias("last_page"))
    pages = (
        rows.groupBy(per_folder, page.alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("row"), ","), F.lit("]")).alias("records"))
        .join(totals, per_folder)
    )
    line = F.concat(
        F.lit('{"totalSize":'), F.col("total").cast("string"),
        F.lit(',"done":'), (F.col("page") == F.col("last_page")).cast("string"),
        F.lit(',"records":'), F.col("records"), F.lit("}"),
    )
    pages.select(per_folder, line.alias("value")).write.partitionBy(per_folder).text(landing)


@query("""
    SELECT p_partkey, '{"attributes":{"type":"Part"},"Id":"' || p_partkey || '","Price":' || (p_size / 10)::DECIMAL(10,2)
        || ',"Big":9007199254740993' || p_size || '}' AS row_json, 'p_type=' || p_type AS query FROM part""")
def query_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows out of landed result pages, number literals untouched."""
    landing = _part_pages(spark, sf_dir)
    rows = read_query_pages(spark, landing, per_line=True)
    key = payload_map(F.col("row_json"))["Id"].cast("bigint")
    return rows.select(key.alias("p_partkey"), "row_json", "query")


def _part_pages(spark: SparkSession, sf_dir: str) -> str:
    landing = workspace(spark, "pages")
    row = F.concat(
        F.lit('{"attributes":{"type":"Part"},"Id":"'), F.col("p_partkey").cast("string"),
        F.lit('","Price":'), (F.col("p_size") / 10).cast("decimal(10,2)").cast("string"),
        F.lit(',"Big":9007199254740993'), F.col("p_size").cast("string"), F.lit("}"),
    )
    _write_pages(table(spark, sf_dir, "part").select("p_type", "p_partkey", row.alias("row")), landing, "p_type", "p_partkey")
    return landing


@query("""
    SELECT 'p_type=' || p_type AS query, CAST(count(*) FILTER (p_type <> 'SMALL' OR p_size < 25) AS BIGINT) AS rows,
           CAST(count(*) AS BIGINT) AS total_size
    FROM part WHERE p_type = 'SMALL' GROUP BY p_type""")
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result sets that lost rows: large small-type parts never arrived."""
    pages = read_pages(spark, _part_pages(spark, sf_dir), per_line=True)
    size = lambda r: F.regexp_extract(r, r'9007199254740993(\d+)\}', 1).cast("int")
    cut = F.filter("records", lambda r: size(r) < 25)
    arrived = pages.withColumn(
        "records", F.when(F.col("query") == "p_type=SMALL", cut).otherwise(F.col("records"))
    )
    return incomplete_of(arrived).select("query", "rows", "total_size")


def _catalog_pages(spark: SparkSession, sf_dir: str) -> str:
    landing = workspace(spark, "listing")
    created = rfc3339_seconds(F.col("o_orderdate"))
    row = F.to_json(
        F.struct(
            F.struct(F.lit("EventLogFile").alias("type")).alias("attributes"),
            F.col("o_orderkey").cast("string").alias("Id"),
            F.regexp_replace("o_orderpriority", "[^A-Za-z0-9]", "_").alias("EventType"),
            F.regexp_replace(created, "Z$", ".000+0000").alias("CreatedDate"),
            F.lit("not-a-date").alias("LogDate"),
            F.when(F.col("o_orderstatus") == "P", F.lit("Daily")).otherwise(F.lit("Hourly")).alias("Interval"),
            F.col("o_custkey").alias("Sequence"),
            F.col("o_custkey").cast("double").alias("LogFileLength"),
        )
    )
    rows = orders(spark, sf_dir).select("o_orderstatus", "o_orderkey", row.alias("row"))
    _write_pages(rows, landing, "o_orderstatus", "o_orderkey")
    return landing


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS "Id", regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '_', 'g') AS "EventType",
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000+0000') AS "CreatedDate", CAST(o_custkey AS INTEGER) AS "Sequence",
           CAST(o_custkey AS DOUBLE) AS "LogFileLength"
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def log_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly files of two event types out of a paged listing, in listing order."""
    listed = read_log_catalog(spark, _catalog_pages(spark, sf_dir), per_line=True)
    chosen = event_types_in(hourly_only(listed), ["1_URGENT", "5_LOW"])
    return order_catalog(chosen).select("Id", "EventType", "CreatedDate", "Sequence", "LogFileLength")


@query("""
    SELECT l_orderkey || '' AS file_id, l_linenumber AS line, o_orderpriority AS "EventType", o_custkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File rows gain the listing columns of their file."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_id"), F.col("l_linenumber").alias("line")
    )
    listing = orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("Id"), F.col("o_orderpriority").alias("EventType"), "o_custkey"
    )
    return attach_catalog(rows, listing).select("file_id", "line", "EventType", "o_custkey")


# --- whole polls --------------------------------------------------------------------------------

NOW = datetime(2024, 3, 1, 0, 0, 0, 500_000)


def _collector(spark: SparkSession, name: str, **options) -> Collector:
    root = workspace(spark, name)
    return Collector("main", "00D000000000001", root, State(spark, f"{root}/state"), "prod", **options)


@query("""
    WITH t AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1)
    SELECT status, CAST(n + 1 AS BIGINT) AS lines, TRUE AS ids_agree, '-quarantine' AS suffix FROM t""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders in which each has a stray quote, set aside line by line by the first poll that may give up."""
    from datetime import timedelta

    files, listing = workspace(spark, "stray"), workspace(spark, "stray-listing")
    number = F.col("o_orderkey").cast("string")
    rows = orders(spark, sf_dir).select(
        F.col("o_orderstatus").alias("file_id"), F.concat(number, F.lit(',12" pipe')).alias("line"), F.col("o_orderkey").alias("place")
    )
    # One header and so one file for each status: a key holds a third of all rows, as a file does.
    heads = rows.select("file_id").distinct().select("file_id", F.lit("number,text").alias("line"), F.lit(-1).alias("place"))
    (
        heads.unionByName(rows).repartition("file_id").sortWithinPartitions("file_id", "place").drop("place")
        .write.partitionBy("file_id").text(files)
    )
    start = "2024-01-01T00:00:00.000+0000"
    row = F.to_json(
        F.struct(F.col("file_id").alias("Id"), F.lit("Login").alias("EventType"), F.lit(start).alias("CreatedDate"),
                 F.lit(start).alias("LogDate"), F.lit("Hourly").alias("Interval"), F.lit(1).alias("Sequence"),
                 F.lit(0.0).alias("LogFileLength"))
    )
    _write_pages(heads.select(F.lit("files").alias("q"), F.ascii("file_id").alias("n"), row.alias("row")), listing, "q", "n")
    collector = _collector(spark, "stray-archive", initial=timedelta(days=90))
    run_log_files(spark, collector, listing, files, NOW, LogFileSpec(malformed_attempts=1), per_line=True)
    stored = read_archive(spark, collector.root)
    fields = payload_map(F.col("payload"))
    own = csv_row_id(F.regexp_extract("part_unit", "^elf-(.*)-quarantine$", 1), fields["lineNumber"].cast("bigint"))
    return stored.groupBy(F.regexp_extract("part_unit", "^elf-(.*?)(-.*)?$", 1).alias("status")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.bool_and((F.col("event_id") == own) & (fields["quarantined"] == "true")).alias("ids_agree"),
        F.max(F.regexp_extract("part_unit", "^elf-.*?(-.*)$", 1)).alias("suffix"),
    )


@query("""
    WITH t AS (SELECT *, strftime(ts, '%Y%m%d') AS file_id,
                      row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY event_id) + 1 AS line FROM events)
    SELECT substring(sha256(file_id || '|' || line), 1, 32) AS event_id, event_type,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(event_id AS VARCHAR) AS request_id,
           'Login' AS part_event_type, strftime(ts, '%d') AS part_day, 'elf-' || file_id AS part_unit,
           '2024-01-30' AS watermark_day
    FROM t""")
def poll_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily log files listed, parsed and archived by two polls: the second finds
    nothing new and adds nothing."""
    from datetime import timedelta

    files = _day_files(spark, sf_dir, "poll-files")
    listing = workspace(spark, "poll-listing")
    day = F.date_format("ts", "yyyyMMdd")
    start = F.concat(F.date_format("ts", "yyyy-MM-dd'T'00:00:00.000"), F.lit("+0000"))
    row = F.to_json(
        F.struct(day.alias("Id"), F.lit("Login").alias("EventType"), start.alias("CreatedDate"),
                 start.alias("LogDate"), F.lit("Hourly").alias("Interval"), F.lit(1).alias("Sequence"),
                 F.lit(0.0).alias("LogFileLength"))
    )
    days = events(spark, sf_dir).select(F.lit("files").alias("q"), F.dayofyear("ts").alias("n"), row.alias("row")).distinct()
    _write_pages(days, listing, "q", "n")
    collector = _collector(spark, "poll", initial=timedelta(days=90))
    for _ in range(2):
        run_log_files(spark, collector, listing, files, NOW, per_line=True)
    mark = collector.state.watermarks().select(F.timestamp_millis(F.col("value").cast("bigint")))
    return read_archive(spark, collector.root).select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts"),
        payload_map(F.col("payload"))["REQUEST_ID"].alias("request_id"),
        "part_event_type", "part_day", "part_unit",
        F.date_format(mark.scalar(), "yyyy-MM-dd").alias("watermark_day"),
    )


@query("""
    SELECT o_orderkey || '@' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_id, 'Order' AS event_type,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           '{"Id":"' || o_orderkey || '","CreatedDate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
           || '","Total":1.10,"Status":"' || o_orderstatus || '"}' AS payload
    FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01'""")
def poll_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping polls over result pages; rows seen twice are archived once."""
    from datetime import timedelta

    landing = workspace(spark, "order-pages")
    created = rfc3339_seconds(F.col("o_orderdate"))
    row = F.concat(
        F.lit('{"attributes":{"type":"Order","url":"/o"},"Id":"'), F.col("o_orderkey").cast("string"),
        F.lit('","CreatedDate":"'), created, F.lit('","Total":1.10,"Status":"'), F.col("o_orderstatus"), F.lit('"}'),
    )
    _write_pages(
        orders(spark, sf_dir).select(F.lit("orders").alias("q"), "o_orderkey", row.alias("row")), landing, "q", "o_orderkey"
    )
    spec = QuerySpec("Order", ["Id", "CreatedDate", "Total", "Status"], "CreatedDate")
    collector = _collector(
        spark, "poll-query", initial=datetime(2001, 7, 28) - datetime(1995, 6, 1), overlap=timedelta(days=90)
    )
    for now in (datetime(2001, 7, 28), datetime(2001, 8, 2)):
        run_query(spark, collector, spec, landing, now, per_line=True)
    return read_archive(spark, collector.root).select(
        "event_id", "event_type", text6(F.col("timestamp")).alias("ts"), "payload"
    )


@query("""
    SELECT c_name || '@2024-03-01T00:00:00Z' AS event_id, 'Limits' AS part_event_type, '2024' AS part_year,
           '{"limitName":"' || c_name || '","limitMax":' || c_custkey || ',"limitRemaining":0}' AS payload
    FROM customer""")
def poll_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = workspace(spark, "limit-snapshot")
    entry = F.struct(F.col("c_custkey").alias("Max"))
    table(spark, sf_dir, "customer").select(F.to_json(F.create_map("c_name", entry))).write.text(landing)
    collector = _collector(spark, "poll-limits")
    run_limits(spark, collector, landing, NOW, per_line=True)
    return read_archive(spark, collector.root).select("event_id", "part_event_type", "part_year", "payload")


@query("""
    SELECT part, part <> 'broken' AS ok, CASE part WHEN 'broken' THEN 0 ELSE (SELECT count(*) FROM customer) END AS records
    FROM (VALUES ('before'), ('broken'), ('after')) v(part)""")
def poll_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls of which the second fails: the third runs, and the failure is told."""
    landing = workspace(spark, "parts-snapshot")
    table(spark, sf_dir, "customer").select(
        F.to_json(F.create_map("c_name", F.struct(F.col("c_custkey").alias("Max"))))
    ).write.text(landing)
    collectors = {name: _collector(spark, f"parts-{name}") for name in ("before", "broken", "after")}
    paths = {"before": landing, "broken": f"{landing}-missing", "after": landing}
    parts = {
        name: lambda c=c, name=name: run_limits(spark, c, paths[name], NOW, per_line=True) for name, c in collectors.items()
    }
    outcome = poll_all(spark, parts)
    stored = [
        read_archive(spark, collectors[name].root).agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("part"), "records")
        for name in ("before", "after")
    ]
    return outcome.join(stored[0].unionByName(stored[1]), "part", "left").select(
        "part", "ok", F.coalesce("records", F.lit(0)).alias("records")
    )
