"""Incremental polls over landed source data.

Every poll runs in the same order: window, rows, archive objects, manifests, markers,
watermark. A step that fails leaves all later ones undone, so the next poll reads the
window again and nothing is skipped.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.ids import (
    composite_id_of,
    csv_row_id,
    dedup_key,
    first_non_empty,
    json_string_field,
    limit_id,
    query_fingerprint,
    row_version_id,
)
from auditlake.functions.payload import (
    apply_field_mapping,
    csv_event_type,
    drop_metadata,
    limit_payload,
    lineage_file,
    lineage_query,
    payload_map,
    query_event_type,
)
from auditlake.functions.times import (
    DEFAULT_INITIAL,
    DEFAULT_OVERLAP,
    csv_event_time,
    csv_partition_time,
    parse_api_date,
    query_event_time,
    require_api_date,
    rfc3339_seconds,
    ts_lit,
    utc,
)
from auditlake.operators.aggregates import attempt_counts
from auditlake.operators.filters import (
    ROW_LIMIT,
    event_types_in,
    hourly_only,
    finished_in_window,
    in_window,
    is_permanent,
)
from auditlake.operators.records import advance_watermark, good_prefix
from auditlake.schemas import EVENTLOG, LIMITS, RECORD_COLUMNS, SOQL
from auditlake.session import empty, stage
from auditlake.sinks.archive import (
    DEFAULT_RECORDS_PER_OBJECT,
    archive_units,
    unique_unit,
)
from auditlake.sources.api import (
    incomplete_result_sets,
    read_limits,
    read_log_catalog,
    read_pages,
)
from auditlake.sources.logfiles import (
    csv_lines,
    csv_rows,
    file_id_of,
    file_status,
    malformed_files,
    read_raw_lines,
)
from auditlake.state import LOG_FILES, MALFORMED, QUERY, UNAVAILABLE, State

# Failed polls before a file is set aside.
MALFORMED_ATTEMPTS = 3
UNAVAILABLE_ATTEMPTS = 5
# A log file is one unit; its objects stay far below what one read can take.
LOG_RECORDS_PER_OBJECT = 1_000_000


@dataclass(frozen=True)
class Collector:
    """Who collects, and where the archive and the state are kept."""

    instance: str
    org_id: str
    root: str
    state: State
    env: str = ""
    overlap: timedelta = DEFAULT_OVERLAP
    initial: timedelta = DEFAULT_INITIAL
    records_per_object: int = DEFAULT_RECORDS_PER_OBJECT

    def window(self, kind: str, scope: str, now: datetime) -> tuple[datetime, datetime]:
        """Overlapping window in second precision; an unreadable watermark raises."""
        mark = self.state.watermark(self.instance, kind, scope)
        start = utc(mark) - self.overlap if mark else utc(now) - self.initial
        return start, utc(now).replace(microsecond=0)

    def record_columns(self, source: str) -> dict[str, Column]:
        return {
            "source": F.lit(source),
            "env": F.lit(self.env),
            "org_id": F.lit(self.org_id),
            "instance": F.lit(self.instance),
            "replay_id": F.lit(None).cast("string"),
        }

    def as_records(self, df: DataFrame, source: str) -> DataFrame:
        return df.withColumns(self.record_columns(source)).select(*RECORD_COLUMNS)

    def as_meta(self, df: DataFrame, source: str) -> DataFrame:
        return df.withColumns(self.record_columns(source)).select(
            "source", "org_id", "instance", "object_type", "partition_time", "object_name", "lineage"
        )


# --- log files ------------------------------------------------------------------------


@dataclass(frozen=True)
class LogFileSpec:
    event_types: Sequence[str] = ()
    all_intervals: bool = False
    field_mapping: Mapping[str, Sequence[str]] = field(default_factory=dict)
    malformed_attempts: int = MALFORMED_ATTEMPTS
    unavailable_attempts: int = UNAVAILABLE_ATTEMPTS


def log_file_records(rows: DataFrame, catalog: DataFrame, mapping: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Archive records of parsed log-file rows. Types and times are taken from the
    whole row, before the field mapping drops columns."""
    files = catalog.select(
        F.col("Id").alias("file_id"),
        F.col("EventType").alias("object_type"),
        csv_partition_time(F.col("LogDate"), F.col("created")).alias("partition_time"),
    )
    row, kind = F.col("row"), F.col("object_type")
    return rows.join(files, "file_id").select(
        csv_row_id(F.col("file_id"), F.col("line")).alias("event_id"),
        csv_event_type(row, kind).alias("event_type"),
        csv_event_time(row).alias("timestamp"),
        F.to_json(apply_field_mapping(row, kind, mapping)).alias("payload_json"),
        "partition_time",
        F.concat(F.lit("elf-"), "file_id").alias("object_name"),
        "object_type",
    )


def quarantine_records(raw_lines: DataFrame, bad: DataFrame) -> DataFrame:
    """Every physical line of a malformed file as a record of its own."""
    return raw_lines.join(bad, "file_id").select(
        csv_row_id(F.col("file_id"), F.col("line_no")).alias("event_id"),
        F.col("EventType").alias("event_type"),
        F.current_timestamp().alias("timestamp"),
        F.to_json(
            F.struct(
                F.lit(True).alias("quarantined"),
                F.col("line_no").alias("lineNumber"),
                F.col("raw_line").alias("rawLine"),
                F.col("reason").alias("quarantineReason"),
            )
        ).alias("payload_json"),
        "partition_time",
        F.concat(F.lit("elf-"), "file_id", F.lit("-quarantine")).alias("object_name"),
        F.col("EventType").alias("object_type"),
    )


def tombstone_records(gone: DataFrame) -> DataFrame:
    """One record per file the source will never serve."""
    return gone.select(
        csv_row_id(F.col("file_id"), F.lit(0)).alias("event_id"),
        F.col("EventType").alias("event_type"),
        F.col("created").alias("timestamp"),
        F.to_json(
            F.struct(
                F.lit(True).alias("unavailable"),
                F.col("file_id").alias("eventLogFileId"),
                F.col("reason").alias("unavailableReason"),
                F.col("attempts").alias("attempts"),
            )
        ).alias("payload_json"),
        "partition_time",
        F.concat(F.lit("elf-"), "file_id", F.lit("-unavailable")).alias("object_name"),
        F.col("EventType").alias("object_type"),
    )


def file_outcomes(
    pending: DataFrame,
    landed: DataFrame,
    fetches: DataFrame,
    bad: DataFrame,
    malformed: DataFrame,
    unavailable: DataFrame,
    spec: LogFileSpec,
) -> DataFrame:
    """What becomes of each pending file: `archive`, `quarantine`, `tombstone` or `fail`.

    A file that is not there, or shorter than declared, blocks the files after it
    unless its download failed for good; a malformed or lost file stops blocking once
    it has failed often enough.
    """
    joined = (
        pending.withColumnRenamed("Id", "file_id")
        .join(landed.select("file_id", "length"), "file_id", "left")
        .join(fetches.select("file_id", "status", "body"), "file_id", "left")
        .join(bad.select("file_id", F.col("reason").alias("bad_reason")), "file_id", "left")
    )
    counted = attempt_counts(joined.withColumn("key", F.col("file_id")), malformed)
    counted = attempt_counts(counted.withColumnRenamed("attempts", "m_attempts"), unavailable)
    counted = counted.withColumnRenamed("attempts", "u_attempts").drop("key")
    missing = F.col("length").isNull()
    gone = missing & is_permanent(F.col("status"))
    partial = (F.col("LogFileLength") > 0) & (F.col("length") != F.col("LogFileLength"))
    malformed_now = F.col("bad_reason").isNotNull()
    action = (
        F.when(gone & (F.col("u_attempts") >= spec.unavailable_attempts), F.lit("tombstone"))
        .when(missing | F.coalesce(partial, F.lit(False)), F.lit("fail"))
        .when(malformed_now & (F.col("m_attempts") >= spec.malformed_attempts), F.lit("quarantine"))
        .when(malformed_now, F.lit("fail"))
        .otherwise(F.lit("archive"))
    )
    reason = (
        F.when(
            missing & F.col("status").isNotNull(),
            F.concat(F.lit("HTTP "), F.col("status").cast("string"), F.lit(": "), F.coalesce("body", F.lit(""))),
        )
        .when(missing, F.lit("nothing has landed"))
        .when(
            partial,
            F.concat(
                F.lit("has "), F.col("length").cast("string"),
                F.lit(" bytes where its listing says "), F.col("LogFileLength").cast("bigint").cast("string"),
            ),
        )
        .otherwise(F.col("bad_reason"))
    )
    readable = ~missing & ~F.coalesce(partial, F.lit(False))
    return counted.select(
        "*",
        action.alias("action"),
        reason.alias("reason"),
        F.when(gone, F.lit(UNAVAILABLE))
        .when(malformed_now & readable, F.lit(MALFORMED))
        .alias("counter"),
        F.when(gone, F.col("u_attempts")).otherwise(F.col("m_attempts")).alias("attempts"),
        (action == "fail").alias("failed"),
    )


def listed_files(
    catalog: DataFrame, markers: DataFrame, since: datetime, until: datetime, spec: LogFileSpec
) -> DataFrame:
    """Listed files of the window; `known` is set for those archived before."""
    listed = catalog.withColumn("created", require_api_date(F.col("CreatedDate"), "CreatedDate"))
    listed = in_window(listed, "created", since, until)
    listed = event_types_in(hourly_only(listed, spec.all_intervals), spec.event_types)
    marked = markers.select(F.col("key").alias("Id"), F.lit(True).alias("marked")).distinct()
    return listed.join(marked, "Id", "left").select(
        *listed.columns, F.coalesce("marked", F.lit(False)).alias("known")
    )


def poll_log_files(
    spark: SparkSession,
    collector: Collector,
    pages_dir: str,
    files_dir: str,
    now: datetime,
    spec: LogFileSpec | None = None,
    fetches: DataFrame | None = None,
    per_line: bool = False,
) -> DataFrame:
    """Archive the log files listed in the window, in order, up to the first failure.

    ``files_dir`` holds the downloads as ``<Id>.csv``; ``fetches`` (`file_id, status,
    body`) tells why a download is missing. Returns the outcomes; raises nothing for a
    blocked file, its row has `failed` set.
    """
    spec = spec or LogFileSpec()
    state, instance = collector.state, collector.instance
    since, until = collector.window(LOG_FILES, "", now)
    if fetches is None:
        fetches = empty(spark, "file_id string, status int, body string")
    markers = state.markers(instance, LOG_FILES, "", now)
    catalog = read_log_catalog(spark, pages_dir, per_line)
    listed = stage(listed_files(catalog, markers, since, until, spec), "listed")
    pending = listed.where(~F.col("known")).drop("known")

    downloads = landed_files(spark, files_dir).join(
        pending.select(F.col("Id").alias("file_id")), "file_id", "left_semi"
    )
    known = (state.attempts(instance, MALFORMED), state.attempts(instance, UNAVAILABLE))
    nothing_bad = empty(spark, "file_id string, reason string")
    first_look = file_outcomes(pending, downloads, fetches, nothing_bad, *known, spec)
    if pending.isEmpty():
        _advance_files(collector, listed, first_look)
        return first_look
    # A file that is not here blocks the ones after it: those need not be parsed.
    reachable = good_prefix(first_look, "created", "file_id", "failed")
    paths = [r.path for r in downloads.join(reachable, "file_id", "left_semi").select("path").toLocalIterator()]
    lines = stage(csv_lines(spark, paths), "lines") if paths else None
    status = stage(file_status(lines), "status") if paths else None
    bad = malformed_files(status) if paths else nothing_bad
    outcomes = stage(file_outcomes(pending, downloads, fetches, bad, *known, spec), "outcomes")
    done = good_prefix(outcomes, "created", "file_id", "failed").withColumn(
        "partition_time", csv_partition_time(F.col("LogDate"), F.col("created"))
    )
    actions = {r.action for r in done.select("action").distinct().collect()}  # at most three
    if actions:
        _archive_files(collector, done, actions, lines, status, spec)
        # Data and manifests are stored; now remember the files, then move on.
        state.mark(done.select(F.col("file_id").alias("key")), instance, LOG_FILES, "", now)
    _count_attempts(state, instance, outcomes, done)
    _advance_files(collector, listed, outcomes)
    return outcomes


def landed_files(spark: SparkSession, files_dir: str) -> DataFrame:
    """Id and size of every download, from the listing alone."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files_dir)
        .select(file_id_of(F.col("path")).alias("file_id"), "path", "length")
    )


def _archive_files(
    collector: Collector,
    done: DataFrame,
    actions: set[str],
    lines: DataFrame | None,
    status: DataFrame | None,
    spec: LogFileSpec,
) -> None:
    """Objects and manifests of the files dealt with; only the kinds that occur."""
    chosen = {a: done.where(F.col("action") == a) for a in actions}
    parts = []
    if "archive" in chosen:
        # All files good but empty leave nothing to parse and nothing to store.
        files = chosen["archive"].withColumnRenamed("file_id", "Id")
        parts.append(log_file_records(csv_rows(lines, status), files, spec.field_mapping))
    if "quarantine" in chosen:
        bad = chosen["quarantine"].select("file_id", "EventType", "partition_time", "reason")
        parts.append(quarantine_records(read_raw_lines(lines), bad))
    if "tombstone" in chosen:
        parts.append(tombstone_records(chosen["tombstone"]))
    records = functools.reduce(DataFrame.unionByName, parts)
    suffix = F.when(F.col("action") == "quarantine", F.lit("-quarantine")).when(
        F.col("action") == "tombstone", F.lit("-unavailable")
    ).otherwise(F.lit(""))
    extra = F.when(
        F.col("action") == "quarantine",
        F.create_map(F.lit("quarantineReason"), "reason", F.lit("attempts"), F.col("attempts").cast("string")),
    ).when(
        F.col("action") == "tombstone",
        F.create_map(F.lit("unavailableReason"), "reason", F.lit("attempts"), F.col("attempts").cast("string")),
    ).otherwise(F.create_map().cast("map<string,string>"))
    base = lineage_file(F.col("file_id"), F.col("LogDate"), F.col("CreatedDate"), F.col("Interval"), F.col("Sequence"))
    base = F.when(
        F.col("action") == "tombstone",
        F.map_filter(base, lambda k, _: ~k.isin("interval", "sequence")),
    ).otherwise(base)
    meta = done.select(
        F.col("EventType").alias("object_type"), "partition_time",
        F.concat(F.lit("elf-"), "file_id", suffix).alias("object_name"),
        F.map_concat(base, extra).alias("lineage"),
    )
    archive_units(
        collector.as_records(records, EVENTLOG),
        collector.root,
        meta=collector.as_meta(meta, EVENTLOG),
        records_per_object=LOG_RECORDS_PER_OBJECT,
    )


def _count_attempts(state: State, instance: str, outcomes: DataFrame, done: DataFrame) -> None:
    """Count the failure that stopped this poll; forget the files now set aside."""
    stop = outcomes.where(F.col("failed")).orderBy("created", "file_id").limit(1)
    for kind in (MALFORMED, UNAVAILABLE):
        failed = stop.where(F.col("counter") == kind).select(
            F.col("file_id").alias("key"), F.col("attempts").alias("n")
        )
        cleared = done.where((F.col("counter") == kind) & (F.col("action") != "archive")).select(
            F.col("file_id").alias("key"), F.lit(0).alias("n")
        )
        changes = failed.unionByName(cleared)
        if not changes.isEmpty():
            state.set_attempts(changes, instance, kind)


def _advance_files(collector: Collector, listed: DataFrame, outcomes: DataFrame) -> None:
    """Watermark over listed files, archived earlier or now, before the first failure."""
    failed = outcomes.where(F.col("failed")).select(F.col("file_id").alias("Id"), F.lit(True).alias("f"))
    marked = listed.join(failed, "Id", "left").withColumn("failed", F.coalesce("f", F.lit(False)))
    current = collector.state.watermark(collector.instance, LOG_FILES)
    moved = advance_watermark(marked, ts_lit(current) if current else None).head().watermark
    if moved and (not current or utc(moved) != utc(current)):
        collector.state.set_watermark(collector.instance, LOG_FILES, "", utc(moved))


# --- query results --------------------------------------------------------------------


@dataclass(frozen=True)
class QuerySpec:
    from_: str
    select: Sequence[str]
    timestamp: str
    end_timestamp: str = ""
    where: str = ""
    tail: str = ""
    api: str = "rest"
    custom_id: Sequence[str] = ()

    def check(self) -> None:
        if not self.from_ or not self.timestamp:
            raise ValueError("a query needs an object and a timestamp field")
        listed = {s.strip().lower() for s in self.select}
        if not listed:
            raise ValueError("a query needs at least one selected field")
        for name in filter(None, [self.timestamp, self.end_timestamp]):
            if name.lower() not in listed:
                raise ValueError(f"query on {self.from_!r} must select its time field {name!r}")
        if self.api not in ("rest", "tooling"):
            raise ValueError("api must be 'rest' or 'tooling'")
        if re.search(ROW_LIMIT, self.tail):
            raise ValueError(f"query on {self.from_!r} must not use LIMIT or OFFSET in its tail")

    def fingerprint(self, spark: SparkSession) -> str:
        text = lambda v: F.lit(v)
        row = spark.range(1).select(
            query_fingerprint(
                text(self.from_), F.array(*[F.lit(s) for s in self.select]), text(self.where),
                text(self.tail), text(self.timestamp), text(self.end_timestamp), text(self.api),
            ).alias("h")
        )
        return row.head().h


def query_records(rows: DataFrame, spec: QuerySpec, instance: Column, fingerprint: Column) -> DataFrame:
    """Archive records of query rows (`row_json`, `row_ref`) with the marker key of each
    version. `row_ref` is kept only where a row has no key, to tell such rows apart."""
    row_json = F.col("row_json")
    ts = F.try_element_at("m", F.lit(spec.timestamp))
    end = F.try_element_at("m", F.lit(spec.end_timestamp)) if spec.end_timestamp else None
    own = json_string_field(row_json, "Id")
    row_id = first_non_empty(own, composite_id_of(F.col("m"), spec.custom_id))
    key = dedup_key(instance, fingerprint, F.col("row_id"), ts, end)
    return (
        rows.withColumn("m", payload_map(row_json))
        .withColumn("row_id", row_id)
        .select(
            row_version_id(F.col("row_id"), ts, end).alias("event_id"),
            query_event_type(row_json, F.lit(spec.from_)).alias("event_type"),
            query_event_time(ts).alias("timestamp"),
            drop_metadata(row_json).alias("payload_json"),
            key.alias("dedup_key"),
            F.when(key == "", F.col("row_ref")).otherwise(F.lit("")).alias("row_ref"),
        )
    )


def rows_in_window(rows: DataFrame, spec: QuerySpec, since: datetime, until: datetime) -> DataFrame:
    """Window on the time field, or on the end field alone where one is given."""
    def value(name: str) -> Column:
        # The row is parsed once, though the text is looked at several times.
        return F.transform(F.array(F.get_json_object("row_json", f"$.{name}")), parse_api_date)[0]

    if spec.end_timestamp:
        return finished_in_window(rows, value(spec.end_timestamp), since, until)
    return in_window(rows, value(spec.timestamp), since, until)


def new_versions(records: DataFrame, markers: DataFrame) -> DataFrame:
    """Row versions that were not archived before, each once; rows without a key all.

    Rows without a key are told apart by where they came from, which also spreads
    them over the partitions. Both steps share one shuffle of the rows.
    """
    known = markers.select(F.col("key").alias("dedup_key"), F.lit("").alias("row_ref"))
    keys = ["dedup_key", "row_ref"]
    return records.dropDuplicates(keys).join(known, keys, "left_anti")


def poll_query(
    spark: SparkSession,
    collector: Collector,
    spec: QuerySpec,
    pages_dir: str,
    now: datetime,
    per_line: bool = False,
) -> str:
    """Archive the new row versions of one query; returns the query's fingerprint.

    An incomplete result set stops the poll with the watermark unmoved. Repeats that
    an overlapping window brings back are dropped by their markers.
    """
    spec.check()
    state, instance = collector.state, collector.instance
    fingerprint = spec.fingerprint(spark)
    since, until = collector.window(QUERY, fingerprint, now)
    pages = read_pages(spark, pages_dir, per_line=per_line)
    broken = incomplete_result_sets(pages).head(1)
    if broken:
        raise RuntimeError(
            f"query on {spec.from_} returned an incomplete result set "
            f"({broken[0].rows} of {broken[0].total_size} records)"
        )
    # The scan reads its files in a fixed order, so a repeated task numbers alike.
    numbered = pages.select(F.monotonically_increasing_id().alias("page_no"), "records")
    rows = numbered.select("page_no", F.posexplode("records").alias("pos", "row_json")).select(
        "row_json", F.concat_ws("#", "page_no", "pos").alias("row_ref")
    )
    rows = rows_in_window(rows, spec, since, until)
    records = query_records(rows, spec, F.lit(instance), F.lit(fingerprint))
    unit = unique_unit(now)
    fresh = stage(
        new_versions(records, state.markers(instance, QUERY, fingerprint, now)).withColumns(
            {"partition_time": ts_lit(until), "object_name": F.lit(unit), "object_type": F.col("event_type")}
        ),
        "query-rows",
    )
    if fresh.isEmpty():
        state.set_watermark(instance, QUERY, fingerprint, until)
        return fingerprint
    full = collector.as_records(fresh, SOQL)
    meta = fresh.select("object_type", "partition_time", "object_name").distinct().withColumn(
        "lineage", lineage_query(F.lit(spec.from_), ts_lit(since), ts_lit(until))
    )
    archive_units(
        full, collector.root, meta=collector.as_meta(meta, SOQL), unit=unit,
        records_per_object=collector.records_per_object,
    )
    state.mark(
        fresh.where(F.col("dedup_key") != "").select(F.col("dedup_key").alias("key")),
        instance, QUERY, fingerprint, now,
    )
    state.set_watermark(instance, QUERY, fingerprint, until)
    return fingerprint


# --- limits ----------------------------------------------------------------------------


def limit_records(limits: DataFrame, now: datetime) -> DataFrame:
    at = ts_lit(now)
    return limits.select(
        limit_id(F.col("name"), rfc3339_seconds(at)).alias("event_id"),
        F.lit("Limits").alias("event_type"),
        at.alias("timestamp"),
        limit_payload(F.col("name"), F.col("entry")).alias("payload_json"),
        at.alias("partition_time"),
        F.lit(unique_unit(now)).alias("object_name"),
        F.lit("Limits").alias("object_type"),
    )


def poll_limits(
    spark: SparkSession,
    collector: Collector,
    path: str,
    now: datetime,
    names: Sequence[str] | None = None,
    per_line: bool = False,
) -> None:
    """Archive one snapshot of all limits; an empty one writes nothing."""
    limits = read_limits(spark, path, names, per_line)
    if limits.isEmpty():
        return
    # Materialised by its literal unit name: one name for data and manifests.
    records = collector.as_records(limit_records(limits, now), LIMITS)
    archive_units(records, collector.root)


# --- all together ------------------------------------------------------------------------


def poll_all(spark: SparkSession, parts: Mapping[str, Callable[[], object]]) -> DataFrame:
    """Run independent polls; one that fails does not keep the others from running.

    Returns `part, ok, error`. The poll succeeded only if every row is ok.
    """
    results = []
    for name, run in parts.items():
        try:
            run()
            results.append((name, True, None))
        except Exception as failure:  # noqa: BLE001 - reported per part
            results.append((name, False, str(failure)))
    return spark.createDataFrame(results, "part string, ok boolean, error string")
