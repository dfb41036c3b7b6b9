"""Event topics: archive each micro-batch, then let Spark commit its position.

A batch is stored under a name made of topic, instance, the checkpoint's own id and batch
id, in the hours its events arrived. All are the same when Spark repeats a batch after a
crash, so a repeat replaces what the first try left behind: nothing is lost and nothing
doubled. A new checkpoint or another instance has names of its own and replaces nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from auditlake.functions.ids import stream_event_id
from auditlake.functions.payload import lineage_stream, normalize_payload, stream_event_type
from auditlake.functions.times import stream_event_time
from auditlake.operators.aggregates import batch_metrics, batch_range
from auditlake.schemas import STREAM
from auditlake.session import child_names, path_exists
from auditlake.sinks.archive import write_archive, write_manifests
from auditlake.streaming.flushes import in_flushes
from auditlake.streaming.retention import require_retained

EARLIEST = "EARLIEST"
LATEST = "LATEST"

# When a batch is flushed.
FLUSH_SECONDS = 60
FILES_PER_TRIGGER = 1000
DEDUP_DELAY = "7 days"
# Kafka's number for records whose time is the one at which the broker stored them.
LOG_APPEND = 1
# A hundred years: no landed file is too old to be read.
MAX_FILE_AGE = "36500d"


class NoCheckpointError(RuntimeError):
    """There is no stored position and nobody said where to start."""


def has_position(spark: SparkSession, checkpoint: str) -> bool:
    """Any offset counts: Spark deletes the first ones after a while."""
    return any(name.isdigit() for name in child_names(spark, f"{checkpoint.rstrip('/')}/offsets"))


def start_position(spark: SparkSession, checkpoint: str, initial: str | None) -> str:
    """`STORED`, or the initial position asked for. Starting without either is refused:
    it would leave a gap nobody notices."""
    if initial not in (None, "", EARLIEST, LATEST):
        raise ValueError(f"invalid initial position {initial!r}")
    if has_position(spark, checkpoint):
        return "STORED"
    if not initial:
        raise NoCheckpointError("no checkpoint exists; start with EARLIEST or LATEST")
    return initial


# What tells one landed file from another: a path may be used again.
LANDED = "path string, arrival timestamp, length bigint"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Every file below a landing folder; its content is not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("arrival"),
            F.col("_metadata.file_size").alias("length"),
        )
    )


def first_cut(spark: SparkSession, landing: str, checkpoint: str, start: str) -> DataFrame | None:
    """The files that a start with LATEST passes over, or None where nothing is passed over.

    All files that are there are listed once, before the first batch, and kept beside the
    checkpoint: every later start passes over the same files, whatever it is asked for, and no
    other. A file that is renamed into the folder later is not in the list, however old it is.
    """
    stored = f"{checkpoint.rstrip('/')}-latest"
    if not path_exists(spark, f"{stored}/_SUCCESS"):
        if start != LATEST or has_position(spark, checkpoint):
            return None
        landed_files(spark, landing).write.mode("overwrite").parquet(stored)
    return spark.read.schema(LANDED).parquet(stored)


def pass_over(stream: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of a stream that lie in none of the known files.

    A file newer than all of them is none of them, so its rows go straight on; only rows of older
    files, which are few after the first batch, are looked up.
    """
    newest = known.agg(F.max("arrival")).head()[0]
    if newest is None:
        return stream
    later = F.col("arrival") > F.lit(newest)
    own = F.col("arrival_order.file_path")
    files = known.select("path", F.col("arrival").alias("seen"), "length")
    same = (own == files["path"]) & (F.col("arrival") == files["seen"]) & (F.col("file_size") == files["length"])
    return stream.where(later).unionByName(stream.where(~later).join(files, same, "left_anti"))


def read_event_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    start: str = EARLIEST,
    fmt: str = "json",
    max_files: int = FILES_PER_TRIGGER,
    checkpoint: str | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Unbounded scan of landed events with their arrival time.

    An event that does not fit the schema stops the stream. With LATEST the files present
    at the first start are passed over, and only these: see `first_cut`. ``checkpoint`` has
    to be the one the stream is run with. A batch takes up to ``max_files`` files, or files of
    ``max_bytes`` in all. Spark's file source passes over files that are much older than the
    newest; here a file may have any age.
    """
    if start == LATEST and not checkpoint:
        raise ValueError("LATEST needs the checkpoint, to keep what was passed over")
    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxBytesPerTrigger" if max_bytes else "maxFilesPerTrigger", max_bytes or max_files)
        .option("mode", "FAILFAST")
        .option("maxFileAge", MAX_FILE_AGE)
        .load(landing)
        .withColumn("arrival", F.col("_metadata.file_modification_time"))
        # Row order inside an arrival order is added per batch.
        .withColumn(
            "arrival_order",
            F.struct("arrival", "_metadata.file_path", "_metadata.file_block_start"),
        )
    )
    known = first_cut(spark, landing, checkpoint, start) if checkpoint else None
    if known is None:
        return stream
    return pass_over(stream.withColumn("file_size", F.col("_metadata.file_size")), known).drop("file_size")


def read_kafka_topic(
    spark: SparkSession, servers: str, topic: str, start: str = EARLIEST, max_offsets: int = 100_000
) -> DataFrame:
    """Kafka form of the scan, for `decode_topic`; a position outside the retention stops the stream."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start.lower())
        .option("failOnDataLoss", "true")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )


def decode_topic(rows: DataFrame, schema: str) -> DataFrame:
    """Rows of a broker's topic as the events that `event_records` takes.

    ``value`` is JSON text of the given schema (`schema_name`, `payload`); one that does not fit
    stops the stream. The position of an event is its partition and offset. The record's time is kept as
    `broker_time`. It is the arrival only where the broker set it (`timestampType` 1): a producer may
    write any time, so else an event arrives when its batch begins, which a repeated batch keeps.
    """
    event = F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"})
    position = F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string"))
    arrival = F.current_timestamp()
    if "timestampType" in rows.columns:
        arrival = F.when(F.col("timestampType") == LOG_APPEND, F.col("timestamp")).otherwise(arrival)
    return rows.select(
        position.cast("binary").alias("replay_id"),
        event["schema_name"].alias("schema_name"),
        event["payload"].alias("payload"),
        arrival.alias("arrival"),
        F.struct("partition", "offset").alias("arrival_order"),
        F.col("timestamp").alias("broker_time"),
    )


@dataclass(frozen=True)
class Topic:
    """One topic and the identity its records carry."""

    name: str
    instance: str
    org_id: str
    env: str = ""


def _field(schema: T.StructType, name: str, *types: type) -> Column:
    """A payload field where it has one of the wanted types, else NULL."""
    for f in schema.fields:
        if f.name == name and isinstance(f.dataType, types):
            return F.col("payload")[name]
    return F.lit(None)


def event_records(events: DataFrame, topic: Topic, unit: Column | str) -> DataFrame:
    """Archive records of stream events (`payload` struct, `schema_name`, `replay_id`
    binary, `arrival`), plus the order they came in."""
    schema = events.schema["payload"].dataType
    numbers = (T.LongType, T.IntegerType, T.DoubleType)
    text = T.StringType
    return events.select(
        F.coalesce(
            stream_event_id(
                _field(schema, "EventUuid", text).cast("string"),
                _field(schema, "EventIdentifier", text).cast("string"),
            ),
            F.lit(""),
        ).alias("event_id"),
        stream_event_type(F.col("schema_name")).alias("event_type"),
        stream_event_time(
            _field(schema, "EventDate", *numbers), _field(schema, "CreatedDate", *numbers)
        ).alias("timestamp"),
        F.lit(STREAM).alias("source"),
        F.lit(topic.env).alias("env"),
        F.lit(topic.org_id).alias("org_id"),
        F.lit(topic.instance).alias("instance"),
        F.base64("replay_id").alias("replay_id"),
        normalize_payload(F.col("payload"), schema).alias("payload_json"),
        F.col("arrival").alias("partition_time"),
        F.struct("arrival_order", F.monotonically_increasing_id()).alias("seq"),
        (F.lit(unit) if isinstance(unit, str) else unit).alias("object_name"),
        stream_event_type(F.col("schema_name")).alias("object_type"),
    )


def batch_meta(records: DataFrame, topic: Topic) -> DataFrame:
    """Per event type and arrival hour of a batch: its replay range as lineage."""
    keyed = records.withColumn("partition_time", F.date_trunc("hour", "partition_time"))
    unit = ["source", "org_id", "instance", "object_type", "partition_time", "object_name"]
    return batch_range(keyed, *unit).select(
        *unit,
        lineage_stream(F.lit(topic.name), F.col("first_position"), F.col("last_position")).alias("lineage"),
    )


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the checkpoint: kept over restarts, new with a new checkpoint."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).head()
    return json.loads(text.value)["id"].replace("-", "")


def batch_unit(topic: Topic, run: str, batch_id: int) -> str:
    name = "-".join([topic.name.strip("/"), topic.instance, run]).replace("/", "-")
    return f"{name}-{batch_id:012d}"


Report = Callable[[int, dict], None]


def archive_batch(
    topic: Topic, root: str, checkpoint: str, report: Report | None = None, flush_events: int | None = None
):
    """The `foreachBatch` body: objects, manifests, and only then the commit.

    With ``flush_events`` a batch is stored in flushes of at most so many events, in the order
    they landed, each a unit with its own positions. ``report`` is called between manifests and
    commit with the batch id and the measures taken while the batch was written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return  # an idle trigger still commits its position
        batch = batch.persist()
        try:
            unit = batch_unit(topic, run_id(batch.sparkSession, checkpoint), batch_id)
            records = event_records(batch, topic, unit)
            if flush_events:
                records = in_flushes(records, flush_events)
            measures = Observation()
            written = records.observe(measures, *batch_metrics())
            write_archive(written, root)
            write_manifests(batch.sparkSession, root, batch_meta(records, topic), unit)
            if report:
                report(batch_id, measures.get)
        finally:
            batch.unpersist()

    return write


def archive_stream(
    events: DataFrame,
    topic: Topic,
    root: str,
    checkpoint: str,
    *,
    initial: str | None = None,
    once: bool = False,
    flush_seconds: int = FLUSH_SECONDS,
    flush_events: int | None = None,
    report: Report | None = None,
    landing: str | None = None,
) -> StreamingQuery:
    """Archive a topic. ``once`` works off what has landed and stops.

    What arrived is flushed after ``flush_seconds``, and in parts of at most ``flush_events`` where
    given. Where ``landing`` is given, the start is refused if a landed file that the last,
    unfinished batch was to archive is gone.
    """
    spark = events.sparkSession
    if start_position(spark, checkpoint, initial) == "STORED" and landing:
        require_retained(spark, landed_files(spark, landing), checkpoint)
    writer = (
        events.writeStream.queryName(f"{topic.name.strip('/')}-{topic.instance}".replace("/", "-"))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(archive_batch(topic, root, checkpoint, report, flush_events))
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{flush_seconds} seconds").start()


def run_topics(spark: SparkSession, starts: Sequence[Callable[[], StreamingQuery]]) -> None:
    """Run one query per topic until all end. The first failure stops the others and
    its error is raised."""
    running: list[StreamingQuery] = []
    spark.streams.resetTerminated()  # failures of earlier runs are not this one's
    try:
        for start in starts:
            running.append(start())
        while any(q.isActive for q in running):
            spark.streams.awaitAnyTermination()  # raises the error of a failed query
            spark.streams.resetTerminated()
    finally:
        for query in running:
            query.stop()


def dedup_stream(df: DataFrame, delay: str = DEDUP_DELAY, key: str = "event_id") -> DataFrame:
    """First event per id within ``delay`` of its first sight; state older than that is dropped.

    The horizon runs on the time at which Spark began the batch that saw an event. It only grows and is
    kept in the checkpoint, so a repeated batch has the same, and no event is ever late: the times of
    the event, of its file and of its broker play no part. Events without an id get one of their own for
    this step, so all take one way and one watermark.
    """
    own = F.when(F.coalesce(F.col(key), F.lit("")) == "", F.concat(F.lit("\0"), F.expr("uuid()"))).otherwise(F.col(key))
    seen = df.withColumn("__once", own).withColumn("__seen", F.current_timestamp()).withWatermark("__seen", delay)
    return seen.dropDuplicatesWithinWatermark(["__once"]).drop("__once", "__seen")
