"""Topics under renames, old files, flushes, crashes, lost files and idle runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.queries.archive import TS6, landed_topic
from auditlake.queries.registry import events, query, text6
from auditlake.session import workspace
from auditlake.sources.archive import read_archive, read_manifests
from auditlake.streaming.progress import ProgressTable, live_freshness, read_progress
from auditlake.streaming.retention import OutsideRetentionError
from auditlake.streaming.topics import EARLIEST, LATEST, Report, Topic, archive_stream, read_event_stream, run_topics

NOW = datetime(2024, 3, 1)
TOPIC = Topic("/event/Test", "main", "00D000000000001", "prod")
ARCHIVED = "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type{} FROM events WHERE {}"


class Killed(RuntimeError):
    """What the crashes of these queries raise."""


def _killed(*_) -> None:
    raise Killed("killed")


class Landing:
    """A landing folder with one folder for each part of the test events, so that a part lands by one rename."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str, parts: int):
        self.spark, self.parts = spark, parts
        self.source, schema = landed_topic(spark, sf_dir, f"{name}-events")
        self.schema = T.StructType([*schema.fields, T.StructField("late", T.IntegerType())])
        self.rows = spark.read.schema(schema).parquet(self.source)
        self.path, self.aside = workspace(spark, name), workspace(spark, f"{name}-aside")
        self.root, self.checkpoint = workspace(spark, f"{name}-archive"), workspace(spark, f"{name}-checkpoint")

    def part(self, k: int) -> DataFrame:
        return self.rows.where(F.col("payload.EventUuid").cast("bigint") % self.parts == k)

    def write(self, k: int, aside: bool = False) -> None:
        self.part(k).write.parquet(f"{self.aside if aside else self.path}/late={k}")

    def move(self, k: int, back: bool = False) -> None:
        """Rename a part into the landing folder, or back out of it."""
        names = [f"{self.aside}/late={k}", f"{self.path}/late={k}"]
        old, new = (self.spark._jvm.org.apache.hadoop.fs.Path(n) for n in (names[::-1] if back else names))
        store = old.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.mkdirs(new.getParent())
        if not store.rename(old, new):
            raise OSError(f"cannot rename {old}")

    def run(self, start: str = EARLIEST, report: Report | None = None, **how) -> None:
        stream = read_event_stream(self.spark, self.path, self.schema, start, "parquet", checkpoint=self.checkpoint)
        archive_stream(
            stream, TOPIC, self.root, self.checkpoint, initial=start, once=True, report=report, landing=self.path, **how
        ).awaitTermination()

    def crash(self) -> None:
        """A run that ends between manifests and commit."""
        try:
            self.run(report=_killed)
        except Exception as failure:  # noqa: BLE001 - wrapped by Spark
            if "killed" not in str(failure):
                raise

    def archived(self) -> DataFrame:
        return read_archive(self.spark, self.root).select("event_id", "event_type")


@query(ARCHIVED.format("", "event_id % 4 <> 0"))
def stream_latest_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LATEST passes over the files that are there and no other: two parts written before the start are
    renamed in after it, and after newer ones were archived."""
    topic = Landing(spark, sf_dir, "renamed", 4)
    topic.write(0)
    topic.write(1, aside=True)
    topic.write(2, aside=True)
    topic.run(LATEST)
    topic.write(3)
    topic.run(LATEST)
    for k in (1, 2):
        topic.move(k)
        topic.run(LATEST)
    return topic.archived()


@query("""
    SELECT CAST(i AS BIGINT) AS flush, CAST(least(2500, n - 2500 * i) AS BIGINT) AS records, TRUE AS in_order
    FROM (SELECT count(*) AS n FROM events), range(0, 1000000) r(i) WHERE 2500 * i < n""")
def stream_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch stored in flushes of at most 2500 events; the positions of a flush do not reach into the next."""
    topic = Landing(spark, sf_dir, "flushes", 1)
    topic.write(0)
    topic.run(flush_events=2500)
    number = F.substring_index(F.regexp_extract("manifest.objectKey", "/unit=([^/]*)/", 1), "-", -1).cast("bigint")
    flushes = (
        read_manifests(spark, topic.root)
        .groupBy(number.alias("flush"))
        .agg(F.sum("manifest.recordCount").alias("records"), F.max("manifest.lineage.replayIdLast").alias("last"))
    )
    # The place of an event in its file, as it was landed, and its flush as it was stored.
    stored = read_archive(spark, topic.root).select(
        F.col("event_id"), F.substring_index("part_unit", "-", -1).cast("bigint").alias("flush")
    )
    order = F.struct(
        F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.col("_metadata.row_index"),
    )
    landed = spark.read.schema(topic.schema).parquet(topic.path).select(F.col("payload.EventUuid").alias("event_id"), order.alias("place"))
    spans = stored.join(landed, "event_id").groupBy("flush").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    after = spans.select((F.col("flush") - 1).alias("flush"), F.col("low").alias("next"))
    checked = spans.join(after, "flush", "left").select(
        "flush", F.coalesce(F.col("high") < F.col("next"), F.lit(True)).alias("in_order")
    )
    return flushes.join(checked, "flush").select("flush", "records", "in_order")


@query(ARCHIVED.format(", TRUE AS stopped", "event_id % 3 <> 2"))
def stream_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an unfinished batch are taken away: the topic does not start until they are back. Files that
    were archived may go."""
    topic = Landing(spark, sf_dir, "retention", 3)
    topic.write(0)
    topic.run()
    topic.write(1, aside=True)
    topic.move(1)
    topic.crash()
    topic.move(1, back=True)
    stopped = False
    try:
        topic.run()
    except OutsideRetentionError:
        stopped = True
    topic.move(1)
    topic.run()
    return topic.archived().withColumn("stopped", F.lit(stopped))


@query(ARCHIVED.format(", CAST(1 AS BIGINT) AS copies", "TRUE"))
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was stored but not committed is stored again under its own name: nothing is there twice."""
    topic = Landing(spark, sf_dir, "replay", 2)
    topic.write(0)
    topic.crash()
    topic.run()
    topic.write(1)
    topic.crash()
    topic.run()
    return topic.archived().groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("copies"))


@query(ARCHIVED.format(", TRUE AS stopped", "event_id % 2 = 0"))
def stream_undecodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events of which one does not fit the schema stop the stream; what was archived before stays."""
    topic = Landing(spark, sf_dir, "undecodable", 2)
    landing = workspace(spark, "undecodable-json")
    schema = topic.part(0).schema

    def run() -> None:
        stream = read_event_stream(spark, landing, schema, fmt="json", checkpoint=topic.checkpoint)
        archive_stream(stream, TOPIC, topic.root, topic.checkpoint, initial=EARLIEST, once=True).awaitTermination()

    topic.part(0).write.json(landing)
    run()
    text = topic.part(1).select(F.to_json(F.struct(*schema.names)).alias("value"), "payload.EventUuid")
    newest = text.agg(F.max(F.col("EventUuid").cast("bigint"))).scalar()
    broken = F.when(F.col("EventUuid").cast("bigint") == newest, F.lit('{"payload": oops')).otherwise(F.col("value"))
    text.select(broken.alias("value")).write.mode("append").text(landing)
    stopped = False
    try:
        run()
    except Exception as failure:  # noqa: BLE001 - wrapped by Spark
        stopped = "MALFORMED" in str(failure) or "Malformed" in str(failure)
    return topic.archived().withColumn("stopped", F.lit(stopped))


@query("SELECT '/event/' || event_type AS topic, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY event_type")
def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query for each event type, run side by side into one archive."""
    source, schema = landed_topic(spark, sf_dir, "topics-events")
    landing, root = workspace(spark, "topics"), workspace(spark, "topics-archive")
    rows = spark.read.schema(schema).parquet(source)
    kind = F.substring_index("schema_name", ".", -1)
    rows.withColumn("topic", kind).write.partitionBy("topic").parquet(landing)
    names = [r.topic for r in rows.select(kind.alias("topic")).distinct().collect()]  # one for each event type

    def start(name: str):
        stream = read_event_stream(spark, f"{landing}/topic={name}", schema, fmt="parquet")
        topic = Topic(f"/event/{name}", "main", "00D000000000001", "prod")
        checkpoint = workspace(spark, f"topics-checkpoint-{name}")
        return lambda: archive_stream(stream, topic, root, checkpoint, initial=EARLIEST, once=True)

    run_topics(spark, [start(n) for n in names])
    manifest = F.col("manifest")
    return read_manifests(spark, root).groupBy(manifest["lineage"]["topic"].alias("topic")).agg(
        F.sum(manifest["recordCount"]).alias("records")
    )


@query(ARCHIVED.format("", "TRUE"))
def stream_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that find nothing leave a position that the next one takes up."""
    topic = Landing(spark, sf_dir, "idle", 2)
    topic.write(0)
    for _ in range(3):
        topic.run()
    topic.write(1)
    stream = read_event_stream(spark, topic.path, topic.schema, fmt="parquet", checkpoint=topic.checkpoint)
    # No initial position is given: there is a stored one.
    archive_stream(stream, TOPIC, topic.root, topic.checkpoint, once=True).awaitTermination()
    return topic.archived()


@query(f"""
    SELECT 'live' AS name, CAST(2 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS without_id,
           max({TS6.replace("ts,", "make_timestamp((epoch_us(ts) // 1000) * 1000),")}) AS newest_event,
           CASE WHEN TIMESTAMP '2024-03-01' - max(ts) > INTERVAL 1 DAY THEN 'page'
                WHEN TIMESTAMP '2024-03-01' - max(ts) > INTERVAL 12 HOUR THEN 'warn' ELSE 'ok' END AS state
    FROM events""")
def stream_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness from the measures of running batches, of which one was repeated."""
    topic = Landing(spark, sf_dir, "live", 2)
    table = ProgressTable(spark, workspace(spark, "progress"))
    report = table.report("live")

    def measured_then_killed(batch_id: int, measures: dict) -> None:
        report(batch_id, measures)
        _killed()

    spark.streams.addListener(table)
    try:
        topic.write(0)
        try:
            topic.run(report=measured_then_killed)
        except Exception as failure:  # noqa: BLE001 - wrapped by Spark
            if "killed" not in str(failure):
                raise
        topic.run(report=report)
        topic.write(1)
        topic.run(report=report)
    finally:
        spark.streams.removeListener(table)
    found = live_freshness(read_progress(spark, table.folder), NOW)
    return found.select("name", "batches", "records", "without_id", text6(F.col("newest_event")).alias("newest_event"), "state")


@query(f"SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, {TS6} AS ts FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in four runs with repeats; the third has file times 20 days behind the others and is
    passed on like any."""
    from auditlake.streaming.topics import dedup_stream

    landing, out, checkpoint = (workspace(spark, n) for n in ("seen", "seen-once", "seen-checkpoint"))
    rows = events(spark, sf_dir).select(F.col("event_id").cast("string").alias("event_id"), "event_type", "ts")
    third = F.col("event_id").cast("bigint") % 3
    days = ((0, third == 0), (1, third < 2), (-20, third == 2), (2, F.lit(True)))
    for day, some in days:
        arrival = F.lit(NOW).cast("timestamp") + F.make_dt_interval(days=F.lit(day))
        rows.where(some).withColumn("arrival", arrival).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("event_id string, event_type string, ts timestamp, arrival timestamp").parquet(landing)
        (
            dedup_stream(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(out).awaitTermination()
        )
    return spark.read.schema("event_id string, event_type string, ts timestamp").parquet(out).select(
        "event_id", "event_type", text6(F.col("ts")).alias("ts")
    )
