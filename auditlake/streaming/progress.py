"""Live measures of running topics, kept as a table that freshness reports read."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from auditlake.functions.times import ts_lit, utc
from auditlake.session import empty, path_exists

PROGRESS = (
    "kind string, name string, run string, batch_id bigint, at timestamp, records bigint, newest_event timestamp,"
    " without_id bigint, seconds double, error string"
)
BATCH, MEASURED, IDLE, ENDED = "batch", "measured", "idle", "ended"


def _put(spark: SparkSession, folder: str, row: dict) -> None:
    """One small file for each row: nothing is read or rewritten, and no Spark job runs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{row['kind']}-{uuid.uuid4().hex}.json")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    try:
        out.write(bytearray(json.dumps(row).encode()))
    finally:
        out.close()


def _text(at: datetime | None) -> str | None:
    return utc(at).isoformat() if at else None


class ProgressTable(StreamingQueryListener):
    """Writes what Spark tells of every batch, idle trigger and end of the topics' queries."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"kind": BATCH, "name": p.name, "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp}
        _put(self.spark, self.folder, {**row, "records": p.numInputRows, "seconds": p.batchDuration / 1000})

    def onQueryIdle(self, event) -> None:
        run = str(event.runId)
        _put(self.spark, self.folder, {"kind": IDLE, "name": self.names.get(run), "run": run, "at": event.timestamp})

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        _put(self.spark, self.folder, {"kind": ENDED, "name": self.names.get(run), "run": run, "error": event.exception})

    def report(self, name: str):
        """What a topic calls between manifests and commit: the measures observed while a batch was written."""

        def write(batch_id: int, measures: dict) -> None:
            row = {"kind": MEASURED, "name": name, "batch_id": batch_id, "records": measures["records"]}
            newest = _text(measures["newest_event"])
            _put(self.spark, self.folder, {**row, "newest_event": newest, "without_id": measures["without_id"]})

        return write


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    if not path_exists(spark, folder):
        return empty(spark, PROGRESS)
    return spark.read.schema(PROGRESS).json(folder)


def live_freshness(progress: DataFrame, now: datetime, warn_seconds: int = 43_200, page_seconds: int = 86_400) -> DataFrame:
    """Per topic query: batches, archived records, the newest event with its age, and whether it runs on time.

    A repeated batch counts once. A query that ended with an error is in state `failed`, however fresh it is.
    """
    batches = progress.where(F.col("kind") == MEASURED).groupBy("name", "batch_id").agg(
        F.max("records").alias("records"), F.max("newest_event").alias("newest"), F.max("without_id").alias("without")
    )
    sums = batches.groupBy("name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("records").alias("records"),
        F.sum("without").alias("without_id"),
        F.max("newest").alias("newest_event"),
    )
    ended = progress.where(F.col("kind") == ENDED).groupBy("name").agg(F.max("error").alias("error"))
    age = F.unix_seconds(ts_lit(now)) - F.unix_seconds("newest_event")
    return sums.join(ended, "name", "left").select(
        "name", "batches", "records", "without_id", "newest_event", age.alias("age_seconds"),
        F.when(F.col("error").isNotNull(), F.lit("failed"))
        .when(age > page_seconds, F.lit("page"))
        .when(age > warn_seconds, F.lit("warn"))
        .otherwise(F.lit("ok"))
        .alias("state"),
    )
