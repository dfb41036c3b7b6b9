"""Query registry and the frames the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.schemas import RECORD_COLUMNS, STREAM
from auditlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Arrival time given to archived test data, so that layouts are the same every run.
ARRIVAL = "2024-02-01T03:10:00Z"


def query(sql: str | None = None):
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text6(ts: Column) -> Column:
    """Timestamp as text with six fraction digits."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )


def event_payload() -> Column:
    """Payload text of a test event: exact JSON with a nested member."""
    return F.concat(
        F.lit('{"USER_ID":"'), F.col("user_id").cast("string"),
        F.lit('","LOGIN_STATUS":"'), F.col("event_type"),
        F.lit('","EventIdentifier":"'), F.col("event_id").cast("string"),
        F.lit('","props":'), F.col("props"), F.lit("}"),
    )


EVENT_PAYLOAD_SQL = (
    """'{"USER_ID":"' || user_id || '","LOGIN_STATUS":"' || event_type || """
    """'","EventIdentifier":"' || event_id || '","props":' || props || '}'"""
)


def event_records(df: DataFrame, source: str = STREAM) -> DataFrame:
    """Test events as normalised archive records that arrived in one hour."""
    return df.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("ts").alias("timestamp"),
        F.lit(source).alias("source"),
        F.lit("prod").alias("env"),
        F.lit("00D000000000001").alias("org_id"),
        F.lit("main").alias("instance"),
        F.base64(F.col("event_id").cast("string").cast("binary")).alias("replay_id"),
        event_payload().alias("payload_json"),
        F.lit(ARRIVAL).cast("timestamp").alias("partition_time"),
        F.lit("batch-1").alias("object_name"),
        F.col("event_type").alias("object_type"),
    ).select(*RECORD_COLUMNS)
