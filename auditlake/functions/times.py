"""Timestamp parsing, formatting and the polling window arithmetic."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted time layouts.
COMPACT_TIME = r"^\d{14}([.,]\d+)?$"
ZONED_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:?\d{2})$"
RFC3339_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"

# Defaults of the polling window.
DEFAULT_OVERLAP = timedelta(minutes=60)
DEFAULT_INITIAL = timedelta(hours=1)

ZERO_TIME_TEXT = "0001-01-01T00:00:00Z"


def _cast_guarded(value: Column, pattern: str) -> Column:
    return F.when(value.rlike(pattern), F.replace(value, F.lit(","), F.lit(".")).try_cast("timestamp"))


def parse_compact_timestamp(value: Column) -> Column:
    """``yyyyMMddHHmmss`` with an optional fraction, in UTC; NULL if it is not one."""
    digits = F.regexp_replace(
        F.replace(value, F.lit(","), F.lit(".")),
        r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)",
        "$1-$2-$3T$4:$5:$6",
    )
    return F.when(value.rlike(COMPACT_TIME), F.concat(digits, F.lit("Z")).try_cast("timestamp"))


def parse_api_date(value: Column) -> Column:
    """API dates: any fraction, offset ``Z``, ``+0000`` or ``+00:00``; NULL otherwise."""
    return _cast_guarded(value, ZONED_TIME)


def parse_rfc3339(value: Column) -> Column:
    return _cast_guarded(value, RFC3339_TIME)


def require_api_date(value: Column, what: str) -> Column:
    """`parse_api_date`, failing the job when a present value is not a date."""
    parsed = parse_api_date(value)
    message = F.concat(F.lit(f"invalid {what}: "), F.coalesce(value, F.lit("(none)")))
    return F.when(parsed.isNull(), F.raise_error(message).cast("timestamp")).otherwise(parsed)


def csv_event_time(row: Column) -> Column:
    """Event time of a log-file row given as map: TIMESTAMP, TIMESTAMP_DERIVED, else now."""
    return F.coalesce(
        parse_compact_timestamp(F.try_element_at(row, F.lit("TIMESTAMP"))),
        parse_rfc3339(F.try_element_at(row, F.lit("TIMESTAMP_DERIVED"))),
        F.current_timestamp(),
    )


def csv_partition_time(log_date: Column, created: Column) -> Column:
    """LogDate, or the creation date when LogDate is unusable. Never "now": the
    partition of a log file has to stay the same when the file is read again."""
    return F.coalesce(parse_api_date(log_date), created)


def query_event_time(value: Column) -> Column:
    return F.coalesce(parse_api_date(value), F.current_timestamp())


def stream_event_time(event_date: Column, created_date: Column) -> Column:
    """Epoch-millisecond fields of a stream event; else now."""
    return F.coalesce(
        F.timestamp_millis(event_date.cast("bigint")),
        F.timestamp_millis(created_date.cast("bigint")),
        F.current_timestamp(),
    )


def rfc3339(ts: Column) -> Column:
    """UTC text with as many fraction digits as needed, e.g. ``…T01:02:03.004Z``."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def rfc3339_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def watermark_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def watermark_time(stored: Column) -> Column:
    """Stored epoch-millis text as timestamp; an unusable value stops the job."""
    millis = stored.try_cast("bigint")
    message = F.concat(F.lit("invalid watermark: "), stored)
    return F.when(
        stored.isNotNull() & millis.isNull(), F.raise_error(message).cast("timestamp")
    ).otherwise(F.timestamp_millis(millis))


def since(
    watermark: Column,
    now: Column,
    overlap: timedelta = DEFAULT_OVERLAP,
    initial: timedelta = DEFAULT_INITIAL,
) -> Column:
    """Window start: watermark minus overlap, or now minus the initial interval."""
    return F.coalesce(watermark - F.lit(overlap), now - F.lit(initial))


def until(now: Column) -> Column:
    """Window end in the second precision of the queried API."""
    return F.date_trunc("second", now)


def utc(ts: datetime) -> datetime:
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)


def ts_lit(ts: datetime) -> Column:
    return F.lit(utc(ts).strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")
