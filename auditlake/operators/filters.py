"""Row filters and the checks on poll specifications."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions.times import ts_lit
from auditlake.schemas import MANIFEST_VERSION

# Valid names, refused keywords and the statuses that never recover.
EVENT_TYPE_NAME = re.compile(r"^[A-Za-z0-9_]+$")
ROW_LIMIT = r"(?i)\b(LIMIT|OFFSET)\b"
PERMANENT_STATUSES = [400, 404, 410]


def _bound(value: Column | datetime) -> Column:
    return ts_lit(value) if isinstance(value, datetime) else value


def in_window(
    df: DataFrame, column: str | Column, since: Column | datetime, until: Column | datetime
) -> DataFrame:
    """Rows inside the window, both ends included and in second precision."""
    low, high = (F.date_trunc("second", _bound(b)) for b in (since, until))
    if isinstance(column, str):
        return df.where(F.col(column).between(low, high))
    # Both ends look at one value: an expression written twice would be computed twice.
    return df.where(F.exists(F.array(column), lambda c: c.between(low, high)))


def finished_in_window(
    df: DataFrame, end_column: str | Column, since: Column | datetime, until: Column | datetime
) -> DataFrame:
    """Rows that *finished* in the window: the start time is not looked at, so
    long-running rows are taken once they are done and running ones wait."""
    return in_window(df, end_column, since, until)


def hourly_only(df: DataFrame, all_intervals: bool = False) -> DataFrame:
    return df if all_intervals else df.where(F.col("Interval") == "Hourly")


def event_types_in(
    df: DataFrame, types: Sequence[str] | None, column: str = "EventType"
) -> DataFrame:
    """Rows of the listed event types; an empty list keeps all."""
    for name in types or []:
        if not EVENT_TYPE_NAME.match(name):
            raise ValueError(f"invalid event type {name!r}: letters, digits and underscore only")
    return df.where(F.col(column).isin(list(types))) if types else df


def all_of(*clauses: Column | None) -> Column:
    given = [c for c in clauses if c is not None]
    return functools.reduce(operator.and_, given, F.lit(True)) if given else F.lit(True)


def any_of(*clauses: Column | None) -> Column:
    given = [c for c in clauses if c is not None]
    return functools.reduce(operator.or_, given) if given else F.lit(True)


def where(df: DataFrame, *clauses: str | Column | None, any_group: Sequence[str | Column] = ()) -> DataFrame:
    """All clauses, AND one of ``any_group`` where given."""
    as_column = lambda c: F.expr(c) if isinstance(c, str) else c
    given = [as_column(c) for c in clauses if c is not None and not (isinstance(c, str) and not c)]
    group = [as_column(c) for c in any_group]
    return df.where(all_of(*given, any_of(*group) if group else None))


def select_fields(
    df: DataFrame, fields: Sequence[str], timestamp: str, end_timestamp: str | None = None
) -> DataFrame:
    """The listed fields. The time fields must be among them, because their values
    are part of every row's de-duplication key."""
    if not fields:
        raise ValueError("a query needs at least one selected field")
    listed = {f.strip().lower() for f in fields}
    for needed in filter(None, [timestamp, end_timestamp]):
        if needed.lower() not in listed:
            raise ValueError(f"the query must select its time field {needed!r}")
    return df.select(*[f.strip() for f in fields])


def limits_named(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Listed limits that exist; an empty list keeps all."""
    return df.where(F.col("name").isin(list(names))) if names else df


def incomplete_downloads(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Files whose received length differs from the declared one (when declared)."""
    return (
        catalog.select(F.col("Id").alias("file_id"), "LogFileLength")
        .join(files.select("file_id", "length"), "file_id")
        .where((F.col("LogFileLength") > 0) & (F.col("length") != F.col("LogFileLength")))
    )


def is_permanent(status: Column) -> Column:
    return F.coalesce(status.isin(PERMANENT_STATUSES), F.lit(False))


def permanent_failures(df: DataFrame, column: str = "status") -> DataFrame:
    return df.where(is_permanent(F.col(column)))


def supported_manifests(manifests: DataFrame) -> DataFrame:
    return manifests.where(F.col("manifestVersion") == MANIFEST_VERSION)


def unsupported_manifests(manifests: DataFrame) -> DataFrame:
    return manifests.where(
        F.coalesce(F.col("manifestVersion"), F.lit(0)) != MANIFEST_VERSION
    )


# Hours before a window in which events of it can have arrived: clocks differ, none arrives a day early.
EARLY_HOURS = 24


def partition_filter(
    df: DataFrame, since: datetime, until: datetime, slack_hours: int | None = None, column: str = "timestamp"
) -> DataFrame:
    """Prune on the partition keys, then filter on the event time.

    Streams and query rows are partitioned by arrival, and a backfill or a late file may bring events at any
    time after they happened: hours that lie well before the window are passed over, later ones are not.
    With ``slack_hours`` only rows that arrived within so many hours around the window are read.
    """
    stamp = F.concat_ws("-", "part_year", "part_month", "part_day", "part_hour")

    def hour(at: datetime, hours: int) -> Column:
        return F.date_format(ts_lit(at) + F.make_dt_interval(hours=F.lit(hours)), "yyyy-MM-dd-HH")

    rows = df.where(stamp >= hour(since, -(EARLY_HOURS if slack_hours is None else slack_hours)))
    if slack_hours is not None:
        rows = rows.where(stamp <= hour(until, slack_hours))
    return rows.where((F.col(column) >= ts_lit(since)) & (F.col(column) < ts_lit(until)))


def require_no_row_limits(specs: DataFrame, column: str = "tail") -> DataFrame:
    """Specs, failing the job where one truncates its result: the watermark would
    move past rows that were never read."""
    bad = F.coalesce(F.col(column), F.lit("")).rlike(ROW_LIMIT)
    stop = F.raise_error(F.lit("LIMIT and OFFSET are not allowed in a query tail"))
    return specs.withColumn(column, F.when(bad, stop.cast("string")).otherwise(F.col(column)))


def has_row_limit(tail: Column) -> Column:
    return F.coalesce(tail, F.lit("")).rlike(ROW_LIMIT)
