"""Payload access and the rules that turn source rows into record fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions.times import rfc3339_seconds

# Columns every field mapping keeps.
ALWAYS_KEPT = ["EVENT_TYPE", "TIMESTAMP", "REQUEST_ID"]

# The API puts its metadata member first; nested objects inside it are not used.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _nested(depth: int) -> str:
    """Pattern of an object or array with up to ``depth`` levels inside."""
    inner = rf"|{_nested(depth - 1)}" if depth else ""
    return rf'[{{\[](?:[^{{}}\[\]"]++|{_STRING}{inner})*+[}}\]]'


_VALUE = rf'(?:{_STRING}|{_nested(8)}|[^\s,{{}}\[\]"]++)'
_MEMBER = rf"\s*+{_STRING}\s*+:\s*+{_VALUE}\s*+"
_ATTRIBUTES = rf'\s*+"attributes"\s*+:\s*+{_VALUE}\s*+'
# The member with the comma behind it, or, as the last one, with the comma before it.
ATTRIBUTES_FIRST = rf"^(\s*+\{{(?:{_MEMBER},)*?){_ATTRIBUTES},\s*+"
ATTRIBUTES_LAST = rf"^(\s*+\{{(?:{_MEMBER},)*?{_MEMBER}),{_ATTRIBUTES}\}}"
ATTRIBUTES_ALONE = rf"^(\s*+\{{){_ATTRIBUTES}\}}"


def payload_map(payload: Column) -> Column:
    """Payload text as ``map<string,string>`` for queries; nested values stay JSON text."""
    return F.from_json(payload, "map<string,string>")


def apply_field_mapping(
    row: Column, event_type: Column, mapping: Mapping[str, Sequence[str]] | None
) -> Column:
    """Keep the mapped columns of an event type. Types are matched without regard
    to case, columns exactly; a type without mapping keeps everything."""
    listed = {k.lower(): list(v) for k, v in (mapping or {}).items() if v}
    if not listed:
        return row
    entries: list[Column] = []
    for name, columns in listed.items():
        entries += [F.lit(name), F.array(*[F.lit(c) for c in columns])]
    wanted = F.try_element_at(F.create_map(*entries), F.lower(event_type))
    kept = F.map_filter(
        row, lambda k, _: k.isin(*ALWAYS_KEPT) | F.coalesce(F.array_contains(wanted, k), F.lit(False))
    )
    return F.when(wanted.isNull(), row).otherwise(kept)


def drop_metadata(row_json: Column) -> Column:
    """Remove the top-level ``attributes`` member, wherever it stands.

    Its text and one comma are cut out, so every other byte of the row stays as it was:
    numbers keep their digits. A row nested too deeply for the patterns is left whole.
    """
    first = F.regexp_replace(row_json, ATTRIBUTES_FIRST, "$1")
    last = F.regexp_replace(row_json, ATTRIBUTES_LAST, "$1}")
    alone = F.regexp_replace(row_json, ATTRIBUTES_ALONE, "$1}")

    def shorter(cut: Column) -> Column:
        return F.when(cut != row_json, cut).when(last != row_json, last).otherwise(alone)

    # An array of one, so that the usual pattern runs once.
    return F.when(~row_json.contains('"attributes"'), row_json).otherwise(F.transform(F.array(first), shorter)[0])


def csv_event_type(row: Column, catalog_type: Column) -> Column:
    return F.coalesce(F.nullif(F.try_element_at(row, F.lit("EVENT_TYPE")), F.lit("")), catalog_type)


def query_event_type(row_json: Column, queried: Column) -> Column:
    return F.coalesce(F.nullif(F.get_json_object(row_json, "$.attributes.type"), F.lit("")), queried)


def stream_event_type(full_name: Column) -> Column:
    """Last dotted part of the schema name."""
    last = F.element_at(F.split(F.coalesce(full_name, F.lit("")), r"\."), -1)
    return F.coalesce(F.nullif(last, F.lit("")), F.lit("UnknownEvent"))


def limit_payload(name: Column, entry: Column) -> Column:
    return F.to_json(
        F.struct(
            name.alias("limitName"),
            F.coalesce(entry["Max"], F.lit(0)).alias("limitMax"),
            F.coalesce(entry["Remaining"], F.lit(0)).alias("limitRemaining"),
        )
    )


def lineage_stream(topic: Column, first: Column, last: Column) -> Column:
    return F.create_map(
        F.lit("topic"), topic,
        F.lit("replayIdFirst"), F.coalesce(first, F.lit("")),
        F.lit("replayIdLast"), F.coalesce(last, F.lit("")),
    )


def lineage_file(
    file_id: Column, log_date: Column, created: Column, interval: Column, sequence: Column
) -> Column:
    return F.create_map(
        F.lit("eventLogFileId"), file_id,
        F.lit("logDate"), F.coalesce(log_date, F.lit("")),
        F.lit("createdDate"), F.coalesce(created, F.lit("")),
        F.lit("interval"), F.coalesce(interval, F.lit("")),
        F.lit("sequence"), F.coalesce(sequence, F.lit(0)).cast("string"),
    )


def lineage_query(from_: Column, since: Column, until: Column) -> Column:
    return F.create_map(
        F.lit("from"), from_,
        F.lit("since"), rfc3339_seconds(since),
        F.lit("until"), rfc3339_seconds(until),
    )


def normalize(value: Column, dtype: T.DataType) -> Column:
    """Plain JSON-friendly form of a typed value, driven by its schema only.

    Dates become text, timestamps and durations epoch milliseconds, decimals text
    with 18 places. Every field is kept, NULL or not; binary is left to the JSON
    writer, which emits base64.
    """
    if isinstance(dtype, T.StructType):
        fields = [normalize(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: normalize(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, x: normalize(x, dtype.valueType))
    if isinstance(dtype, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_millis(value.cast("timestamp"))
    if isinstance(dtype, T.DayTimeIntervalType):
        return _interval_millis(value, dtype)
    if isinstance(dtype, T.DecimalType):
        return _decimal_text(value, dtype)
    return value


def _interval_millis(value: Column, dtype: T.DayTimeIntervalType) -> Column:
    units = [("DAY", 86_400_000), ("HOUR", 3_600_000), ("MINUTE", 60_000), ("SECOND", 1_000)]
    wide = value.cast("interval day to second")
    total = F.lit(0).cast("decimal(30,6)")
    for unit, millis in units:
        total = total + F.date_part(F.lit(unit), wide).cast("decimal(20,6)") * millis
    return total.cast("bigint")


def _decimal_text(value: Column, dtype: T.DecimalType) -> Column:
    if dtype.scale > 18 or dtype.precision - dtype.scale <= 20:
        return value.cast("decimal(38,18)").cast("string")
    # Too many integer digits for decimal(38,18): pad the text instead.
    point = "." if dtype.scale == 0 else ""
    return F.concat(value.cast("string"), F.lit(point + "0" * (18 - dtype.scale)))


def normalize_payload(value: Column, dtype: T.StructType) -> Column:
    """`normalize` rendered as JSON text with NULL fields kept."""
    return F.to_json(normalize(value, dtype), {"ignoreNullFields": "false"})
