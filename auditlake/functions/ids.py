"""Stable identifiers used to de-duplicate archived records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how an absent value is written inside identifiers.
ABSENT = "<nil>"


def first_non_empty(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def stream_event_id(event_uuid: Column, event_identifier: Column) -> Column:
    return first_non_empty(event_uuid, event_identifier)


def json_string_field(payload: Column, name: str) -> Column:
    """A top-level member of a JSON text, only if it is a JSON string.

    Text that could not be a number, a literal or a nested value must have been a
    string; only for the rest is the type looked up.
    """
    text = F.get_json_object(payload, f"$.{name}")
    member = F.from_json(payload, f"`{name}` variant")[name]

    def is_string(t: Column) -> Column:
        return ~t.rlike(r"^(-?[0-9]|true$|false$|[{\[])") | (F.schema_of_variant(member) == "STRING")

    # An array of one, so that the text is looked up once.
    return F.get(F.filter(F.array(text), is_string), F.lit(0))


def csv_row_id(file_id: Column, line: Column) -> Column:
    """First 32 hex digits of sha256("<file>|<line>"); empty without a file id."""
    digest = F.sha2(F.concat_ws("|", file_id, line.cast("string")), 256)
    return F.when(F.coalesce(file_id, F.lit("")) == "", F.lit("")).otherwise(
        F.substring(digest, 1, 32)
    )


def _length_prefixed(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(ABSENT))
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text, F.lit("|"))


def composite_id(values: Sequence[Column]) -> Column:
    """sha256 over length-prefixed values, so ("ab","c") and ("a","bc") differ."""
    return F.sha2(F.concat(*[_length_prefixed(v) for v in values]), 256)


def composite_id_of(row: Column, names: Sequence[str]) -> Column:
    """`composite_id` of a map's members; empty when one of them is missing."""
    if not names:
        return F.lit("")
    present = F.lit(True)
    for name in names:
        present = present & F.map_contains_key(row, F.lit(name))
    values = [F.try_element_at(row, F.lit(name)) for name in names]
    return F.when(present, composite_id(values)).otherwise(F.lit(""))


def row_version_id(row_id: Column, ts: Column, end_ts: Column | None = None) -> Column:
    """``<id>@<ts>[@<end_ts>]``: each version of a changed row gets its own id."""
    parts = [row_id, F.coalesce(ts, F.lit(ABSENT))]
    if end_ts is not None:
        parts.append(F.coalesce(end_ts, F.lit(ABSENT)))
    return F.when(F.coalesce(row_id, F.lit("")) == "", F.lit("")).otherwise(
        F.concat_ws("@", *parts)
    )


def dedup_key(
    instance: Column, fingerprint: Column, row_id: Column, ts: Column, end_ts: Column | None = None
) -> Column:
    """Marker key of one row version of one query; empty without a row id."""
    version = F.coalesce(ts, F.lit(ABSENT))
    if end_ts is not None:
        version = F.concat_ws("|", version, F.coalesce(end_ts, F.lit(ABSENT)))
    key = F.concat(
        instance, F.lit("_soql_"), fingerprint, F.lit("_"), row_id, F.lit("_"), version
    )
    return F.when(F.coalesce(row_id, F.lit("")) == "", F.lit("")).otherwise(key)


def query_fingerprint(
    from_: Column,
    select: Column,
    where: Column,
    tail: Column,
    timestamp: Column,
    end_timestamp: Column,
    api: Column,
) -> Column:
    """16 hex digits naming one configured query; select order does not matter.

    Each part is preceded by its length, so no two queries run into one text.
    """
    fields = F.array_sort(F.transform(select, lambda s: F.lower(F.trim(s))))
    listed = F.array_join(F.transform(fields, _length_prefixed), "")
    parts = [from_, listed, where, tail, timestamp, end_timestamp, api]
    text = F.concat(*[_length_prefixed(F.coalesce(p, F.lit(""))) for p in parts])
    return F.substring(F.sha2(text, 256), 1, 16)


def limit_id(name: Column, now_text: Column) -> Column:
    return F.concat(name, F.lit("@"), now_text)


def encode_position(position: Column) -> Column:
    """Base64 of an opaque stream position; NULL when empty, so the field is omitted."""
    return F.nullif(F.base64(position), F.lit(""))
