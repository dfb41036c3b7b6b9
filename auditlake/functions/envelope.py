"""The stored line: a small header around the unchanged payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlake.functions.times import ZERO_TIME_TEXT, parse_rfc3339, rfc3339
from auditlake.schemas import ENVELOPE_HEADER

PAYLOAD_KEY = '"payload":'


def _optional(name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")).alias(name)


def to_envelope() -> Column:
    """Envelope line of a normalised record.

    The payload text is appended as it is rather than parsed and written again, so
    number literals, key order and escapes survive. Line breaks can only be
    insignificant whitespace in JSON and would split the line.
    """
    header = F.to_json(
        F.struct(
            _optional("event_id"),
            F.coalesce("event_type", F.lit("")).alias("event_type"),
            F.coalesce(rfc3339(F.col("timestamp")), F.lit(ZERO_TIME_TEXT)).alias("timestamp"),
            F.col("source"),
            _optional("env"),
            _optional("org_id"),
            _optional("instance"),
            _optional("replay_id"),
        )
    )
    # Searched for, not looked up for each character.
    payload = F.replace(F.replace("payload_json", F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    payload = F.coalesce(F.nullif(F.trim(payload), F.lit("")), F.lit("{}"))
    return F.concat(
        F.regexp_replace(header, r"\}$", ","), F.lit(PAYLOAD_KEY), payload, F.lit("}")
    )


def head_of(line: Column) -> Column:
    """Text in front of the payload key; the whole line where there is none.

    A quote inside a JSON string is always escaped, so the first unescaped payload
    key is the real one even if a header value contains the same words.
    """
    return F.substring_index(line, PAYLOAD_KEY, 1)


def header_of(line: Column, head: Column | None = None) -> Column:
    """Header fields of an envelope line, without touching the payload. The search for the payload
    key is the dear part: a caller that has its result (`head_of`) as a column gives it."""
    head = head_of(line) if head is None else head
    found = F.octet_length(head) < F.octet_length(line)
    return F.when(found, F.from_json(F.concat(head, F.lit(PAYLOAD_KEY + "0}")), ENVELOPE_HEADER))


def payload_of(line: Column, head: Column | None = None) -> Column:
    """Exact payload text of an envelope line; ``head`` as in `header_of`."""
    head = head_of(line) if head is None else head
    # Taken by bytes, so that no character in front of it is looked at.
    behind = F.substr(line.cast("binary"), F.octet_length(head) + len(PAYLOAD_KEY) + 1)
    text = F.rtrim(behind.cast("string"))
    found = F.octet_length(head) < F.octet_length(line)
    return F.when(found, F.substr(text, F.lit(1), F.length(text) - 1))


def envelope_time(text: Column) -> Column:
    return parse_rfc3339(text)
