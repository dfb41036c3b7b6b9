"""Schemas of the records, objects and state this package reads and writes."""

from __future__ import annotations

# Names of the four kinds of source in the archive layout.
STREAM = "stream"
EVENTLOG = "eventlog"
SOQL = "soql"
LIMITS = "limits"

# Format marks of the stored objects.
MANIFEST_VERSION = 2
COLLECTOR = "auditlake"
COLLECTOR_VERSION = "1"

# Normalised record: every source is brought to this shape before the sink.
RECORD = (
    "event_id string, event_type string, timestamp timestamp, source string, env string, "
    "org_id string, instance string, replay_id string, payload_json string, "
    "partition_time timestamp, object_name string, object_type string"
)
RECORD_COLUMNS = [c.strip().split(" ")[0] for c in RECORD.split(",")]

# Envelope fields in front of the payload, all text on disk.
ENVELOPE_HEADER = (
    "event_id string, event_type string, timestamp string, source string, env string, "
    "org_id string, instance string, replay_id string"
)

# Hive-style keys of the layout; `unit` names one logical object.
HOUR_KEYS = ["source", "org_id", "event_type", "year", "month", "day", "hour"]
PART_KEYS = [*HOUR_KEYS, "unit"]

MANIFEST = (
    "manifestVersion int, collector string, collectorVersion string, source string, orgId string, "
    "instance string, eventType string, objectKey string, recordCount bigint, "
    "uncompressedBytes bigint, compressedBytes bigint, sha256 string, firstTimestamp string, "
    "lastTimestamp string, ingestedAt string, lineage map<string,string>"
)

CATALOG = (
    "Id: string, LogDate: string, CreatedDate: string, LogFile: string, EventType: string, "
    "Interval: string, Sequence: int, LogFileLength: double"
)

LIMIT_ENTRY = "struct<Max:bigint,Remaining:bigint>"

WATERMARKS = "instance string, kind string, scope string, value string, version bigint"
MARKERS = "instance string, kind string, scope string, key string, marked_at timestamp"
ATTEMPTS = "instance string, kind string, key string, n int, version bigint"
