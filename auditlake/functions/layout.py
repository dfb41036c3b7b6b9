"""Object keys and Hive-style partition keys of the archive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept in keys, and the two prefixes.
UNSAFE_KEY_CHARS = r"[^A-Za-z0-9_.\-]"
SAFE_KEY = r"^[A-Za-z0-9_.\-]++\z"
UNICODE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
RAW = "raw"
MANIFESTS = "manifests"


def sanitize_key(value: Column, fallback: str = "unknown") -> Column:
    """A key-safe form of ``value``. Where characters were replaced, six hex digits
    of a hash keep different values in different partitions."""
    trimmed = F.btrim(F.coalesce(value, F.lit("")), F.lit(UNICODE_SPACE))
    clean = F.regexp_replace(trimmed, UNSAFE_KEY_CHARS, "_")
    suffix = F.substring(F.sha2(trimmed, 256), 1, 6)
    return (
        # Most keys are safe as they are; one look spares them the rest.
        F.when(value.rlike(SAFE_KEY), value)
        .when(clean == "", F.lit(fallback))
        .when(clean != trimmed, F.concat(clean, F.lit("-"), suffix))
        .otherwise(clean)
    )


def partition_columns(
    source: Column, org_id: Column, event_type: Column, time: Column
) -> dict[str, Column]:
    """The seven partition keys; the session time zone is UTC."""
    return {
        "source": sanitize_key(source),
        "org_id": sanitize_key(org_id),
        "event_type": sanitize_key(event_type),
        "year": F.date_format(time, "yyyy"),
        "month": F.date_format(time, "MM"),
        "day": F.date_format(time, "dd"),
        "hour": F.date_format(time, "HH"),
    }


def partition_path(keys: dict[str, Column]) -> Column:
    """``source=…/org_id=…/…/hour=…``"""
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), c) for k, c in keys.items()])


def object_keys(path: Column, name: Column) -> tuple[Column, Column]:
    """Data key and manifest key of a named object inside a partition path."""
    safe = sanitize_key(name, "object")
    data = F.concat(F.lit(f"{RAW}/"), path, F.lit("/"), safe, F.lit(".json.gz"))
    return data, manifest_key(data)


def manifest_key(object_key: Column) -> Column:
    moved = F.regexp_replace(object_key, rf"^{RAW}/", f"{MANIFESTS}/")
    return F.regexp_replace(moved, r"\.json\.gz$", ".manifest.json")


def join_prefix(prefix: str, key: str) -> str:
    prefix = prefix.strip("/")
    return f"{prefix}/{key}" if prefix else key


def object_key_of(path: Column) -> Column:
    """Key of a stored object relative to the archive root, from its full path."""
    return F.regexp_extract(path, rf"({RAW}/source=[^/]*/org_id=.*)$", 1)
