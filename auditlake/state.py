"""Poll state as append-only Parquet tables: watermarks, markers and attempts.

A change is a new row with a higher version, so a crash leaves either the old or the
new state, never half of one. Everything is namespaced by instance, kind and scope.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.times import ts_lit, utc, watermark_time
from auditlake.schemas import ATTEMPTS, MARKERS, WATERMARKS
from auditlake.session import child_names, delete_path, empty, path_exists

# Fixed value: how long de-duplication markers live.
MARKER_TTL = timedelta(days=7)

# Versions of a watermark that are kept; only the newest counts, readers may hold an older listing.
VERSIONS_KEPT = 20
# So many changes of the failure counters are read one by one; then they become one table again.
CHANGES_KEPT = 20

LOG_FILES = "log_files"
QUERY = "query"
MALFORMED = "malformed"
UNAVAILABLE = "unavailable"


class State:
    """State tables below one folder. A read error fails the caller; only a table
    that was never written counts as empty.

    Every key has a folder of its own with a single writer, so polls that run side
    by side never commit into the same folder.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str, instance: str, kind: str, scope: str = "") -> str:
        names = [quote(n, safe="") or "-" for n in (instance, kind, scope)]
        return "/".join([self.root, table, *names])

    def _read(self, path: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, path):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    # --- watermarks: never expire ---------------------------------------------------

    def watermarks(self) -> DataFrame:
        """Current value per key; cleared keys are left out."""
        return latest_watermarks(self._read(f"{self.root}/watermarks", WATERMARKS))

    def watermark(self, instance: str, kind: str, scope: str = "") -> datetime | None:
        log = self._read(self.path("watermarks", instance, kind, scope), WATERMARKS)
        rows = latest_watermarks(log).select(watermark_time(F.col("value")).alias("t")).head(1)
        return rows[0].t if rows else None

    def set_watermark(self, instance: str, kind: str, scope: str, value: datetime | None) -> None:
        """Append the next version of a key; None clears it."""
        path = self.path("watermarks", instance, kind, scope)
        last = self._read(path, WATERMARKS).agg(F.max("version").alias("v")).head().v or 0
        millis = F.lit(None) if value is None else F.unix_millis(ts_lit(value))
        row = self.spark.range(1).select(
            F.lit(instance).alias("instance"), F.lit(kind).alias("kind"), F.lit(scope).alias("scope"),
            millis.cast("string").alias("value"), F.lit(last + 1).cast("bigint").alias("version"),
        )
        # A folder for each version: the order is in the names, whatever times the store gives.
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_versioned('v', last + 1)}")
        for name in sorted(n for n in child_names(self.spark, path) if n.startswith("v-"))[:-VERSIONS_KEPT]:
            delete_path(self.spark, f"{path}/{name}")

    def reset(
        self, instance: str, known: Sequence[str], keys: Sequence[str] | str, confirm: bool, kind: str = QUERY
    ) -> DataFrame:
        """Clear the watermarks of named scopes, or of ``all`` known ones.

        Unknown names are errors, so a typing mistake cannot pass for a reset, and
        nothing happens without ``confirm``. Returns the values that were cleared.
        """
        names = list(known) if keys == "all" else [k.strip() for k in keys if k.strip()]
        unknown = sorted(set(names) - set(known))
        if unknown:
            raise ValueError(f"unknown keys {unknown}; known are {sorted(known)} or 'all'")
        if not names:
            raise ValueError("no keys given to reset")
        if not confirm:
            raise PermissionError(f"refusing to reset {names} without confirmation: this can leave a gap")
        old = self.watermarks().where(
            (F.col("instance") == instance) & (F.col("kind") == kind) & F.col("scope").isin(names)
        )
        previous = {r.scope: r.value for r in old.collect()}  # one row per named key
        for name in names:
            self.set_watermark(instance, kind, name, None)
        return self.spark.createDataFrame(
            [(instance, kind, n, previous.get(n)) for n in names],
            "instance string, kind string, scope string, previous string",
        )

    def backfill(self, instance: str, kind: str, scope: str, start: datetime, confirm: bool) -> None:
        """Set a watermark back so that the next poll reads from ``start`` on. Log files
        are stored over themselves, query rows are skipped by their live markers."""
        if not confirm:
            raise PermissionError("refusing to move a watermark without confirmation")
        self.set_watermark(instance, kind, scope, start)

    # --- markers: expire --------------------------------------------------------------

    def markers(
        self, instance: str, kind: str, scope: str, now: datetime, ttl: timedelta = MARKER_TTL
    ) -> DataFrame:
        """Live markers of one namespace. The day folder prunes expired ones."""
        path = self.path("markers", instance, kind, scope)
        schema = f"{MARKERS}, marked_day date"
        if not path_exists(self.spark, path):
            return empty(self.spark, schema)
        first_day = F.to_date(ts_lit(now) - F.lit(ttl))
        rows = self.spark.read.schema(schema).parquet(path).where(F.col("marked_day") >= first_day)
        return live_markers(rows, now, ttl)

    def mark(self, keys: DataFrame, instance: str, kind: str, scope: str, now: datetime) -> None:
        """``keys``: one column `key`."""
        rows = keys.select(
            F.lit(instance).alias("instance"), F.lit(kind).alias("kind"), F.lit(scope).alias("scope"),
            "key", ts_lit(now).alias("marked_at"), F.to_date(ts_lit(now)).alias("marked_day"),
        )
        path = self.path("markers", instance, kind, scope)
        rows.write.mode("append").partitionBy("marked_day").parquet(path)
        self.drop_expired(path, now)

    def drop_expired(self, path: str, now: datetime, ttl: timedelta = MARKER_TTL) -> None:
        """Delete the days whose markers have all expired; one day more is kept for readers."""
        last = utc(now) - ttl - timedelta(days=1)
        for name in child_names(self.spark, path):
            day = name.removeprefix("marked_day=")
            if day != name and day < f"{last:%Y-%m-%d}":
                delete_path(self.spark, f"{path}/{name}")

    # --- attempts -----------------------------------------------------------------------

    def _attempt_folders(self, path: str) -> tuple[list[str], list[str]]:
        """What makes up the counters, the last whole table and the changes after it; and what is older."""
        names = sorted(child_names(self.spark, path), key=lambda n: (n.rpartition("-")[2], n))
        names = [n for n in names if n.startswith(("change-", "whole-")) and path_exists(self.spark, f"{path}/{n}/_SUCCESS")]
        at = max((i for i, n in enumerate(names) if n.startswith("whole-")), default=0)
        return names[at:], names[:at]

    def attempts(self, instance: str, kind: str) -> DataFrame:
        """Current failure count per key."""
        path = self.path("attempts", instance, kind)
        names, _ = self._attempt_folders(path)
        if not names:
            return empty(self.spark, "key string, n int, version bigint")
        log = self.spark.read.schema(ATTEMPTS).parquet(*[f"{path}/{n}" for n in names])
        return (
            log.groupBy("key")
            .agg(F.max_by("n", "version").alias("n"), F.max("version").alias("version"))
            .where(F.col("n") > 0)
        )

    def set_attempts(self, counts: DataFrame, instance: str, kind: str) -> None:
        """``counts``: key, n. Zero clears a key.

        A change is a folder of its own. After `CHANGES_KEPT` of them the counters are written as one
        table, without cleared keys; what it replaces is deleted with the next one, so that readers
        with an older listing find it.
        """
        path = self.path("attempts", instance, kind)
        names, older = self._attempt_folders(path)
        last = int(names[-1].rpartition("-")[2]) if names else 0

        def put(rows: DataFrame, what: str, version: int) -> None:
            rows.select(
                F.lit(instance).alias("instance"), F.lit(kind).alias("kind"), "key",
                F.col("n").cast("int").alias("n"), F.lit(version).cast("bigint").alias("version"),
            ).write.mode("overwrite").parquet(f"{path}/{_versioned(what, version)}")

        put(counts, "change", last + 1)
        if len(names) >= CHANGES_KEPT:
            put(self.attempts(instance, kind), "whole", last + 2)
            for name in older:
                delete_path(self.spark, f"{path}/{name}")


def _versioned(what: str, version: int) -> str:
    return f"{what}-{version:012d}"


def latest_watermarks(log: DataFrame) -> DataFrame:
    latest = log.groupBy("instance", "kind", "scope").agg(
        F.max_by("value", "version").alias("value"), F.max("version").alias("version")
    )
    return latest.where(F.col("value").isNotNull())


def live_markers(markers: DataFrame, now: datetime, ttl: timedelta = MARKER_TTL) -> DataFrame:
    """Markers younger than ``ttl``; one exactly that old is expired."""
    return markers.where(F.col("marked_at") > ts_lit(now) - F.lit(ttl))
