"""Queries over damaged archives, ledgers, clashing identifiers and state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.payload import lineage_stream
from auditlake.operators.verify import manifests_without_key, sorted_findings
from auditlake.plans.compaction import compact_to_parquet, update_copy
from auditlake.plans.verify import verify_archive
from auditlake.queries.registry import event_records, events, query
from auditlake.session import stage, workspace
from auditlake.sinks.archive import archive_units, object_meta, put_manifests, touched_hours, write_archive
from auditlake.sources.api import read_expected_ids
from auditlake.sources.archive import list_objects, read_manifests, raw_root
from auditlake.state import QUERY, State

CLASHING = """
    SELECT ['stream', 'eventlog', 'soql', 'limits'][event_id % 4 + 1] AS source, 'org' || (event_id // 4 % 2) AS org_id,
           'main' || (event_id // 8 % 2) AS instance, event_type, CAST(user_id AS VARCHAR) AS event_id
    FROM events"""


def _clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test events of four sources, two orgs and two instances, named by their user's id."""
    n = F.col("event_id").cast("bigint")
    # The new names come last, as the number is taken from the old id.
    return event_records(events(spark, sf_dir)).select(
        F.element_at(F.array(*map(F.lit, ("stream", "eventlog", "soql", "limits"))), (n % 4 + 1).cast("int")).alias("source"),
        F.concat(F.lit("org"), F.floor(n / 4) % 2).alias("org_id"),
        F.concat(F.lit("main"), F.floor(n / 8) % 2).alias("instance"),
        F.get_json_object("payload_json", "$.USER_ID").alias("event_id"),
        "event_type", "timestamp", "env", "replay_id", "payload_json", "partition_time", "object_name", "object_type",
    )


@query(f"""
    SELECT source, org_id, instance, event_type, CAST(count(DISTINCT event_id) AS BIGINT) AS records
    FROM ({CLASHING}) GROUP BY ALL""")
def compaction_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal ids of other sources, orgs, instances and types are other events."""
    root, out = workspace(spark, "clashes"), workspace(spark, "clashes-curated")
    write_archive(_clashing(spark, sf_dir), root)
    compact_to_parquet(spark, root, out)
    rows = spark.read.parquet(out)
    return rows.groupBy("source", "org_id", "instance", "event_type").agg(F.count(F.lit(1)).alias("records"))


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events")
def compaction_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy made before half of the events arrived is brought up to date from the new hour's
    folders alone; dates that had records before keep them."""
    root, out = workspace(spark, "increment"), workspace(spark, "increment-curated")
    rows = event_records(events(spark, sf_dir))
    half = F.col("event_id").cast("bigint") % 2 == 0
    write_archive(rows.where(half), root)
    compact_to_parquet(spark, root, out)
    later = rows.where(~half).withColumn("partition_time", F.col("partition_time") + F.make_dt_interval(hours=F.lit(5)))
    write_archive(later, root)
    compact_to_parquet(spark, root, out, paths=touched_hours(root, object_meta(later)))
    return spark.read.parquet(out).select("event_id", "event_type")


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(1 AS BIGINT) AS copies,
           CAST(3 AS BIGINT) AS updates FROM events""")
def compaction_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that finds out by itself which objects it does not hold: events arrive in three parts with
    repeats, and an update without news reads nothing."""
    root, out = workspace(spark, "update"), workspace(spark, "update-curated")
    rows = event_records(events(spark, sf_dir))
    third = F.col("event_id").cast("bigint") % 3
    updates = 0
    for k in range(3):
        # Each part repeats the one before it.
        part = rows.where((third == k) | (third == k - 1)).withColumn("object_name", F.lit(f"part-{k}"))
        write_archive(part, root)
        updates += (update_copy(spark, root, out) > 0) + (update_copy(spark, root, out) > 0)
    found = spark.read.parquet(out).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("copies"))
    return found.withColumn("updates", F.lit(updates).cast("bigint"))


def _described(spark: SparkSession, rows: DataFrame, name: str) -> str:
    root = workspace(spark, name)
    archive_units(rows, root, meta=object_meta(rows, lineage_stream(F.lit("/event/Test"), F.lit(""), F.lit(""))))
    return root


@query("""
    WITH g AS (SELECT '/event/Test' AS grp, event_id FROM events
               UNION ALL SELECT '/event/Other', event_id FROM events WHERE event_type = 'error'),
         m AS (SELECT grp, event_id, grp <> '/event/Test' OR event_id % 7 = 0 AS missing FROM g)
    SELECT grp, CAST(count(*) AS BIGINT) AS expected, CAST(sum(CASE WHEN missing THEN 1 ELSE 0 END) AS BIGINT) AS missing,
           CAST(CASE WHEN grp = '/event/Test' THEN (SELECT count(*) FROM events WHERE event_id % 7 = 1) ELSE 0 END AS BIGINT)
               AS duplicates,
           array_to_string(list_sort(list(CAST(event_id AS VARCHAR)) FILTER (missing AND rank <= 10)), ',') AS examples
    FROM (SELECT *, row_number() OVER (PARTITION BY grp, missing ORDER BY event_id) AS rank FROM m) GROUP BY grp""")
def verify_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected-id documents against an archive in which some events are missing and some are there
    twice; the payload carries the listed identifier."""
    test_events = events(spark, sf_dir)
    rows = event_records(test_events)
    n = F.col("event_id").cast("bigint")
    twice = rows.where(n % 7 == 1).withColumn("object_name", F.lit("batch-2"))
    root = _described(spark, rows.where(n % 7 != 0).unionByName(twice), "ledger-archive")
    path = workspace(spark, "ledger")
    # A document for each ten thousand numbers, so none grows with the table; a line each, in the order of the list.
    texts = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda i: i.cast("string"))
    test_events.groupBy(F.floor(F.col("event_id") / 10_000).alias("number")).agg(
        texts("event_id").alias("all"), texts(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("other")
    ).orderBy("number").select(
        F.lit("00D").alias("orgId"),
        F.create_map(F.lit("/event/Test"), F.col("all"), F.lit("/event/Other"), F.col("other")).alias("streams"),
    ).write.json(path)
    run = verify_archive(spark, root, read_expected_ids(spark, path, per_line=True))
    found = run.gaps.join(run.examples, ["source", "grp"], "left")
    return found.select("grp", "expected", "missing", "duplicates", F.array_join("missing_examples", ",").alias("examples"))


@query("""
    SELECT run, CAST(sum(CASE WHEN event_id % 2 < run THEN 1 ELSE 0 END) AS BIGINT) AS records,
           CAST(sum(CASE WHEN event_id % 2 < run THEN 0 ELSE 1 END) AS BIGINT) AS missing, run = 2 AS ok
    FROM events, (VALUES (1), (2)) v(run) GROUP BY run""")
def verify_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two verifications with a ledger, of half of the events and of all: the second inflates new objects only."""
    test_events = events(spark, sf_dir)
    rows, root, ledger = event_records(test_events), workspace(spark, "again"), workspace(spark, "again-ledger")
    expected = test_events.select(
        F.lit("stream").alias("source"), F.lit("/event/Test").alias("grp"),
        F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("id"),
    )
    lineage = lineage_stream(F.lit("/event/Test"), F.lit(""), F.lit(""))
    runs = []
    for k in range(2):
        part = rows.where(F.col("event_id").cast("bigint") % 2 == k).withColumn("object_name", F.lit(f"half-{k}"))
        archive_units(part, root, meta=object_meta(part, lineage))
        report = verify_archive(spark, root, expected, ledger=ledger).report()
        runs.append(stage(report.select(F.lit(k + 1).alias("run"), "records", "missing", "ok"), "verified"))
    return runs[0].unionByName(runs[1])


@query("""
    SELECT event_type, CAST(count(*) AS BIGINT) AS records, 'manifest_mismatch' AS kind
    FROM events GROUP BY event_type""")
def verify_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests that name no object are findings of their own, and their objects have none."""
    root = _described(spark, event_records(events(spark, sf_dir)), "keyless")
    manifests = stage(read_manifests(spark, root).select("manifest.*"), "manifests")
    put_manifests(manifests, root)  # as they are
    keyless = manifests.select(*[F.lit("").alias(c) if c == "objectKey" else F.col(c) for c in manifests.columns])
    other = workspace(spark, "keyless-other")
    keyless.select(F.to_json(F.struct(*keyless.columns)).alias("value"), F.col("eventType").alias("event_type")).write.partitionBy(
        "event_type"
    ).option("maxRecordsPerFile", 1).text(f"{other}/manifests")
    event_type = F.regexp_extract("manifest_path", r"event_type=([^/]*)", 1).alias("event_type")
    read = stage(read_manifests(spark, other), "keyless")
    found = manifests_without_key(read).withColumnRenamed("key", "manifest_path").select(event_type, "kind").distinct()
    counts = read.groupBy(event_type).agg(F.sum("manifest.recordCount").alias("records"))
    return counts.join(found, "event_type").select("event_type", "records", "kind")


def _overwrite(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False)


@query("""
    SELECT event_type, CASE event_type WHEN 'click' THEN 'unreadable_object' WHEN 'error' THEN 'manifest_without_object'
           WHEN 'login' THEN 'object_without_manifest' WHEN 'purchase' THEN 'unsupported_manifest' END AS kind
    FROM events WHERE event_type IN ('click', 'error', 'login', 'purchase') GROUP BY ALL
    UNION ALL SELECT event_type, kind FROM (SELECT DISTINCT event_type FROM events),
                     (VALUES ('object_without_manifest'), ('unreadable_manifest')) v(kind)
    WHERE event_type NOT IN ('click', 'error', 'login', 'purchase')""")
def verify_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of an archive in which each event type's object or manifest is damaged in its own way."""
    root = _described(spark, event_records(events(spark, sf_dir)), "damaged")
    kind = F.regexp_extract("objectKey", r"event_type=([^/]*)", 1)
    objects = list_objects(spark, root).select(F.col("object_key").alias("objectKey"))
    manifests = read_manifests(spark, root).select("manifest_path", "manifest.objectKey", F.to_json("manifest").alias("text"))
    one = F.min(F.struct("objectKey", "manifest_path", "text")).alias("one")
    # A row for each event type: of its objects one is damaged.
    for r in objects.join(manifests, "objectKey").groupBy(kind.alias("kind")).agg(one).select("kind", "one.*").collect():
        path = f"{raw_root(root).rpartition('/raw')[0]}/{r.objectKey}"
        if r.kind == "click":
            _overwrite(spark, path, "no gzip data")
        elif r.kind == "error":
            _delete(spark, path)
        elif r.kind == "login":
            _delete(spark, r.manifest_path)
        elif r.kind == "purchase":
            _overwrite(spark, r.manifest_path, r.text.replace('"manifestVersion":2', '"manifestVersion":1'))
        else:
            _overwrite(spark, r.manifest_path, "{not json")
    found = sorted_findings(verify_archive(spark, root).findings)
    key = F.regexp_extract("key", r"event_type=([^/]*)", 1)
    return found.select(key.alias("event_type"), "kind").distinct()


@query("""
    WITH w AS (SELECT event_type AS scope, max(epoch_us(ts) // 1000) AS newest FROM events GROUP BY event_type)
    SELECT scope, CAST(CASE WHEN scope = 'click' THEN epoch_ms(TIMESTAMP '2023-12-31') ELSE newest END AS VARCHAR) AS value
    FROM w WHERE scope <> 'error'""")
def state_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks of all event types after one was reset and one was set back for a backfill."""
    state = State(spark, workspace(spark, "state"))
    # A row for each event type.
    newest = events(spark, sf_dir).groupBy("event_type").agg(F.max("ts").alias("t")).collect()
    for r in newest:
        state.set_watermark("main", QUERY, r.event_type, r.t)
    state.reset("main", [r.event_type for r in newest], ["error"], confirm=True)
    state.backfill("main", QUERY, "click", datetime(2023, 12, 31), confirm=True)
    return state.watermarks().select("scope", "value")
