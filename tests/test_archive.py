"""Objects, manifests and verification of small archives, damaged ones included."""

from __future__ import annotations

import glob
import gzip
import hashlib
import json
import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from auditlake.functions.payload import lineage_stream
from auditlake.operators.aggregates import gap_report, missing_examples
from auditlake.operators.joins import missing_ids
from auditlake.plans.compaction import compact_to_parquet
from auditlake.plans.verify import verify_archive
from auditlake.schemas import RECORD
from auditlake.sinks import archive as archive_sink
from auditlake.sinks.archive import archive_units, object_meta, write_archive
from auditlake.sources.api import read_expected_ids
from auditlake.sources.archive import (
    hour_path,
    list_objects,
    object_facts,
    read_archive,
    read_manifests,
    scan_objects,
)

T0 = datetime(2026, 9, 15, 2, 30)


def records(spark, n=10, unit="u1", source="stream", kind="Login", prefix="e", when=T0):
    rows = [
        (f"{prefix}{i}", kind, datetime(2026, 9, 15, 1, i), source, "prod", "00D", "main", None,
         json.dumps({"EventIdentifier": f"{prefix}{i}", "Id": f"{prefix}{i}", "REQUEST_ID": f"{prefix}{i}"}),
         when, unit, None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, RECORD)


def topic_meta(df, topic="/event/T"):
    return object_meta(df, lineage_stream(F.lit(topic), F.lit(""), F.lit("")))


def data_files(root):
    return sorted(glob.glob(f"{root}/raw/**/part-*", recursive=True))


def manifest_files(root):
    return sorted(glob.glob(f"{root}/manifests/**/part-*", recursive=True))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "archive")


def test_layout_and_manifest(spark, root):
    df = records(spark)
    archive_units(df, root, meta=topic_meta(df))
    [path] = data_files(root)
    assert "/raw/source=stream/org_id=00D/event_type=Login/year=2026/month=09/day=15/hour=02/unit=u1/" in path
    [stored] = manifest_files(root)
    manifest = json.loads(Path(stored).read_text())
    body = Path(path).read_bytes()
    assert manifest["sha256"] == hashlib.sha256(body).hexdigest()
    assert manifest["compressedBytes"] == len(body)
    assert manifest["uncompressedBytes"] == len(gzip.decompress(body))
    assert manifest["recordCount"] == 10
    assert manifest["manifestVersion"] == 2
    assert manifest["firstTimestamp"] == "2026-09-15T01:00:00Z"
    assert manifest["lastTimestamp"] == "2026-09-15T01:09:00Z"
    assert manifest["objectKey"] in path
    assert manifest["lineage"]["topic"] == "/event/T"
    assert [r.object_key for r in list_objects(spark, root).collect()] == [manifest["objectKey"]]


def test_rewriting_a_unit_replaces_it(spark, root):
    for n in (10, 4):
        df = records(spark, n)
        archive_units(df, root)
    other = records(spark, 3, unit="u2", prefix="x")
    archive_units(other, root)
    assert read_archive(spark, root).count() == 7
    assert read_manifests(spark, root).count() == 2
    assert verify_archive(spark, root, strict=True).report().head().ok


def test_records_per_object(spark, root):
    df = records(spark, 10)
    archive_units(df, root, records_per_object=4)
    counts = sorted(r.records for r in object_facts(scan_objects(spark, root)).collect())
    assert sum(counts) == 10 and max(counts) <= 4
    assert read_manifests(spark, root).count() == len(counts)


def test_partition_pruning_reaches_the_scan(spark, root):
    for hour in (1, 2):
        write_archive(records(spark, unit=f"u{hour}", when=datetime(2026, 9, 15, hour)), root)
    rows = read_archive(spark, root).where(F.col("part_hour") == "02")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    assert rows.count() == 10
    assert read_archive(spark, root, [hour_path(root, hour="01")]).count() == 10


def test_path_keys_do_not_replace_fields(spark, root):
    df = records(spark, 1, kind="Login Event")
    write_archive(df, root)
    row = read_archive(spark, root).head()
    assert row.event_type == "Login Event"
    assert row.part_event_type.startswith("Login_Event-")


def test_flat_layout_and_large_members(spark, tmp_path):
    """Objects stored directly in the hour folders, several gzip members each."""
    folder = tmp_path / "raw/source=stream/org_id=o/event_type=T/year=2026/month=09/day=15/hour=02"
    folder.mkdir(parents=True)
    line = json.dumps({"event_id": "1", "event_type": "T", "timestamp": "2026-09-15T02:00:00Z", "source": "stream",
                       "payload": {"x": "y" * 1000}}, separators=(",", ":"))
    body = b"".join(gzip.compress((f"{line}\n" * 3000).encode()) for _ in range(3))
    (folder / "1-a.json.gz").write_bytes(body)
    (folder / "1-empty.json.gz").write_bytes(gzip.compress(b""))
    facts = {r.object_key.rsplit("/", 1)[1]: r for r in object_facts(scan_objects(spark, str(tmp_path))).collect()}
    assert facts["1-a.json.gz"].records == 9000
    assert facts["1-a.json.gz"].uncompressed == 9000 * (len(line) + 1)
    assert facts["1-a.json.gz"].error is None
    assert facts["1-empty.json.gz"].records == 0 and facts["1-empty.json.gz"].error is None
    assert facts["1-empty.json.gz"].first_ts is None
    assert read_archive(spark, str(tmp_path), units=False).count() == 9000


def test_zero_timestamps_do_not_stretch_the_range(spark, root):
    df = records(spark, 2).withColumn("timestamp", F.when(F.col("event_id") == "e1", F.col("timestamp")))
    archive_units(df, root)
    manifest = read_manifests(spark, root).select("manifest.*").head()
    assert manifest.recordCount == 2
    assert manifest.firstTimestamp == manifest.lastTimestamp == "2026-09-15T01:01:00Z"
    assert verify_archive(spark, root, strict=True).report().head().ok


# --- verification ------------------------------------------------------------------------


@pytest.fixture
def damaged(spark, root):
    """One good unit, and one for each kind of damage."""
    names = ["good", "changed", "truncated", "garbled", "lost", "orphan", "old", "nokey", "nomanifest", "twice"]
    frames = [records(spark, 5, unit=n, prefix=n) for n in names]
    df = frames[0]
    for other in frames[1:]:
        df = df.unionByName(other)
    archive_units(df, root, meta=topic_meta(df))
    data = lambda n: [f for f in data_files(root) if f"unit={n}/" in f][0]
    manifest = lambda n: [f for f in manifest_files(root) if f"unit={n}/" in f][0]

    def rewrite(path, edit):
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.unlink(crc)
        Path(path).write_bytes(edit(Path(path).read_bytes()))

    lines = lambda b: gzip.decompress(b).splitlines(keepends=True)
    rewrite(data("changed"), lambda b: gzip.compress(b"".join(lines(b)[:-1])))
    rewrite(data("truncated"), lambda b: b[:-12])
    rewrite(data("garbled"), lambda b: gzip.compress(b"".join(lines(b)) + b'{"event_id": oops\n'))
    os.unlink(data("lost"))
    os.unlink(manifest("orphan"))
    edit = lambda n, **kw: rewrite(manifest(n), lambda b: json.dumps({**json.loads(b), **kw}, indent=2).encode())
    edit("old", manifestVersion=1)
    edit("nokey", objectKey="")
    rewrite(manifest("nomanifest"), lambda b: b"{not json")
    twice = Path(manifest("twice"))
    (twice.parent / "part-zzz.txt").write_bytes(twice.read_bytes())
    return root


def test_every_damage_is_found_once(spark, damaged):
    run = verify_archive(spark, damaged)
    found = {}
    for r in run.findings.collect():
        unit = r.key.split("unit=")[1].split("/")[0]
        found.setdefault(unit, []).append((r.kind, r.detail))
    kinds = {u: sorted(k for k, _ in f) for u, f in found.items()}
    assert kinds == {
        "changed": ["manifest_mismatch"],
        "truncated": ["unreadable_object"],
        "garbled": ["unreadable_object"],
        "lost": ["manifest_without_object"],
        "orphan": ["object_without_manifest"],
        "old": ["unsupported_manifest"],
        "nokey": ["manifest_mismatch", "object_without_manifest"],
        "nomanifest": ["object_without_manifest", "unreadable_manifest"],
        "twice": ["manifest_mismatch"],
    }
    detail = found["changed"][0][1]
    assert detail.startswith("lines: 4 found, 5 stated; stored bytes: ")
    assert detail.endswith("another checksum; another time range")
    assert "duplicate objectKey" in found["twice"][0][1]
    report = run.report().head()
    assert not report.ok
    assert (report.objects, report.manifests) == (9, 10)
    # Unreadable and unsupported objects are left out, orphans are counted.
    assert {r.source: r.records for r in run.records_by_source.collect()} == {"stream": 4 + 5 * 5}


def test_orphans_fail_only_when_strict(spark, root):
    df = records(spark)
    write_archive(df, root)
    report = verify_archive(spark, root).report().head()
    assert report.ok and report.object_without_manifest == 1
    assert not verify_archive(spark, root, strict=True).report().head().ok


def test_reconciliation_with_a_ledger(spark, root, tmp_path):
    stream = records(spark, 6, unit="s", prefix="s")
    files = records(spark, 4, unit="f", source="eventlog", prefix="f")
    rows = records(spark, 3, unit="q", source="soql", kind="Audit", prefix="q")
    repeat = records(spark, 2, unit="again", prefix="s")
    limits = records(spark, 2, unit="l", source="limits", kind="Limits", prefix="l")
    for df in (stream, files, rows, repeat, limits):
        archive_units(df, root, meta=topic_meta(df))
    ledger = {
        "orgId": "00D",
        "streams": {"/event/T": ["s5", "s9", "s0", "s8"], "/event/Other": ["o1"]},
        "eventLogFiles": {"a": ["f0", "f1"], "b": ["f2", "f3", "f4"]},
        "customRecords": {"Audit": ["q0", "q1", "q2"]},
    }
    path = tmp_path / "ledger.json"
    path.write_text(json.dumps(ledger, indent=1))
    run = verify_archive(spark, root, read_expected_ids(spark, str(path)))
    gaps = {(r.source, r.grp): (r.expected, r.archived_unique, r.missing, r.duplicates) for r in run.gaps.collect()}
    assert gaps == {
        ("stream", "/event/T"): (4, 6, 2, 2),
        ("stream", "/event/Other"): (1, 0, 1, 0),
        ("eventlog", ""): (5, 4, 1, 0),
        ("soql", "Audit"): (3, 3, 0, 0),
    }
    examples = {r.grp: r.missing_examples for r in run.examples.collect()}
    assert examples == {"/event/T": ["s8", "s9"], "/event/Other": ["o1"], "": ["f4"]}
    report = run.report().head()
    assert report.missing == 4 and not report.ok


class Writer:
    """Takes the calls of a DataFrameWriter and notes how many files a task may hold open."""

    def __init__(self, spark):
        self.spark, self.open_files = spark, None

    def mode(self, _):
        return self

    def option(self, *_):
        return self

    def text(self, _):
        self.open_files = self.spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")


def test_rows_of_an_archive_are_not_sorted_by_folder(spark, root):
    writer = Writer(spark)
    archive_sink._replace_folders(spark, writer, root)
    assert writer.open_files == str(archive_sink.OPEN_FILES)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_more_folders_than_open_files(spark, root):
    many = archive_sink.OPEN_FILES + 8
    kinds = F.concat(F.lit("T"), (F.col("event_id").substr(2, 9).cast("int") % many).cast("string"))
    events = spark.range(5 * many).select(F.concat(F.lit("s"), "id").alias("event_id"))
    df = events.crossJoin(records(spark, 1).drop("event_id")).withColumn("object_type", kinds).coalesce(1)
    write_archive(df, root, records_per_object=2)
    found = read_archive(spark, root).groupBy("part_event_type").count().collect()
    assert len(found) == many and {r["count"] for r in found} == {5}
    assert len(glob.glob(f"{root}/raw/**/*.gz", recursive=True)) == 3 * many


def test_units_of_a_write_are_found_once(spark, root):
    df = records(spark, 6, unit="u", prefix="s")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    meta = topic_meta(df)
    archive_units(df, root, meta=meta.mapInArrow(count, meta.schema))
    assert seen.value == 1


def test_ledger_of_several_documents(spark, tmp_path):
    """A document per line: each is read, and the first missing ids are those of the first documents."""
    ledger = [{"orgId": "00D", "streams": {"/event/T": [f"{k}{i}" for i in range(8)]}} for k in "cab"]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "1.json").write_text("\n".join(json.dumps(d) for d in ledger[:2]) + "\n")
    (tmp_path / "lines" / "2.json").write_text(json.dumps(ledger[2]))
    seen = spark.createDataFrame([], "source string, grp string, id string, n long")
    expected = read_expected_ids(spark, str(tmp_path / "lines"), per_line=True)
    row = gap_report(expected, seen).head()
    assert (row.expected, row.missing) == (24, 24)
    found = missing_examples(missing_ids(expected, seen)).head().missing_examples
    assert found == ["a0", "a1", *(f"c{i}" for i in range(8))]
    (tmp_path / "several.json").write_text("\n".join(json.dumps(d, indent=1) for d in ledger))
    with pytest.raises(Exception, match="MALFORMED"):
        read_expected_ids(spark, str(tmp_path / "several.json")).collect()
    (tmp_path / "array.json").write_text(json.dumps(ledger, indent=1))
    assert read_expected_ids(spark, str(tmp_path / "array.json")).count() == 24


def test_gap_report_of_the_fixture(spark):
    expected = spark.createDataFrame([("s", "g", i, x) for i, x in enumerate("abc")], "source string, grp string, ord int, id string")
    seen = spark.createDataFrame([("s", "g", "a", 1), ("s", "g", "b", 3)], "source string, grp string, id string, n long")
    row = gap_report(expected, seen).head()
    assert (row.expected, row.archived_unique, row.missing, row.duplicates) == (3, 2, 1, 2)
    assert missing_examples(missing_ids(expected, seen)).head().missing_examples == ["c"]


def test_first_ten_missing_in_list_order(spark):
    rows = [("s", "g", i, f"id{99 - i}") for i in range(30)]
    expected = spark.createDataFrame(rows, "source string, grp string, ord int, id string")
    got = missing_examples(expected).head().missing_examples
    assert got == sorted(f"id{99 - i}" for i in range(10))


def test_compaction_by_event_date(spark, root, tmp_path):
    out = str(tmp_path / "curated")
    write_archive(records(spark, 5, unit="a"), root)
    write_archive(records(spark, 5, unit="b"), root)
    write_archive(records(spark, 2, unit="c", prefix="k").withColumn("event_id", F.lit("")), root)
    for _ in range(2):
        compact_to_parquet(spark, root, out)
    got = spark.read.parquet(out)
    assert got.count() == 7
    assert os.path.isdir(f"{out}/event_date=2026-09-15/event_type=Login")


def test_worker_functions_travel_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from auditlake.sources.archive import _split_objects

    (tmp_path / "fn.pkl").write_bytes(cloudpickle.dumps(_split_objects))
    code = "import pickle, pyspark; print(pickle.load(open('fn.pkl', 'rb')).__name__)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.strip() == "_split_objects", done.stderr


def test_a_day_reads_the_hours_around_it_only(spark, root):
    from auditlake.operators.filters import partition_filter
    from auditlake.operators.records import timeline
    from auditlake.sources.archive import read_archive

    days = [records(spark, 2, unit=f"d{d}", prefix=f"d{d}-") for d in range(8)]
    for d, df in enumerate(days):
        at = F.lit(datetime(2027, 5, 1 + d, 6)).cast("timestamp")
        write_archive(df.withColumn("partition_time", at).withColumn("timestamp", at), root)
    day = partition_filter(read_archive(spark, root), datetime(2027, 5, 4), datetime(2027, 5, 5))
    assert len(day.select("object_key").distinct().collect()) == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(k in filters for k in ("year", "month", "day", "hour"))
    assert day.count() == 2
    user = timeline(read_archive(spark, root), datetime(2027, 5, 4), "x", F.lit("x"))
    assert user.count() == 2


def test_a_timeline_has_events_that_arrived_late(spark, root):
    from auditlake.operators.records import timeline
    from auditlake.sources.archive import read_archive

    happened = F.lit(datetime(2027, 5, 4, 6)).cast("timestamp")
    for name, arrived in (("soon", datetime(2027, 5, 4, 7)), ("backfill", datetime(2027, 6, 20, 6))):
        df = records(spark, 2, unit=name, prefix=f"{name}-").withColumn("timestamp", happened)
        write_archive(df.withColumn("partition_time", F.lit(arrived).cast("timestamp")), root)
    rows = read_archive(spark, root)
    assert timeline(rows, datetime(2027, 5, 4), "x", F.lit("x")).count() == 4
    assert timeline(rows, datetime(2027, 5, 4), "x", F.lit("x"), slack_hours=24).count() == 2


def _compacted(spark, out):
    rows = spark.read.parquet(out).select("event_id", "org_id", F.col("event_date").cast("string").alias("day"))
    return sorted((r.event_id, r.org_id, r.day) for r in rows.collect())


def test_update_of_the_copy_reads_new_folders_only(spark, root, tmp_path, monkeypatch):
    from auditlake.plans import compaction

    out, seen = str(tmp_path / "curated"), []
    original = compaction.read_archive

    def reading(spark, root, paths=None, units=True):
        seen.append(paths)
        return original(spark, root, paths, units)

    monkeypatch.setattr(compaction, "read_archive", reading)
    write_archive(records(spark, 5, unit="a"), root)
    write_archive(records(spark, 2, unit="blank").withColumn("event_id", F.lit("")), root)
    write_archive(records(spark, 3, unit="other", prefix="x").withColumn("timestamp", F.lit(datetime(2026, 1, 2)).cast("timestamp")), root)
    assert compaction.update_copy(spark, root, out) == 3 and seen == [None]
    assert compaction.update_copy(spark, root, out) == 0 and seen == [None]
    old = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/event_date=2026-01-02/**/part-*", recursive=True)}
    # Repeats of old ids, new ids on an old date, a new date, and a record without a time.
    write_archive(records(spark, 8, unit="b"), root)
    write_archive(records(spark, 1, unit="c", prefix="n").withColumn("timestamp", F.lit(None).cast("timestamp")), root)
    assert compaction.update_copy(spark, root, out) == 2
    assert sorted(p.rpartition("unit=")[2] for p in seen[-1]) == ["b", "c"]
    # A date without news is not written again.
    assert {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/event_date=2026-01-02/**/part-*", recursive=True)} == old
    # A unit that is written again with other records takes the place of its rows.
    write_archive(records(spark, 2, unit="other", prefix="y").withColumn("timestamp", F.lit(datetime(2026, 1, 3)).cast("timestamp")), root)
    assert compaction.update_copy(spark, root, out) == 1
    got = [e for e, _, _ in _compacted(spark, out)]
    assert got == ["", "", *[f"e{i}" for i in range(8)], "n0", "y0", "y1"]
    # An update that was cut off is made good from the whole archive.
    os.makedirs(f"{out}-objects-pending")
    want = _compacted(spark, out)
    assert compaction.update_copy(spark, root, out) == 5 and seen[-1] is None
    assert _compacted(spark, out) == want
    assert not os.path.exists(f"{out}-objects-pending")


@pytest.mark.parametrize("ledgers", [False, True])
def test_second_verification_reads_new_objects_only(spark, root, tmp_path, monkeypatch, ledgers):
    from auditlake.plans import verify

    seen, notes = [], str(tmp_path / "notes")
    original = verify.scan_objects

    def scanning(spark, root, paths=None, **how):
        seen.append(paths)
        return original(spark, root, paths, **how)

    monkeypatch.setattr(verify, "scan_objects", scanning)
    ids = [f"e{i}" for i in range(9)] if ledgers else None
    expected = spark.createDataFrame([("stream", "/event/T", i, v) for i, v in enumerate(ids)], "source string, grp string, ord int, id string") if ids else None
    for k, unit in enumerate(("a", "b")):
        df = records(spark, 3, unit=unit, prefix="e").withColumn("event_id", F.concat(F.lit(unit), "event_id"))
        archive_units(df, root, meta=topic_meta(df))
        run = verify_archive(spark, root, expected, ledger=notes)
        plain = verify_archive(spark, root, expected)
        assert run.report().head() == plain.report().head()
        assert seen[-2] is None if k == 0 else [p.rpartition("unit=")[2] for p in seen[-2]] == ["b"]
    calls = len(seen)
    verify_archive(spark, root, expected, ledger=notes).report().collect()
    assert len(seen) == calls  # nothing is read again
    # An object that changed is, and one that is gone is missed.
    first, second = data_files(root)
    for name in (first, second):  # Hadoop's checksums of local files
        Path(name).with_name(f".{Path(name).name}.crc").unlink()
    Path(first).write_bytes(b"no gzip data at all")
    os.unlink(second)
    found = {(r.kind, r.key.rpartition("unit=")[2][:1]) for r in verify_archive(spark, root, expected, ledger=notes).findings.collect()}
    assert found == {("unreadable_object", "a"), ("manifest_without_object", "b")}


def test_an_object_too_large_to_be_read_is_a_finding(spark, root, monkeypatch):
    from auditlake.sources import archive

    small, large = records(spark, 1, unit="small"), records(spark, 40, unit="large").withColumn("payload_json", F.format_string('{"x":"%s"}', F.sha2("event_id", 512)))
    for df in (small, large):
        archive_units(df, root, meta=topic_meta(df))
    sizes = {f.rpartition("unit=")[2][:5]: os.path.getsize(f) for f in data_files(root)}
    monkeypatch.setattr(archive, "MAX_OBJECT_BYTES", sizes["large"] - 1)
    row = verify_archive(spark, root).findings.head()
    assert (row.kind, row.detail) == ("unreadable_object", f"too large to be read: bytes {sizes['large']}")
    assert "unit=large" in row.key


def test_failure_counters_stay_few_files(spark, tmp_path):
    from auditlake.state import CHANGES_KEPT, State

    state = State(spark, str(tmp_path / "state"))
    want = {}
    for i in range(2 * CHANGES_KEPT + 5):
        key, n = f"k{i % 7}", i % 4
        state.set_attempts(spark.createDataFrame([(key, n)], "key string, n int"), "main", "malformed")
        want[key] = n
    got = {r.key: r.n for r in state.attempts("main", "malformed").collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert len(os.listdir(state.path("attempts", "main", "malformed"))) <= 2 * CHANGES_KEPT + 4


def test_one_users_day_reads_few_rows_of_the_copy(spark, root, tmp_path):
    """Files are sorted by user: only the pages that can hold one are read."""
    from auditlake.plans.compaction import copy_timeline, member

    out, n = str(tmp_path / "curated"), 20_000
    rows = spark.range(n).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("Login").alias("event_type"),
        F.lit(datetime(2026, 9, 15, 1)).cast("timestamp").alias("timestamp"), F.lit("stream").alias("source"),
        F.lit("prod").alias("env"), F.lit("00D").alias("org_id"), F.lit("main").alias("instance"),
        F.lit(None).cast("string").alias("replay_id"),
        F.format_string('{"USER_ID":"u%d","at":{"place":[%d,2]}}', F.pmod("id", F.lit(500)), F.col("id")).alias("payload_json"),
        F.lit(T0).cast("timestamp").alias("partition_time"), F.lit("unit").alias("object_name"), F.lit(None).cast("string").alias("object_type"),
    )
    write_archive(rows, root)
    spark.conf.set("parquet.page.size.row.count.limit", "500")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.row.count.limit", "500")
    try:
        compact_to_parquet(spark, root, out)
    finally:
        spark.conf.unset("parquet.page.size.row.count.limit")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.page.row.count.limit")
    day = copy_timeline(spark, out, datetime(2026, 9, 15), "u77")
    assert day.count() == n // 500
    found = day.select("event_id", member("$.at.place[0]", "bigint").alias("p"), member("$.at.none", "bigint").alias("q"))
    found.write.format("noop").mode("overwrite").save()
    rows = found.collect()
    assert all(r.p == int(r.event_id[1:]) and r.q is None for r in rows)

    def scans(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(plan.plan())
        if "Scan" in name:
            return [plan.metrics().apply("numOutputRows").value()]
        kids = plan.children()
        return [m for i in range(kids.size()) for m in scans(kids.apply(i))]

    executed = found._jdf.queryExecution().executedPlan()
    found._jdf.collectToPython()
    read = sum(scans(executed))
    assert 0 < read <= n / 5
    nobody = copy_timeline(spark, out, datetime(2026, 9, 15), "v1")
    assert nobody.count() == 0


def test_lines_are_counted_without_a_sort(spark, root):
    from auditlake.operators.aggregates import line_ref
    from auditlake.sources.archive import describe_stored

    write_archive(records(spark), root)
    for counted in (describe_stored(spark, root), scan_objects(spark, root), scan_objects(spark, root, line_ref=line_ref)):
        # Below the shuffle are lines, above it counters of objects.
        by_line = counted._jdf.queryExecution().executedPlan().toString().rsplit("Exchange", 1)[-1]
        assert "MapInArrow" in by_line and "Sort" not in by_line


def test_a_damaged_object_is_described_by_one_row(spark, root):
    from auditlake.sources.archive import describe_stored

    write_archive(records(spark, 50), root)
    [path] = data_files(root)
    Path(path).with_name(f".{Path(path).name}.crc").unlink()
    Path(path).write_bytes(Path(path).read_bytes()[:-40])
    [facts] = describe_stored(spark, root).collect()
    assert facts.error and facts.compressed == os.path.getsize(path)
    assert facts.records == sum(r.records for r in object_facts(scan_objects(spark, root)).collect())


def test_heads_leave_out_payloads_only():
    from auditlake.sources.archive import _line_batches

    lines = [b'{"event_type":"\xc3\xa9","payload":{"payload":1}}', b"no key", b"", b'{"payload":']
    rows = [list(_line_batches("k", memoryview(gzip.compress(b"\n".join(lines))), heads)) for heads in (True, False)]
    heads, whole = ([r for b in batches for r in b.to_pylist()][:-1] for batches in rows)
    assert [r["line"] for r in heads] == [b'{"event_type":"\xc3\xa9","payload":', b"no key", b"", b'{"payload":']
    assert [r["line"] for r in whole] == lines
    assert [r["head"] for r in heads] == [r["head"] for r in whole] == [b'{"event_type":"\xc3\xa9",', b"no key", b"", b"{"]


def test_content_goes_to_python_in_pieces(spark, root, monkeypatch):
    from auditlake.sources import archive

    write_archive(records(spark, 60), root)
    [path] = data_files(root)
    whole = object_facts(scan_objects(spark, root)).collect()
    Path(path).with_name("damaged.txt.gz").write_bytes(Path(path).read_bytes()[:-40])
    monkeypatch.setattr(archive, "PIECE_BYTES", 16)
    found = {r.object_key.rpartition("/")[2]: r for r in object_facts(scan_objects(spark, root)).collect()}
    assert found[os.path.basename(path)] == whole[0] and whole[0].records == 60
    assert found["damaged.txt.gz"].error
    assert found["damaged.txt.gz"].compressed == os.path.getsize(path) - 40


def test_a_frame_without_rows_starts_no_python(spark):
    from auditlake.session import empty

    frame = empty(spark, "a string, b struct<c: int>")
    assert frame.schema.simpleString() == "struct<a:string,b:struct<c:int>>" and frame.count() == 0
    assert "RDD" not in frame._jdf.queryExecution().executedPlan().toString()


def test_repeats_are_dropped_behind_the_shuffle(spark, root):
    from auditlake.plans.compaction import curated_rows

    write_archive(records(spark), root)
    plan = curated_rows(read_archive(spark, root))._jdf.queryExecution().executedPlan().toString()
    # In front of the shuffle a task reads whole objects; it must not sort their lines.
    assert plan.count("Exchange") == 1 and "Sort" not in plan.rsplit("Exchange", 1)[-1]
