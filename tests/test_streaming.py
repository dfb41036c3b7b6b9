"""Topic streams: crashes, restarts, positions and de-duplication."""

from __future__ import annotations

import json
import os
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from auditlake.functions.times import ts_lit
from auditlake.plans.verify import verify_archive
from auditlake.operators.joins import attach_schema
from auditlake.sources.archive import read_archive, read_manifests
from auditlake.streaming.flushes import in_flushes
from auditlake.streaming.progress import ProgressTable, live_freshness, read_progress
from auditlake.streaming.retention import OutsideRetentionError, pending_files
from auditlake.streaming.topics import (
    EARLIEST,
    LATEST,
    NoCheckpointError,
    Topic,
    archive_stream,
    decode_topic,
    dedup_stream,
    event_records,
    read_event_stream,
    run_topics,
    start_position,
)

TOPIC = Topic("/event/Login", "main", "00D", "prod")
SCHEMA = (
    "replay_id binary, schema_name string, payload struct<EventUuid:string, EventIdentifier:string,"
    " EventDate:bigint, CreatedDate:bigint, Score:double, Sequence:bigint>"
)


class Landing:
    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0
        path.mkdir()

    def land(self, n: int, kind: str = "Login") -> list[str]:
        rows, ids = [], []
        for i in range(self.n, self.n + n):
            ids.append(f"u{i}")
            rows.append(
                (bytearray(i.to_bytes(8, "big")), f"org.{kind}", (f"u{i}", f"i{i}", 1789434123004 + i, 1, (i % 100) / 10, None))
            )
        self.n += n
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return ids


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "landing")


@pytest.fixture
def where(tmp_path):
    return str(tmp_path / "archive"), str(tmp_path / "checkpoint")


def run(spark, landing, where, after_write=None, initial=None, start=EARLIEST, max_files=1, topic=TOPIC):
    stream = read_event_stream(spark, landing.path, SCHEMA, start, "parquet", max_files, checkpoint=where[1])
    query = archive_stream(stream, topic, *where, initial=initial, once=True, report=after_write)
    query.awaitTermination()
    return query


def archived(spark, where):
    return sorted(r.event_id for r in read_archive(spark, where[0]).collect())


def test_records_and_lineage(spark, landing, where):
    landing.land(3)
    run(spark, landing, where, initial=EARLIEST)
    rows = sorted(read_archive(spark, where[0]).collect(), key=lambda r: r.event_id)
    first = rows[0]
    assert (first.event_id, first.event_type, first.replay_id) == ("u0", "Login", "AAAAAAAAAAA=")
    assert first.timestamp == datetime(2026, 9, 15, 1, 2, 3, 4000)
    assert json.loads(first.payload) == {
        "EventUuid": "u0", "EventIdentifier": "i0", "EventDate": 1789434123004, "CreatedDate": 1, "Score": 0.0,
        "Sequence": None,
    }
    manifest = read_manifests(spark, where[0]).select("manifest.*").head()
    assert dict(manifest.lineage) == {
        "topic": "/event/Login", "replayIdFirst": "AAAAAAAAAAA=", "replayIdLast": "AAAAAAAAAAI=",
    }


def test_batches_are_measured_as_they_flow(spark, landing, where):
    landing.land(3)
    landing.land(4)
    seen = {}
    run(spark, landing, where, seen.__setitem__, initial=EARLIEST)
    assert [seen[b]["records"] for b in sorted(seen)] == [3, 4]
    assert seen[1]["newest_event"] == datetime(2026, 9, 15, 1, 2, 3, 10_000)
    assert seen[1]["without_id"] == 0


def test_start_needs_a_decision(spark, landing, where):
    landing.land(2)
    with pytest.raises(NoCheckpointError):
        run(spark, landing, where)
    with pytest.raises(ValueError):
        start_position(spark, where[1], "MIDDLE")
    run(spark, landing, where, initial=EARLIEST)
    assert start_position(spark, where[1], None) == "STORED"
    landing.land(2)
    run(spark, landing, where)
    assert archived(spark, where) == ["u0", "u1", "u2", "u3"]


def test_latest_passes_over_what_is_there_and_nothing_else(spark, landing, where):
    landing.land(2)
    with pytest.raises(ValueError):
        read_event_stream(spark, landing.path, SCHEMA, LATEST, "parquet")
    for _ in range(3):  # the same settings at each start, with events landing in between
        run(spark, landing, where, initial=LATEST, start=LATEST)
        landing.land(2)
    run(spark, landing, where)
    assert archived(spark, where) == ["u2", "u3", "u4", "u5", "u6", "u7"]


def _renamed_in(landing, tmp_path, age_days):
    """A file written now and renamed into the folder later, with a time that lies in the past."""
    side = Landing(landing.spark, tmp_path / f"side{age_days}")
    side.n = landing.n
    ids = side.land(2)
    landing.n = side.n
    (found,) = (tmp_path / f"side{age_days}").glob("part-*.parquet")
    then = time.time() - age_days * 86_400
    os.utime(found, (then, then))
    return ids, lambda: found.rename(tmp_path / "landing" / f"late-{age_days}.parquet")


def test_latest_keeps_files_that_are_renamed_in_later(spark, landing, where, tmp_path):
    landing.land(2)
    found = [_renamed_in(landing, tmp_path, age) for age in (0, 20, 400)]
    landing.land(2)
    run(spark, landing, where, initial=LATEST, start=LATEST)
    want = []
    for ids, rename in found:
        rename()
        want += ids
        run(spark, landing, where, initial=LATEST, start=LATEST)
    want += landing.land(2)
    run(spark, landing, where)
    assert archived(spark, where) == sorted(want)


def test_latest_takes_another_file_under_an_old_path(spark, landing, where, tmp_path):
    landing.land(2)
    run(spark, landing, where, initial=LATEST, start=LATEST)
    ids, rename = _renamed_in(landing, tmp_path, 3)
    (old,) = (tmp_path / "landing").glob("part-*.parquet")
    old.unlink()
    old.with_name(f".{old.name}.crc").unlink()
    rename()
    (tmp_path / "landing" / "late-3.parquet").rename(old)
    other = str(tmp_path / "other-checkpoint")
    # The list of the first start, taken up by another checkpoint that has read nothing yet.
    (tmp_path / "checkpoint-latest").rename(f"{other}-latest")
    run(spark, landing, (where[0], other), initial=LATEST, start=LATEST)
    assert archived(spark, where) == ids


def test_latest_holds_when_the_first_batch_is_repeated(spark, landing, where):
    def fail(*_):
        raise RuntimeError("killed")

    landing.land(2)
    read_event_stream(spark, landing.path, SCHEMA, LATEST, "parquet", checkpoint=where[1])  # decides the cut
    landing.land(2)
    with pytest.raises(Exception, match="killed"):
        run(spark, landing, where, fail, initial=LATEST, start=LATEST)
    run(spark, landing, where, initial=LATEST, start=LATEST)
    assert archived(spark, where) == ["u2", "u3"]


def test_position_is_found_after_old_offsets_are_deleted(spark, landing, where):
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        ids = [i for _ in range(6) for i in landing.land(1)]
        run(spark, landing, where, initial=EARLIEST)
        ids += landing.land(1)
        run(spark, landing, where)
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
    assert archived(spark, where) == sorted(ids)


def test_runs_of_one_topic_replace_nothing_of_each_other(spark, landing, where, tmp_path):
    ids = landing.land(2)
    run(spark, landing, where, initial=EARLIEST)
    other, again = Landing(spark, tmp_path / "other"), Landing(spark, tmp_path / "again")
    other.n, again.n = 100, 200
    ids += other.land(1) + again.land(1)
    run(spark, other, (where[0], str(tmp_path / "two")), initial=EARLIEST, topic=Topic("/event/Login", "two", "00D", "prod"))
    run(spark, again, (where[0], str(tmp_path / "new")), initial=EARLIEST)
    assert archived(spark, where) == sorted(ids)
    assert verify_archive(spark, where[0], strict=True).report().head().ok


def test_idle_run_leaves_a_usable_position(spark, landing, where):
    ids = landing.land(2)
    for _ in range(2):
        run(spark, landing, where, initial=EARLIEST)
    ids += landing.land(1)
    run(spark, landing, where)
    assert archived(spark, where) == sorted(ids)


@pytest.mark.parametrize("fault", ["before_objects", "between", "after_manifests"])
@pytest.mark.parametrize("batch", [0, 2])
def test_crash_loses_and_doubles_nothing(spark, landing, where, monkeypatch, fault, batch):
    from auditlake.streaming import topics as sink

    ids = [i for _ in range(4) for i in landing.land(25)]
    calls = {"n": -1}

    def failing(original, when):
        def call(*args, **kwargs):
            calls["n"] += 1
            if calls["n"] == batch:
                raise RuntimeError("killed")
            return original(*args, **kwargs)

        return call

    after = None
    if fault == "before_objects":
        monkeypatch.setattr(sink, "write_archive", failing(sink.write_archive, batch))
    elif fault == "between":
        monkeypatch.setattr(sink, "write_manifests", failing(sink.write_manifests, batch))
    else:
        after = failing(lambda *_: None, batch)
    with pytest.raises(Exception, match="killed"):
        run(spark, landing, where, after, initial=EARLIEST)
    monkeypatch.undo()
    run(spark, landing, where)
    assert archived(spark, where) == sorted(ids)
    assert verify_archive(spark, where[0], strict=True).report().head().ok


def test_repeated_random_faults(spark, landing, where):
    rng = random.Random(11)
    ids: list[str] = []

    def maybe(*_):
        if rng.random() < 0.4:
            raise RuntimeError("chaos")

    failures = 0
    for round_ in range(8):
        ids += landing.land(rng.randint(1, 30), rng.choice(["Login", "Api"]))
        try:
            run(spark, landing, where, maybe, initial=EARLIEST)
        except Exception:
            failures += 1
    run(spark, landing, where, initial=EARLIEST)
    assert failures
    assert archived(spark, where) == sorted(ids)


def test_undecodable_event_stops_the_stream(spark, tmp_path, where):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text('{"schema_name":"a.B","payload":{"EventUuid":"u1"}}\n{"payload": oops\n')
    stream = read_event_stream(spark, str(folder), SCHEMA, fmt="json")
    query = archive_stream(stream, TOPIC, *where, initial=EARLIEST, once=True)
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|Malformed"):
        query.awaitTermination()


def test_unknown_schema_stops_the_job(spark):
    events = spark.createDataFrame([("s1",), ("s2",)], "schema_id string")
    schemas = spark.createDataFrame([("s1", "a.B")], "schema_id string, schema_name string")
    with pytest.raises(Exception, match="no schema is known by the id s2"):
        attach_schema(events, schemas).collect()


def test_first_failing_topic_stops_the_others(spark, tmp_path):
    good, bad = Landing(spark, tmp_path / "good"), Landing(spark, tmp_path / "bad")
    good.land(1)
    bad.land(1)

    def boom(*_):
        raise RuntimeError("topic broke")

    def start(name, landing, after):
        stream = read_event_stream(spark, landing.path, SCHEMA, fmt="parquet")
        return lambda: archive_stream(
            stream, Topic(name, "main", "00D"), str(tmp_path / "root"), str(tmp_path / f"ck-{landing.path[-4:]}"),
            initial=EARLIEST, flush_seconds=1, report=after,
        )

    with pytest.raises(Exception, match="topic broke"):
        run_topics(spark, [start("/event/Good", good, None), start("/event/Bad", bad, boom)])
    assert not spark.streams.active


def _deduplicated(spark, src, out, checkpoint, delay):
    stream = spark.readStream.schema("event_id string, happened int, arrival timestamp").option("maxFilesPerTrigger", 1)
    query = (
        dedup_stream(stream.parquet(src), delay)
        .writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return [p["stateOperators"][0] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]]


def test_stream_dedup(spark, tmp_path):
    """Files and events of any age, also 20 days behind those before: the first of an id passes."""
    src, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    # (id, day it happened, day its file has), a file and so a batch for each
    rows = [("a", 30, 20), ("", 1, 20), ("", 1, 20), ("b", 2, 21), ("a", 30, 21), ("c", 1, 1), ("", 3, 1), ("d", 9, 22), ("c", 1, 22)]
    dropped = 0
    for day in (20, 21, 1, 22):
        df = spark.createDataFrame([r for r in rows if r[2] == day], "event_id string, happened int, day int")
        arrival = ts_lit(datetime(2026, 1, 1)) + F.make_dt_interval(days=F.col("day") - 1)
        df.withColumn("arrival", arrival).drop("day").coalesce(1).write.mode("append").parquet(src)
        for state in _deduplicated(spark, src, out, checkpoint, "7 days"):
            dropped += state["numRowsDroppedByWatermark"]
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["", "", "", "a", "b", "c", "d"]
    assert dropped == 0


def test_dedup_state_is_dropped_after_the_horizon(spark, tmp_path):
    src, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")

    def land(*ids):
        rows = [(i, 1, datetime(2026, 1, 1)) for i in ids]
        spark.createDataFrame(rows, "event_id string, happened int, arrival timestamp").coalesce(1).write.mode("append").parquet(src)
        return _deduplicated(spark, src, out, checkpoint, "1 second")

    land("a", "b")
    time.sleep(2)
    land("c")  # moves the horizon over the first two
    states = land("a")
    assert states[-1]["numRowsTotal"] <= 2
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "a", "b", "c"]


def test_broker_rows_become_records(spark):
    good = json.dumps({"schema_name": "org.Login", "payload": {"EventUuid": "u1", "EventDate": 1789434123004, "Score": 1.5}})
    broker = "value string, partition int, offset long, timestamp timestamp, timestampType int"
    rows = spark.createDataFrame([(good, 3, 41, datetime(2027, 5, 1, 6), 1)], broker)
    schema = SCHEMA.partition(", ")[2]
    row = event_records(decode_topic(rows, schema), TOPIC, "unit").head()
    assert (row.event_id, row.event_type, row.partition_time) == ("u1", "Login", datetime(2027, 5, 1, 6))
    assert row.replay_id == "Mzo0MQ==" and json.loads(row.payload_json)["Score"] == 1.5
    # A producer's time is no arrival.
    produced = decode_topic(rows.withColumn("timestampType", F.lit(0)), schema).select("*", F.current_timestamp().alias("now")).head()
    assert produced.arrival == produced.now and produced.broker_time == datetime(2027, 5, 1, 6)
    bad = rows.withColumn("value", F.lit("{oops"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|Malformed"):
        event_records(decode_topic(bad, schema), TOPIC, "unit").collect()


def test_flushes_hold_so_many_events_in_order(spark, landing, where):
    ids = landing.land(25) + landing.land(3)
    events = read_event_stream(spark, landing.path, SCHEMA, fmt="parquet", max_files=2)
    archive_stream(events, TOPIC, *where, initial=EARLIEST, once=True, flush_events=10).awaitTermination()
    rows = read_archive(spark, where[0]).groupBy("part_unit").agg(F.collect_set("event_id").alias("ids")).collect()
    found = [sorted(r.ids, key=lambda i: int(i[1:])) for r in sorted(rows, key=lambda r: r.part_unit)]
    # Two files of one moment may come either way round; inside a file the order is kept.
    assert [len(f) for f in found] == [10, 10, 8]
    assert sorted(i for f in found for i in f) == sorted(ids)
    assert verify_archive(spark, where[0], strict=True).report().head().ok
    ranges = read_manifests(spark, where[0]).select("manifest.lineage", "manifest.recordCount").collect()
    assert sorted(r.recordCount for r in ranges) == [8, 10, 10]
    assert len({r.lineage["replayIdFirst"] for r in ranges}) == 3


def test_repeated_batch_has_the_same_flushes(spark, landing, where):
    def fail(*_):
        raise RuntimeError("killed")

    ids = landing.land(23)

    def start(report=None):
        events = read_event_stream(spark, landing.path, SCHEMA, fmt="parquet")
        archive_stream(events, TOPIC, *where, initial=EARLIEST, once=True, flush_events=4, report=report).awaitTermination()

    with pytest.raises(Exception, match="killed"):
        start(fail)
    first = {(r.part_unit, r.event_id) for r in read_archive(spark, where[0]).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        start()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.part_unit, r.event_id) for r in read_archive(spark, where[0]).collect()} == first
    assert archived(spark, where) == sorted(ids)
    with pytest.raises(ValueError):
        in_flushes(spark.range(1), 0)


def test_removed_file_of_an_unfinished_batch_stops_the_start(spark, landing, where, tmp_path):
    def fail(*_):
        raise RuntimeError("killed")

    def start(report=None):
        events = read_event_stream(spark, landing.path, SCHEMA, fmt="parquet", max_files=1)
        query = archive_stream(events, TOPIC, *where, initial=EARLIEST, once=True, report=report, landing=landing.path)
        query.awaitTermination()

    ids = landing.land(2)
    start()
    (done,) = (tmp_path / "landing").glob("part-*.parquet")
    ids += landing.land(2)
    with pytest.raises(Exception, match="killed"):
        start(fail)
    done.unlink()  # archived and committed: nobody misses it
    (pending,) = (tmp_path / "landing").glob("part-*.parquet")
    aside = pending.rename(tmp_path / "aside")
    with pytest.raises(OutsideRetentionError, match="1 landed file"):
        start()
    assert pending_files(spark, where[1]).count() == 1
    aside.rename(pending)
    start()
    start()
    assert pending_files(spark, where[1]).count() == 0
    assert archived(spark, where) == sorted(ids)


def test_live_measures(spark, landing, where, tmp_path):
    folder = str(tmp_path / "progress")
    assert read_progress(spark, folder).count() == 0
    table = ProgressTable(spark, folder)
    spark.streams.addListener(table)
    try:
        landing.land(3)
        landing.land(4)
        run(spark, landing, where, table.report("login"), initial=EARLIEST)

        def fail(*_):
            raise RuntimeError("killed")

        landing.land(1)
        with pytest.raises(Exception, match="killed"):
            run(spark, landing, where, fail)
        for _ in range(100):
            rows = read_progress(spark, folder).collect()
            if sum(r.kind == "ended" for r in rows) == 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(table)
    assert sum(r.kind == "batch" and r.records > 0 for r in rows) >= 2
    assert [r.error is not None for r in rows if r.kind == "ended"].count(True) == 1
    row = live_freshness(read_progress(spark, folder), datetime(2026, 9, 15, 1, 2, 13)).head()
    assert (row.name, row.batches, row.records, row.state) == ("login", 2, 7, "ok")
    assert row.newest_event == datetime(2026, 9, 15, 1, 2, 3, 10_000) and row.age_seconds == 10
