"""Polls over landed files and pages: order, failures, overlaps and state."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from auditlake.operators.filters import event_types_in, in_window, select_fields
from auditlake.plans.polls import (
    Collector,
    LogFileSpec,
    QuerySpec,
    poll_all,
    poll_limits,
    poll_log_files,
    poll_query,
)
from auditlake.plans.verify import verify_archive
from auditlake.sources.archive import read_archive, read_manifests
from auditlake.state import LOG_FILES, MALFORMED, QUERY, State

NOW = datetime(2027, 4, 21, 12, 0, 0, 700_000)


@pytest.fixture
def collector(spark, tmp_path):
    root = str(tmp_path / "archive")
    return Collector("main", "00D", root, State(spark, f"{root}/state"), "prod", initial=timedelta(days=1))


class Org:
    """Landed listing pages and downloads."""

    def __init__(self, path: Path):
        self.pages, self.files = path / "pages", path / "files"
        self.pages.mkdir()
        self.files.mkdir()
        self.rows = []

    def add(self, name: str, minute: int, body: str | None, **changes):
        row = {
            "attributes": {"type": "EventLogFile"}, "Id": name, "EventType": "Login",
            "CreatedDate": f"2027-04-21T10:{minute:02d}:00.000+0000", "LogDate": "2027-04-21T09:00:00.000+0000",
            "Interval": "Hourly", "Sequence": 1, "LogFileLength": float(len(body)) if body else 0.0, "LogFile": "/x",
        }
        self.rows.append({**row, **changes})
        if body is not None:
            (self.files / f"{name}.csv").write_text(body)
        page = {"totalSize": len(self.rows), "done": True, "records": self.rows}
        (self.pages / "page1.json").write_text(json.dumps(page, indent=1))

    def poll(self, spark, collector, now=NOW, **kw):
        return poll_log_files(spark, collector, str(self.pages), str(self.files), now, **kw)


@pytest.fixture
def org(tmp_path):
    return Org(tmp_path)


def csv(*ids: str) -> str:
    head = "EVENT_TYPE,TIMESTAMP,REQUEST_ID,USER_ID\n"
    return head + "".join(f'Login,20260915090{i}00.000,{r},"u,1"\n' for i, r in enumerate(ids))


def mark(collector):
    return collector.state.watermark(collector.instance, LOG_FILES)


def test_log_files_are_archived_once(spark, collector, org):
    org.add("A", 1, csv("r1", "r2"))
    org.add("B", 2, csv("r3"), LogDate="not-a-date")
    org.add("C", 3, csv("r9"), Interval="Daily")
    outcomes = org.poll(spark, collector)
    assert {r.file_id: r.action for r in outcomes.collect()} == {"A": "archive", "B": "archive"}
    for _ in range(2):
        assert org.poll(spark, collector).count() == 0
    rows = read_archive(spark, collector.root).collect()
    assert sorted(json.loads(r.payload)["REQUEST_ID"] for r in rows) == ["r1", "r2", "r3"]
    assert {(r.part_unit, r.part_hour) for r in rows} == {("elf-A", "09"), ("elf-B", "10")}
    assert mark(collector) == datetime(2027, 4, 21, 10, 2)
    lineage = {m.lineage["eventLogFileId"]: m.lineage for m in read_manifests(spark, collector.root).select("manifest.*").collect()}
    assert lineage["A"]["interval"] == "Hourly" and lineage["B"]["logDate"] == "not-a-date"
    assert verify_archive(spark, collector.root, strict=True).report().head().ok


def test_lost_markers_do_not_double_files(spark, collector, org):
    org.add("A", 1, csv("r1", "r2"))
    org.poll(spark, collector)
    late = NOW + timedelta(days=8)  # markers have expired
    collector.state.set_watermark("main", LOG_FILES, "", datetime(2027, 4, 21, 10, 30))
    org.poll(spark, collector, now=late)
    assert read_archive(spark, collector.root).count() == 2
    assert read_manifests(spark, collector.root).count() == 1


def test_first_failure_stops_the_poll(spark, collector, org):
    for i, name in enumerate("ABCDEF"):
        org.add(name, i, None if name == "D" else csv(f"r{name}"), LogFileLength=0)
    outcomes = org.poll(spark, collector)
    assert {r.file_id: r.failed for r in outcomes.collect()}["D"]
    assert read_archive(spark, collector.root).count() == 3
    assert mark(collector) == datetime(2027, 4, 21, 10, 2)
    (org.files / "D.csv").write_text(csv("rD"))
    org.poll(spark, collector)
    assert read_archive(spark, collector.root).count() == 6
    assert mark(collector) == datetime(2027, 4, 21, 10, 5)


def test_short_download_blocks(spark, collector, org):
    org.add("A", 1, csv("r1"), LogFileLength=9999.0)
    row = org.poll(spark, collector).head()
    assert row.failed and row.reason.startswith("has 74 bytes ") and row.counter is None
    assert mark(collector) is None


def test_quarantine_after_three_polls(spark, collector, org):
    bad = "EVENT_TYPE,REQUEST_ID\nLogin,1\nLogin,2,3\n"
    org.add("A", 1, csv("r1"))
    org.add("B", 2, bad)
    org.add("C", 3, csv("r3"))
    for attempt in (1, 2):
        outcome = {r.file_id: r for r in org.poll(spark, collector).collect()}
        assert outcome["B"].failed and outcome["B"].attempts == attempt
        assert mark(collector) == datetime(2027, 4, 21, 10, 1)
    outcome = {r.file_id: r.action for r in org.poll(spark, collector).collect()}
    assert outcome == {"B": "quarantine", "C": "archive"}
    lines = read_archive(spark, collector.root).where(F.col("part_unit") == "elf-B-quarantine").collect()
    payloads = sorted((json.loads(r.payload) for r in lines), key=lambda p: p["lineNumber"])
    assert [p["lineNumber"] for p in payloads] == [1, 2, 3]
    assert "".join(p["rawLine"] for p in payloads) == bad
    assert payloads[0]["quarantined"] is True
    assert payloads[0]["quarantineReason"] == "broken in line 3: wrong number of fields"
    assert mark(collector) == datetime(2027, 4, 21, 10, 3)
    assert collector.state.attempts("main", MALFORMED).count() == 0
    manifests = read_manifests(spark, collector.root).select("manifest.*").collect()
    assert {m.lineage.get("attempts") for m in manifests if "quarantineReason" in m.lineage} == {"3"}
    assert verify_archive(spark, collector.root, strict=True).report().head().ok


def fetches(spark, status):
    return spark.createDataFrame([("B", status, "gone")], "file_id string, status int, body string")


def test_tombstone_for_a_lost_file(spark, collector, org):
    for i, name in enumerate("ABC"):
        org.add(name, i, None if name == "B" else csv(f"r{name}"))
    spec = LogFileSpec(unavailable_attempts=3)
    for _ in range(2):
        org.poll(spark, collector, spec=spec, fetches=fetches(spark, 404))
        assert mark(collector) == datetime(2027, 4, 21, 10, 0)
    org.poll(spark, collector, spec=spec, fetches=fetches(spark, 404))
    assert mark(collector) == datetime(2027, 4, 21, 10, 2)
    rows = {r.part_unit: r for r in read_archive(spark, collector.root).collect()}
    assert set(rows) == {"elf-A", "elf-B-unavailable", "elf-C"}
    stone = rows["elf-B-unavailable"]
    assert json.loads(stone.payload) == {
        "unavailable": True, "eventLogFileId": "B", "unavailableReason": "HTTP 404: gone", "attempts": 3,
    }
    assert stone.timestamp == datetime(2027, 4, 21, 10, 1)


def test_transient_failures_never_leave_a_tombstone(spark, collector, org):
    org.add("B", 1, None)
    spec = LogFileSpec(unavailable_attempts=2)
    for status in (503, 403, 429):
        org.poll(spark, collector, spec=spec, fetches=fetches(spark, status))
    assert mark(collector) is None
    assert not Path(collector.root, "raw").exists()


# --- query results -------------------------------------------------------------------------

SPEC = QuerySpec("Audit", ["Id", "CreatedDate"], "CreatedDate")


def land(path: Path, rows, done=True, total=None, name="page1"):
    path.mkdir(exist_ok=True)
    page = {"totalSize": len(rows) if total is None else total, "done": done, "records": rows}
    (path / f"{name}.json").write_text(json.dumps(page, indent=1))


def audit(i, minute=0, **more):
    return {
        "attributes": {"type": "AuditTrail", "url": f"/a/{i}"}, "Id": f"id{i}",
        "CreatedDate": f"2027-04-21T11:{minute:02d}:00.000+0000", "BigNumber": 9007199254740993 + i, **more,
    }


def test_overlapping_polls(spark, collector, tmp_path):
    pages = tmp_path / "rows"
    small = Collector(**{**collector.__dict__, "records_per_object": 4})
    for n, later in ((11, 0), (11, 1), (16, 2)):
        land(pages, [audit(i, i) for i in range(n)])
        poll_query(spark, small, SPEC, str(pages), NOW + timedelta(minutes=later))
        assert read_archive(spark, small.root).count() == n
    counts = [m.recordCount for m in read_manifests(spark, small.root).select("manifest.*").collect()]
    assert max(counts) <= 4 and sum(counts) == 16
    rows = {r.event_id: r for r in read_archive(spark, small.root).collect()}
    row = rows["id3@2027-04-21T11:03:00.000+0000"]
    assert row.event_type == "AuditTrail"
    assert "attributes" not in row.payload and '"BigNumber": 9007199254740996' in row.payload
    assert row.timestamp == datetime(2027, 4, 21, 11, 3)
    assert verify_archive(spark, small.root, strict=True).report().head().ok


def test_changed_rows_are_new_versions(spark, collector, tmp_path):
    pages = tmp_path / "rows"
    for minute in (1, 2):
        land(pages, [audit(1, minute), audit(2, 0)])
        poll_query(spark, collector, SPEC, str(pages), NOW)
    assert read_archive(spark, collector.root).count() == 3


def test_rows_without_id_are_all_kept(spark, collector, tmp_path):
    pages = tmp_path / "rows"
    row = {"CreatedDate": "2027-04-21T11:00:00.000+0000", "V": 1.10}
    land(pages, [row, row, audit(1), audit(1)])
    poll_query(spark, collector, SPEC, str(pages), NOW)
    rows = read_archive(spark, collector.root).collect()
    assert sorted(r.event_id for r in rows) == ["", "", "id1@2027-04-21T11:00:00.000+0000"]
    assert {r.event_type for r in rows if r.event_id == ""} == {"Audit"}


def test_composite_ids(spark, collector, tmp_path):
    pages = tmp_path / "rows"
    spec = QuerySpec("Audit", ["A", "B", "CreatedDate"], "CreatedDate", custom_id=["A", "B"])
    base = {"CreatedDate": "2027-04-21T11:00:00.000+0000"}
    land(pages, [{"A": "ab", "B": "c", **base}, {"A": "a", "B": "bc", **base}, {"A": "a", **base}])
    for _ in range(2):
        poll_query(spark, collector, spec, str(pages), NOW)
    ids = [r.event_id for r in read_archive(spark, collector.root).collect()]
    assert len(set(ids)) == 3 and sorted(len(i) for i in ids) == [0, 0, 93, 93]


def test_two_queries_on_one_object_share_nothing(spark, collector, tmp_path):
    pages = tmp_path / "rows"
    land(pages, [audit(i, i) for i in range(4)])
    for spec in (SPEC, QuerySpec("Audit", ["Id", "CreatedDate"], "CreatedDate", where="Action = 'x'")):
        poll_query(spark, collector, spec, str(pages), NOW)
    assert read_archive(spark, collector.root).count() == 8
    assert collector.state.watermarks().count() == 2


@pytest.mark.parametrize("done,total", [(False, None), (True, 9)])
def test_truncated_result_moves_nothing(spark, collector, tmp_path, done, total):
    pages = tmp_path / "rows"
    land(pages, [audit(1)], done=done, total=total)
    with pytest.raises(RuntimeError, match="incomplete result set"):
        poll_query(spark, collector, SPEC, str(pages), NOW)
    assert collector.state.watermarks().count() == 0


def test_rows_are_taken_when_they_finish(spark, collector, tmp_path):
    pages = tmp_path / "rows"
    spec = QuerySpec("Job", ["Id", "CreatedDate", "CompletedDate"], "CreatedDate", end_timestamp="CompletedDate")
    job = lambda i, end: {"Id": f"j{i}", "CreatedDate": "2026-09-10T00:00:00.000+0000", "CompletedDate": end}
    done = "2027-04-21T11:30:00.000+0000"
    land(pages, [job(i, done if i < 3 else None) for i in range(5)])
    poll_query(spark, collector, spec, str(pages), NOW)
    assert read_archive(spark, collector.root).count() == 3
    land(pages, [job(i, done if i < 3 else "2027-04-21T12:30:00.000+0000") for i in range(5)])
    for _ in range(2):
        poll_query(spark, collector, spec, str(pages), NOW + timedelta(hours=1))
    ids = [r.event_id for r in read_archive(spark, collector.root).collect()]
    assert len(ids) == len(set(ids)) == 5
    assert f"j0@2026-09-10T00:00:00.000+0000@{done}" in ids


@pytest.mark.parametrize(
    "tail,refused",
    [("LIMIT 10", True), ("ORDER BY Id LIMIT 5", True), ("order by Id\tlimit\n5", True), ("OFFSET 3", True),
     ("", False), ("ORDER BY Limit__c", False), ("ORDER BY OffsetDays", False)],
)
def test_row_limits_are_refused(tail, refused):
    spec = QuerySpec("Audit", ["Id", "CreatedDate"], "createddate", tail=tail)
    if refused:
        with pytest.raises(ValueError, match="LIMIT or OFFSET"):
            spec.check()
    else:
        spec.check()


def test_time_fields_must_be_selected(spark):
    with pytest.raises(ValueError, match="must select"):
        QuerySpec("Audit", ["Id"], "CreatedDate").check()
    df = spark.createDataFrame([(1, 2)], "Id int, T int")
    with pytest.raises(ValueError, match="must select"):
        select_fields(df, ["Id"], "T")
    with pytest.raises(ValueError, match="invalid event type"):
        event_types_in(df, ["a'b"])


def test_window_is_inclusive_in_seconds(spark):
    df = spark.sql("SELECT timestamp'2026-01-01 00:00:0' + make_dt_interval(0,0,0,id) AS t FROM range(5)")
    got = in_window(df, "t", datetime(2026, 1, 1, 0, 0, 1, 900_000), datetime(2026, 1, 1, 0, 0, 3, 900_000))
    assert got.count() == 3


# --- limits, all parts, state ------------------------------------------------------------------


def test_limits(spark, collector, tmp_path):
    path = tmp_path / "limits.json"
    path.write_text('{"A": {"Max": 5, "Remaining": 3}, "B": {"Max": 7, "Remaining": 0}, "C": {"Max": 1}}')
    poll_limits(spark, collector, str(path), NOW, names=["A", "C", "Nobody"])
    rows = {r.event_id: json.loads(r.payload) for r in read_archive(spark, collector.root).collect()}
    assert rows == {
        "A@2027-04-21T12:00:00Z": {"limitName": "A", "limitMax": 5, "limitRemaining": 3},
        "C@2027-04-21T12:00:00Z": {"limitName": "C", "limitMax": 1, "limitRemaining": 0},
    }
    assert read_manifests(spark, collector.root).count() == 1


def test_parts_run_independently(spark):
    ran = []

    def fails():
        raise RuntimeError("no")

    result = poll_all(spark, {"a": fails, "b": lambda: ran.append(1)})
    assert {r.part: (r.ok, r.error) for r in result.collect()} == {"a": (False, "no"), "b": (True, None)}
    assert ran == [1]


def test_markers_expire_and_watermarks_do_not(spark, tmp_path):
    state = State(spark, str(tmp_path))
    keys = spark.createDataFrame([("k",)], "key string")
    state.mark(keys, "main", QUERY, "q", NOW)
    live = lambda at, scope="q": state.markers("main", QUERY, scope, at).count()
    assert live(NOW + timedelta(days=7) - timedelta(seconds=1)) == 1
    assert live(NOW + timedelta(days=7)) == 0
    assert live(NOW, scope="other") == 0
    state.set_watermark("main", QUERY, "q", NOW)
    state.set_watermark("main", QUERY, "q", NOW - timedelta(hours=1))
    assert state.watermark("main", QUERY, "q") == (NOW - timedelta(hours=1))
    assert state.watermark("other", QUERY, "q") is None


def test_unreadable_watermark_fails_the_poll(spark, collector, tmp_path):
    bad = spark.createDataFrame([("main", LOG_FILES, "", "12x", 1)], "instance string, kind string, scope string, value string, version bigint")
    bad.write.parquet(collector.state.path("watermarks", "main", LOG_FILES))
    with pytest.raises(Exception, match="invalid watermark"):
        collector.window(LOG_FILES, "", NOW)


def test_reset_needs_known_keys_and_confirmation(spark, tmp_path):
    state = State(spark, str(tmp_path))
    for scope in ("a", "b"):
        state.set_watermark("main", QUERY, scope, NOW)
    with pytest.raises(ValueError, match="unknown keys"):
        state.reset("main", ["a", "b"], ["a", "x"], confirm=True)
    with pytest.raises(ValueError, match="no keys"):
        state.reset("main", ["a", "b"], [" "], confirm=True)
    with pytest.raises(PermissionError):
        state.reset("main", ["a", "b"], "all", confirm=False)
    prior = state.reset("main", ["a", "b"], ["a"], confirm=True)
    assert [r.previous for r in prior.collect()] == [str(int((NOW - datetime(1970, 1, 1)) / timedelta(milliseconds=1)))]
    assert state.watermark("main", QUERY, "a") is None
    assert state.watermark("main", QUERY, "b") is not None


def test_state_stays_small(spark, tmp_path):
    import glob
    from datetime import timedelta

    from auditlake.state import VERSIONS_KEPT

    state, day = State(spark, str(tmp_path / "state")), datetime(2027, 4, 1)
    for i in range(VERSIONS_KEPT + 5):
        state.set_watermark("main", QUERY, "q", day + timedelta(minutes=i))
    assert state.watermark("main", QUERY, "q") == day + timedelta(minutes=VERSIONS_KEPT + 4)
    assert len(glob.glob(f"{tmp_path}/state/watermarks/**/part-*", recursive=True)) == VERSIONS_KEPT
    key = spark.createDataFrame([("k",)], "key string")
    for i in range(0, 20, 4):
        state.mark(key, "main", QUERY, "q", day + timedelta(days=i))
    assert len(glob.glob(f"{tmp_path}/state/markers/**/marked_day=*", recursive=True)) == 3
    assert state.markers("main", QUERY, "q", day + timedelta(days=16)).count() == 2


def test_working_folder_without_any_setting(monkeypatch, tmp_path):
    """A plain local session, with no configuration folder, has a working folder."""
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from auditlake.session import build, stage, workspace\n"
        "spark = build('bare', '1', '1g', 1)\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert workspace(spark, 'x').rpartition('/')[0] == workspace(spark, 'y').rpartition('/')[0]\n"
        "print(stage(spark.range(3), 'z').count())\n"
    )
    import os

    (tmp_path / "conf").mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": os.pathsep.join(sys.path)}
    got = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert got.stdout.strip() == "3", got.stderr[-2000:]


def test_the_window_parses_a_row_once(spark):
    from auditlake.plans.polls import rows_in_window

    dates = ["2026-01-01T00:00:01Z", "2026-01-01T00:00:02,5+0000", "2026-01-01T00:00:04Z", "soon", None]
    rows = spark.createDataFrame([(json.dumps({"n": i, "t": d}),) for i, d in enumerate(dates)], "row_json string")
    got = rows_in_window(rows, QuerySpec("Q", ["t"], "t"), datetime(2026, 1, 1, 0, 0, 1), datetime(2026, 1, 1, 0, 0, 3))
    assert [json.loads(r.row_json)["n"] for r in got.collect()] == [0, 1]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1
