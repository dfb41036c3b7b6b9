"""Column functions on small inputs with known answers."""

from __future__ import annotations

import hashlib
import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from auditlake.functions import ids, layout, payload, times
from auditlake.functions.envelope import header_of, payload_of, to_envelope
from auditlake.schemas import RECORD


def values(spark, column, rows, schema="v string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_sanitised_keys_stay_apart(spark):
    names = ["Login Event", "Login/Event", "Login_Event", "Login+Event"]
    keys = values(spark, layout.sanitize_key(F.col("v")), names)
    assert len(set(keys)) == 4
    assert keys[2] == "Login_Event"
    assert keys[0] == "Login_Event-" + sha("Login Event")[:6]


@pytest.mark.parametrize(
    "text,key", [("", "unknown"), ("  　\n", "unknown"), (" a.b-c_1 ", "a.b-c_1"), (None, "unknown")]
)
def test_sanitised_edges(spark, text, key):
    assert values(spark, layout.sanitize_key(F.col("v")), [(text,)]) == [key]


def test_partition_is_utc(spark):
    cols = layout.partition_columns(
        F.lit("stream"), F.lit("org"), F.lit("Login"), F.col("v").cast("timestamp")
    )
    path = values(spark, layout.partition_path(cols), ["2026-09-11T09:30:00+10:00"])[0]
    assert path.endswith("year=2026/month=09/day=10/hour=23")


def test_object_keys_mirror(spark):
    data, manifest = layout.object_keys(F.lit("source=x"), F.col("v"))
    assert values(spark, data, ["elf-1"]) == ["raw/source=x/elf-1.json.gz"]
    assert values(spark, manifest, ["elf-1"]) == ["manifests/source=x/elf-1.manifest.json"]
    assert layout.join_prefix("/a/b/", "raw/x") == "a/b/raw/x"
    assert layout.join_prefix("/", "raw/x") == "raw/x"


def test_stream_event_id_cases(spark):
    cases = [
        ('{"EventUuid":"7f3c","EventIdentifier":"k-ant"}', "7f3c"),
        ('{"EventIdentifier":"k-bee"}', "k-bee"),
        ('{"EventUuid":"","EventIdentifier":"k-cat"}', "k-cat"),
        ('{"EventUuid":42}', ""),
        ('{"EventUuid":"815"}', "815"),
        ('{"EventUuid":true}', ""),
        ('{"EventUuid":{"a":1}}', ""),
        ('{"EventUuid":"{"}', "{"),
        ("{}", ""),
    ]
    found = ids.stream_event_id(
        ids.json_string_field(F.col("v"), "EventUuid"), ids.json_string_field(F.col("v"), "EventIdentifier")
    )
    assert values(spark, found, [c[0] for c in cases]) == [c[1] for c in cases]


def test_composite_id_is_length_prefixed(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    got = [r[0] for r in df.select(ids.composite_id([F.col("a"), F.col("b")])).collect()]
    assert got == [sha("2:ab|1:c|"), sha("1:a|2:bc|")]


def test_composite_id_needs_every_field(spark):
    row = F.from_json("v", "map<string,string>")
    got = values(spark, ids.composite_id_of(row, ["A", "B"]), ['{"A":"x","B":"é"}', '{"A":"x"}', '{"A":"x","B":null}'])
    assert got == [sha("1:x|2:é|"), "", sha("1:x|5:<nil>|")]


def test_csv_row_id(spark):
    got = values(spark, ids.csv_row_id(F.col("v"), F.lit(7)), ["0AT1", ""])
    assert got == [sha("0AT1|7")[:32], ""]


def test_fingerprint_ignores_select_order_only(spark):
    fp = lambda select, where="": ids.query_fingerprint(
        F.lit("Audit"), F.array(*[F.lit(s) for s in select]), F.lit(where), F.lit(""), F.lit("T"), F.lit(""), F.lit("rest")
    )
    row = spark.range(1).select(
        fp(["Id", " T"]).alias("a"), fp(["t", "ID"]).alias("b"), fp(["Id", "T"], "x = 1").alias("c")
    ).head()
    assert row.a == row.b != row.c
    parts = ["Audit", "2:id|1:t|", "", "", "T", "", "rest"]
    assert row.a == sha("".join(f"{len(p)}:{p}|" for p in parts))[:16]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("20310309064117.250", datetime(2031, 3, 9, 6, 41, 17, 250000)),
        ("20310309064117", datetime(2031, 3, 9, 6, 41, 17)),
        ("20310309064117.1234567", datetime(2031, 3, 9, 6, 41, 17, 123456)),
        ("20311309064117", None),
        ("2031030906411", None),
        ("", None),
    ],
)
def test_compact_time(spark, text, expected):
    assert values(spark, times.parse_compact_timestamp(F.col("v")), [text]) == [expected]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2031-03-09T06:41:17.250+0000", datetime(2031, 3, 9, 6, 41, 17, 250000)),
        ("2031-03-09T06:41:17.250Z", datetime(2031, 3, 9, 6, 41, 17, 250000)),
        ("2031-03-09T16:41:17+10:00", datetime(2031, 3, 9, 6, 41, 17)),
        ("2031-03-09T06:41:17.123456789Z", datetime(2031, 3, 9, 6, 41, 17, 123456)),
        ("2031-03-08T23:41:17-0700", datetime(2031, 3, 9, 6, 41, 17)),
        ("2031-03-09 06:41:17Z", None),
        ("2031-03-09", None),
        ("not-a-date", None),
    ],
)
def test_api_date(spark, text, expected):
    assert values(spark, times.parse_api_date(F.col("v")), [text]) == [expected]


def test_required_date_stops_the_job(spark):
    with pytest.raises(Exception, match="invalid CreatedDate: nonsense"):
        values(spark, times.require_api_date(F.col("v"), "CreatedDate"), ["nonsense"])


def test_csv_time_prefers_timestamp(spark):
    row = F.from_json("v", "map<string,string>")
    got = values(
        spark, times.csv_event_time(row),
        ['{"TIMESTAMP":"20250101000000","TIMESTAMP_DERIVED":"2024-01-01T00:00:00Z"}',
         '{"TIMESTAMP":"bad","TIMESTAMP_DERIVED":"2024-01-01T00:00:00.5Z"}'],
    )
    assert got == [datetime(2025, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 500000)]


def test_partition_time_never_now(spark):
    created = F.lit("2025-01-01 05:00:00").cast("timestamp")
    assert values(spark, times.csv_partition_time(F.col("v"), created), ["not-a-date"]) == [datetime(2025, 1, 1, 5)]


def test_broken_watermark_is_an_error(spark):
    with pytest.raises(Exception, match="invalid watermark"):
        values(spark, times.watermark_time(F.col("v")), ["12x"])


def test_since(spark):
    now = F.lit("2025-01-01 05:00:00").cast("timestamp")
    got = values(
        spark, times.since(times.watermark_time(F.col("v")), now), [("1735700400000",), (None,)]
    )
    assert got == [datetime(2025, 1, 1, 2), datetime(2025, 1, 1, 4)]


# --- payload ---------------------------------------------------------------------------


def test_metadata_member(spark):
    digits = '"N":1.10,"E":1e3,"Big":' + "123456789" * 6
    nested = '"attributes":{"type":"X","more":[{"a":"}"},[1,{"b":null}]],"url":"/a{b}\\"c"}'
    long = '"Text":"' + 'x, \\" {y}' * 20_000 + '"'
    cases = [
        ("{" + nested + ',"Id":"1",' + digits + ',"Sub":{"attributes":{"type":"Y"}}}', '{"Id":"1",' + digits + ',"Sub":{"attributes":{"type":"Y"}}}'),
        ('{"Id":"1", ' + nested + " , " + digits + "}", '{"Id":"1",' + digits + "}"),
        ('{"Id":"1",' + digits + "," + nested + "}", '{"Id":"1",' + digits + "}"),
        ("{ " + nested + " }", "{}"),
        ('{"Id":"1","Text":"\\"attributes\\":{}"}', None),
        ('{"Id":{"attributes":{}},"A":["attributes",1.50]}', None),
        ("{" + long + "," + nested + "," + digits + "}", "{" + long + "," + digits + "}"),
        ('{"attributes":null,"N":1.10}', '{"N":1.10}'),
        ("no json", None),
        (None, None),
    ]
    got = values(spark, payload.drop_metadata(F.col("v")), [c[0] for c in cases])
    for (row, want), found in zip(cases, got):
        assert found == (row if want is None else want)



def test_query_event_type(spark):
    rows = ['{"attributes":{"type":"X"}}', '{"attributes":{"type":""}}', "{}"]
    assert values(spark, payload.query_event_type(F.col("v"), F.lit("Q")), rows) == ["X", "Q", "Q"]


def test_schema_short_name(spark):
    assert values(spark, payload.stream_event_type(F.col("v")), ["a.b.Login", "Login", "", "a."]) == [
        "Login", "Login", "UnknownEvent", "UnknownEvent",
    ]


def test_normalised_payload(spark):
    schema = (
        "p struct<tags map<string,string>, list array<string>, kind string, inner struct<a int, b date>,"
        " raw binary, at timestamp, day date, price decimal(10,2), wide decimal(38,2), took interval day to second, none string>"
    )
    row = (
        {"string": "kept as a map"}, ["x", None], "E", (1, date(2025, 1, 2)), b"\x01\x02\x03\x04",
        datetime(2025, 1, 1, 0, 0, 0, 1000), date(2025, 1, 1), Decimal("0.00"),
        Decimal("123456789012345678901234567890123456.78"), timedelta(days=1, milliseconds=1500), None,
    )
    df = spark.createDataFrame([(row,)], schema)
    text = df.select(payload.normalize_payload(F.col("p"), df.schema["p"].dataType)).head()[0]
    got = json.loads(text)
    assert got["tags"] == {"string": "kept as a map"}
    assert got["list"] == ["x", None]
    assert got["inner"] == {"a": 1, "b": "2025-01-02"}
    assert got["raw"] == "AQIDBA=="
    assert got["at"] == 1735689600001
    assert got["price"] == "0.000000000000000000"
    assert got["wide"] == "123456789012345678901234567890123456.780000000000000000"
    assert got["took"] == 86401500
    assert "none" in got and len(got) == 11


# --- envelope ------------------------------------------------------------------------------


def record(**changes):
    base = dict(
        event_id="e1", event_type="Login", timestamp=datetime(2026, 9, 15, 1, 2, 3, 4000), source="stream",
        env="prod", org_id="00D", instance="main", replay_id="AAACYg==", payload_json='{"A":"b"}',
        partition_time=None, object_name=None, object_type=None,
    )
    return {**base, **changes}


def lines(spark, *records):
    df = spark.createDataFrame([tuple(r.values()) for r in records], RECORD)
    return [r[0] for r in df.select(to_envelope()).collect()]


def test_envelope_fields(spark):
    got = json.loads(lines(spark, record())[0])
    assert list(got) == [
        "event_id", "event_type", "timestamp", "source", "env", "org_id", "instance", "replay_id", "payload",
    ]
    assert got["timestamp"] == "2026-09-15T01:02:03.004Z"
    assert got["replay_id"] == "AAACYg=="


def test_empty_fields_are_omitted(spark):
    line = lines(spark, record(event_id="", env="", org_id=None, instance="", replay_id=None, payload_json=None, timestamp=None))[0]
    assert json.loads(line) == {
        "event_type": "Login", "timestamp": "0001-01-01T00:00:00Z", "source": "stream", "payload": {},
    }


def test_payload_text_is_exact(spark):
    tricky = '{"n":1.10,"big":9007199254740993,"s":"a<b>&\\u00e9 \\"payload\\":{}","z":{"payload":1}}'
    line = lines(spark, record(event_type='say "payload":{', payload_json=tricky))[0]
    df = spark.createDataFrame([(line,)], "v string")
    row = df.select(payload_of(F.col("v")).alias("p"), header_of(F.col("v")).alias("h")).head()
    assert row.p == tricky
    assert row.h.event_type == 'say "payload":{'
    assert json.loads(line)["payload"] == json.loads(tricky)


def test_pretty_payload_stays_on_one_line(spark):
    line = lines(spark, record(payload_json='{\r\n "a": 1\n}'))[0]
    assert "\n" not in line and json.loads(line)["payload"] == {"a": 1}


def test_keys_that_only_look_safe(spark):
    """The short way for safe keys takes none that has to be changed."""
    texts = ["Login", "a.b-c_9", "a\n", " a", "a ", "", "a/b", "\u00e9", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r.k for r in df.select(layout.sanitize_key(F.col("t")).alias("k")).collect()]
    assert found[:2] == texts[:2] and found[2:6] == ["a", "a", "a", "unknown"] and found[8] == "unknown"
    for text, key in zip(("a/b", "\u00e9"), found[6:8]):
        assert key == "_".join(text.split("/") if "/" in text else ["", ""]) + "-" + hashlib.sha256(text.encode()).hexdigest()[:6]


def test_line_breaks_and_times_of_an_envelope(spark):
    row = ("e1", "Login", datetime(2026, 9, 15, 1, 2, 3, 4000), "stream", "", "", "", None, '{"a":\r\n 1}\n', None, "u", None)
    line = spark.createDataFrame([row], RECORD).select(to_envelope()).head()[0]
    assert "\n" not in line and "\r" not in line and line.endswith('"payload":{"a":   1}}')
    assert '"timestamp":"2026-09-15T01:02:03.004Z"' in line


def test_lines_are_cut_by_bytes(spark):
    rows = [
        ('{"event_type":"é漢","payload":{"k":"ü"}}  ', '{"k":"ü"}', "é漢"),
        ('{"event_type":"x", "payload":}', "", "x"),
        ('{"event_type":"x","payload":', "", "x"),
        ('{"event_type":"x"}', None, None),
        ("", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "v string")
    found = df.select(payload_of(F.col("v")).alias("p"), header_of(F.col("v"))["event_type"].alias("t")).collect()
    assert [(r.p, r.t) for r in found] == [r[1:] for r in rows]
    plan = df.select(payload_of(F.col("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert "locate" not in plan
