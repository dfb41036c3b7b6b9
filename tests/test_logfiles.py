"""CSV log files against a plain strict parser, with files cut into tiny splits."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from auditlake.session import stage
from auditlake.sources.logfiles import (
    csv_lines,
    csv_rows,
    file_status,
    malformed_files,
    read_log_files,
    read_raw_lines,
)


def strict_parse(text: str):
    """``(records, bad_line)`` of a strict CSV reader, one character at a time."""
    records, width, pos = [], None, 0
    lines = text.split("\n")
    ends = [True] * (len(lines) - 1) + [False]
    if lines[-1] == "":
        lines, ends = lines[:-1], ends[:-1]
    lines = [x[:-1] if x.endswith("\r") else x for x in lines]
    while pos < len(lines):
        if lines[pos] == "":
            pos += 1
            continue
        number = len(records) + 1
        fields, rest, bad = [], lines[pos], False
        while True:
            if not rest.startswith('"'):
                field, comma, rest = rest.partition(",")
                if '"' in field:
                    return records, number
                fields.append(field)
                if not comma:
                    break
                continue
            rest, value = rest[1:], ""
            while True:
                cut = rest.find('"')
                if cut < 0:
                    if pos + 1 >= len(lines):
                        return records, number
                    value += rest + "\n"
                    pos += 1
                    rest = lines[pos]
                elif rest[cut : cut + 2] == '""':
                    value, rest = value + rest[:cut] + '"', rest[cut + 2 :]
                else:
                    value, rest = value + rest[:cut], rest[cut + 1 :]
                    break
            fields.append(value)
            if rest == "":
                break
            if rest[0] != ",":
                return records, number
            rest = rest[1:]
        pos += 1
        if width is None:
            width = len(fields)
        elif len(fields) != width:
            return records, number
        records.append(fields)
    return records, None


def random_file(rng: random.Random) -> str:
    width = rng.randint(1, 4)
    cell = lambda: rng.choice(
        ["", "a", "b c", '"q"', '"x,y"', '"two\nlines"', '"dou""ble"', '""', '"\n\n"', '"cr\r\nlf"', "é"]
    )
    rows = [",".join(f"c{i}" for i in range(width))]
    for _ in range(rng.randint(0, 12)):
        rows.append(",".join(cell() for _ in range(width)))
        if rng.random() < 0.15:
            rows.append("")
    if rng.random() < 0.4:
        spoil = rng.choice(['a"b', '"open', "x,y,z,1,2", '"a"b', '"', '"""', 'a,"', '"\n"x'])
        rows.insert(rng.randint(0, len(rows)), spoil)
    return rng.choice(["\n", "\r\n"]).join(rows) + rng.choice(["", "\n", "\n\n"])


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "23")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_random_files_like_a_strict_parser(spark, tmp_path, tiny_splits):
    rng = random.Random(7)
    texts = {f"f{i:03d}": random_file(rng) for i in range(120)}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    numbered = csv_lines(spark, str(tmp_path))
    splits = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").where("file_block_start > 0")
    assert splits.count() > 100
    lines = stage(numbered, "test-lines")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    status = stage(file_status(lines), "test-status")
    bad = {r.file_id: r.bad_line for r in status.where("bad_line is not null").collect()}
    rows = {}
    for r in csv_rows(lines, status).collect():
        rows.setdefault(r.file_id, {})[r.line] = dict(r.row)
    raw = {}
    for r in read_raw_lines(lines).collect():
        raw.setdefault(r.file_id, {})[r.line_no] = r.raw_line
    malformed = 0
    for name, text in texts.items():
        records, bad_line = strict_parse(text)
        assert bad.get(name) == bad_line, (name, text)
        malformed += bad_line is not None
        if bad_line is None and records:
            labels, expected = records[0], records[1:]
            found = rows.get(name, {})
            assert sorted(found) == list(range(2, len(records) + 1)), (name, text)
            for i, fields in enumerate(expected):
                assert found[i + 2] == dict(zip(labels, fields)), (name, text)
        else:
            assert name not in rows
        pieces = raw.get(name, {})
        assert "".join(pieces[n] for n in sorted(pieces)) == text
        assert sorted(pieces) == list(range(1, len(pieces) + 1))
    assert 20 < malformed < 100


def test_reasons(spark, tmp_path):
    (tmp_path / "ragged.csv").write_text("a,b\n1,2\n1,2,3\n")
    (tmp_path / "quote.csv").write_text('a,b\n1,x"y\n1,2,3\n')
    (tmp_path / "open.csv").write_text('a,b\n1,"x\n')
    (tmp_path / "header.csv").write_text('a"b,c\n1,2\n')
    (tmp_path / "fine.csv").write_text('a,b\n\n1,2\n')
    bad = malformed_files(file_status(csv_lines(spark, str(tmp_path))))
    assert {r.file_id: r.reason for r in bad.collect()} == {
        "ragged": "broken in line 3: wrong number of fields",
        "quote": "broken in line 2: bare or unterminated quote",
        "open": "broken in line 2: bare or unterminated quote",
        "header": "broken in line 1: bare or unterminated quote",
    }


def test_headers_differ_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"EVENT_TYPE","X"\n"Login",""\n"Login","007"\n')
    (tmp_path / "b.csv").write_text("Y,Y\n1,2\n")
    rows = read_log_files(spark, str(tmp_path))
    got = {(r.file_id, r.line): r.row for r in rows.collect()}
    assert got == {
        ("a", 2): {"EVENT_TYPE": "Login", "X": ""},
        ("a", 3): {"EVENT_TYPE": "Login", "X": "007"},
        ("b", 2): {"Y": "2"},
    }


def test_long_quoted_field(spark, tmp_path):
    value = "x,\n" * 200_000
    (tmp_path / "big.csv").write_text(f'a,b\n1,"{value}"\n')
    row = read_log_files(spark, str(tmp_path)).select(
        F.length(F.col("row")["b"]).alias("n"), F.sha2(F.col("row")["b"], 256).alias("h")
    ).head()
    import hashlib

    assert row.n == len(value) and row.h == hashlib.sha256(value.encode()).hexdigest()


def test_lines_are_looked_at_once(spark, tmp_path):
    """The check of a file reads its lines once, and a file's id is not taken from its path for each line."""
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n1,2\n1,2,3\n')
    lines = csv_lines(spark, str(tmp_path))
    assert "regexp" not in lines._jdf.queryExecution().optimizedPlan().toString()
    lines, seen = stage(lines, "test-lines"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    status = file_status(lines.mapInArrow(count, lines.schema)).collect()
    assert [(r.file_id, r.records, r.bad_line) for r in status] == [("a", 4, 4)] and seen.value == 5
