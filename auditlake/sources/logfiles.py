"""CSV log files: physical lines, records, malformed files and typed rows.

A quoted field may span lines, so a CSV file is usually read by one task from
start to end. Here the files are read as plain lines, which Spark can split, and
the two things that need what came before - the line number and whether a line
starts inside quotes - are running sums: first inside one input split, by the task
that reads it, then over the few splits of a file. Lines stay in the tasks that read them;
only the totals of the splits are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditlake.session import stage

# The CSV grammar. A field is bare text or quoted text with
# doubled quotes; only the last field of a line may leave its quotes open.
BARE = r'[^",]*+'
QUOTED_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
FIELDS = rf'(?:(?:{BARE}|{QUOTED_OPEN}"),)*+(?:{BARE}|{QUOTED_OPEN}"?)'
LINE_OUTSIDE = rf"(?s)^{FIELDS}$"
LINE_INSIDE = rf'(?s)^[^"]*+(?:""[^"]*+)*+(?:"(?:,{FIELDS})?)?$'
QUOTED_SPAN = rf'{QUOTED_OPEN}(?:"|$)'
INSIDE_HEAD = r'^[^"]*+(?:""[^"]*+)*+(?:"|$)'
ONE_FIELD = rf',(?:{QUOTED_OPEN}"|{BARE})'

# Totals of splits, of some hundred bytes each, that are sent to the tasks: for 12 TB in splits of 128 MB.
SPLITS_SENT = 100_000

BAD_QUOTES = "bare or unterminated quote"
BAD_COUNT = "wrong number of fields"


def file_id_of(path: Column) -> Column:
    """Log file of a path: ``…/<Id>.csv``, or any file in a ``file_id=<Id>`` folder."""
    folder = F.regexp_extract(path, r"/file_id=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"([^/]+?)(?:\.csv)?$", 1))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.translate(text, char, ""))


# The Python functions below travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PLACED = [("quotes", pa.int64()), ("blank", pa.bool_()), ("odd", pa.bool_()), ("local_no", pa.int64()),
           ("starts_out", pa.int64()), ("starts_in", pa.int64())]
PLACED = (
    "path string, block bigint, file_size bigint, raw string, quotes bigint, blank boolean, odd boolean, local_no bigint,"
    " starts_out bigint, starts_in bigint"
)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of input splits, in order, with what came before them in their split: quotes (odd or even), lines,
    and records started so far, for both answers to "does the split start in quotes?"."""
    current, sums = None, (0, 0, 0, 0)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        path, block, raw = batch.column("path"), batch.column("block").to_numpy(), batch.column("raw")
        quotes = pc.count_substring(raw, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        blank = pc.is_in(raw, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
        names = path.dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero((np.diff(names, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0)).tolist()
        odd, line, out, inside = np.empty(n, bool), *(np.empty(n, np.int64) for _ in range(3))
        for a, z in zip(starts, [*starts[1:], n]):
            own = (path[a].as_py(), int(block[a]))
            if own != current:
                current, sums = own, (0, 0, 0, 0)
            part = slice(a, z)
            seen = sums[0] + np.cumsum(quotes[part])
            odd[part] = (seen - quotes[part]) % 2 == 1
            line[part] = sums[1] + np.arange(1, z - a + 1)
            out[part] = sums[2] + np.cumsum(~odd[part] & ~blank[part])
            inside[part] = sums[3] + np.cumsum(odd[part] & ~blank[part])
            sums = (int(seen[-1]), int(line[z - 1]), int(out[z - 1]), int(inside[z - 1]))
        columns = [pa.array(c, t) for c, (_, t) in zip((quotes, blank, odd, line, out, inside), _PLACED)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *columns], names=[*batch.schema.names, *(name for name, _ in _PLACED)]
        )


def _split_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of all files with their place inside the input split they belong to."""
    raw = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("value").alias("raw"),
        )
    )
    return raw.mapInArrow(_place, PLACED)


def csv_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every physical line with its number, quote state and record number.

    The files are read twice, once for the totals of their splits. These are sent to the lines where they are
    few by count; otherwise the lines are shuffled to them.
    """
    lines = _split_lines(spark, paths)
    splits = lines.groupBy("path", "block").agg(
        F.max("local_no").alias("n"),
        F.sum("quotes").alias("q"),
        F.max("starts_out").alias("n_out"),
        F.max("starts_in").alias("n_in"),
        F.sum(F.octet_length("raw") + F.lit(1)).alias("bytes"),
        F.first("file_size").alias("size"),
    )
    by_file = W.partitionBy("path").orderBy("block")
    before = by_file.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    splits = splits.withColumns(
        {
            "line_offset": F.coalesce(F.sum("n").over(before), zero),
            "split_odd": F.coalesce(F.sum("q").over(before), zero) % 2 == 1,
            "file_lines": F.sum("n").over(W.partitionBy("path")),
            "file_bytes": F.sum("bytes").over(W.partitionBy("path")),
        }
    )
    started = F.when(F.col("split_odd"), F.col("n_in")).otherwise(F.col("n_out"))
    splits = splits.withColumn(
        "record_offset", F.coalesce(F.sum(started).over(before), zero)
    ).select(
        # The file's id is taken from its path here, not for each line.
        "path", "block", file_id_of(F.col("path")).alias("file_id"), "line_offset", "split_odd", "record_offset", "file_lines",
        # A byte order mark is not part of the lines read.
        (F.col("size") - F.col("file_bytes")).isin(0, 3).alias("ends_with_newline"),
    )
    splits = stage(splits, "csv-splits")
    if splits.count() <= SPLITS_SENT:
        splits = F.broadcast(splits)
    line_no = F.col("line_offset") + F.col("local_no")
    in_quote = F.col("odd") != F.col("split_odd")
    local_starts = F.when(F.col("split_odd"), F.col("starts_in")).otherwise(F.col("starts_out"))
    last = F.col("line_no") == F.col("file_lines")
    return (
        lines.join(splits, ["path", "block"])
        .select(
            "path",
            "file_id",
            line_no.alias("line_no"),
            "raw",
            in_quote.alias("in_quote"),
            (in_quote != (F.col("quotes") % 2 == 1)).alias("ends_in_quote"),
            (F.col("blank") & ~in_quote).alias("skipped"),
            (F.col("record_offset") + local_starts).alias("record_no"),
            "ends_with_newline",
            "file_lines",
        )
        .withColumn("terminated", ~last | F.col("ends_with_newline"))
        .withColumn("is_last", last)
        .drop("ends_with_newline", "file_lines")
    )


def read_raw_lines(lines: DataFrame) -> DataFrame:
    """Physical lines from 1, unparsed, each with its line end."""
    end = F.when(F.col("terminated"), F.lit("\n")).otherwise(F.lit(""))
    return lines.select("path", "file_id", "line_no", F.concat("raw", end).alias("raw_line"))


def _text() -> Column:
    return F.regexp_replace("raw", r"\r$", "")


def _separators(text: Column) -> Column:
    """Commas of a line that stand outside quotes."""
    outside = F.when(F.col("in_quote"), F.regexp_replace(text, INSIDE_HEAD, "")).otherwise(text)
    return _count(F.regexp_replace(outside, QUOTED_SPAN, ""), ",")


def file_status(lines: DataFrame) -> DataFrame:
    """One row per file: its header and the first record that cannot be parsed.

    `bad_line` counts records from 1 with the header as 1 and is NULL for a file
    that parses; one bad record condemns the whole file. Only counters travel
    between tasks, so a file with a runaway quote costs no more than a good one.
    """
    text = _text()
    well_formed = F.when(F.col("in_quote"), text.rlike(LINE_INSIDE)).otherwise(
        text.rlike(LINE_OUTSIDE)
    )
    checked = lines.where(~F.col("skipped")).select(
        "path", "file_id", "record_no", "in_quote", "ends_in_quote",
        F.when(F.col("is_last") & F.col("ends_in_quote"), F.lit(False))
        .otherwise(well_formed).alias("ok"),
        _separators(text).alias("separators"),
    )
    header = F.col("record_no") == 1
    # A record on one line carries its own field count; only records that span
    # lines have to be summed up. The lines are looked at once.
    spanning = F.col("in_quote") | F.col("ends_in_quote")
    counted = checked.groupBy(
        "path", "file_id", F.when(spanning, F.col("record_no")).alias("record"), F.when(~spanning, F.col("separators")).alias("own")
    ).agg(
        F.min(F.when(~F.col("ok"), F.col("record_no"))).alias("bad_quotes"),
        F.sum(F.when(header, F.col("separators"))).alias("in_header"),
        F.sum("separators").alias("summed"),
        F.min("record_no").alias("first"),
        F.max("record_no").alias("last"),
    )
    # A row for each field count of a file.
    widths = counted.groupBy("path", "file_id", F.coalesce("own", "summed").alias("separators")).agg(
        F.min("bad_quotes").alias("bad_quotes"), F.sum("in_header").alias("in_header"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    width = F.sum("in_header").over(W.partitionBy("path", "file_id")) + 1
    files = (
        widths.withColumn("width", width)
        .groupBy("path", "file_id")
        .agg(
            F.min("bad_quotes").alias("bad_quotes"),
            F.min(F.when(F.col("separators") + 1 != F.col("width"), F.col("first"))).alias("bad_count"),
            F.max("last").alias("records"),
        )
    )
    by_quotes = F.coalesce(F.col("bad_quotes") <= F.col("bad_count"), F.col("bad_quotes").isNotNull())
    return files.select(
        "path",
        "file_id",
        "records",
        F.least("bad_quotes", "bad_count").alias("bad_line"),
        F.when(F.col("bad_quotes").isNull() & F.col("bad_count").isNull(), F.lit(None))
        .when(by_quotes, F.lit(BAD_QUOTES))
        .otherwise(F.lit(BAD_COUNT))
        .alias("bad_reason"),
    )


def malformed_files(status: DataFrame) -> DataFrame:
    """Files that cannot be parsed, with the reason their records are set aside."""
    return status.where(F.col("bad_line").isNotNull()).select(
        "path",
        "file_id",
        "bad_line",
        F.concat(
            F.lit("broken in line "), F.col("bad_line").cast("string"), F.lit(": "),
            F.col("bad_reason"),
        ).alias("reason"),
    )


def _fields(record: Column) -> Column:
    unquote = lambda f: F.when(
        f.startswith(',"'),
        F.replace(F.substr(f, F.lit(3), F.length(f) - 3), F.lit('""'), F.lit('"')),
    ).otherwise(F.substr(f, F.lit(2)))
    parsed = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(ONE_FIELD), F.lit(0)), unquote
    )
    return F.when(record.contains('"'), parsed).otherwise(F.split(record, ",", -1))


def _records(lines: DataFrame) -> DataFrame:
    """Record texts. Only records that span lines are brought together."""
    lines = lines.where(~F.col("skipped")).withColumn("text", _text())
    spanning = F.col("in_quote") | F.col("ends_in_quote")
    single = lines.where(~spanning).select("path", "file_id", "record_no", "text")
    joined = (
        lines.where(spanning)
        .groupBy("path", "file_id", "record_no")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("parts"))
        .select(
            "path", "file_id", "record_no",
            F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
        )
    )
    return single.unionByName(joined)


def csv_rows(lines: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of the well-formed files as ``(path, file_id, line, row)``; every value is
    the original text, and `line` counts records with the header as 1."""
    good = status.where(F.col("bad_line").isNull()).select("path")
    records = _records(lines.join(good, "path", "left_semi"))
    headers = records.where(F.col("record_no") == 1).select(
        "path", _fields(F.col("text")).alias("labels")
    )
    return (
        records.where(F.col("record_no") > 1)
        .join(headers, "path")
        .select(
            "path",
            "file_id",
            F.col("record_no").alias("line"),
            F.map_from_arrays("labels", _fields(F.col("text"))).alias("row"),
        )
    )


def read_log_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows of all well-formed CSV files below ``paths``.

    The numbered lines feed several steps, so they are written out once.
    """
    lines = stage(csv_lines(spark, paths), "lines")
    return csv_rows(lines, stage(file_status(lines), "status"))
