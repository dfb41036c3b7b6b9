"""Scans of a stored archive: envelope lines, manifests and objects."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions.envelope import PAYLOAD_KEY, envelope_time, head_of, header_of, payload_of
from auditlake.functions.layout import MANIFESTS, RAW, object_key_of
from auditlake.functions.times import ZERO_TIME_TEXT
from auditlake.schemas import ENVELOPE_HEADER, HOUR_KEYS, MANIFEST, PART_KEYS

HEADER_NAMES = [f.strip().split(" ")[0] for f in ENVELOPE_HEADER.split(",")]


def raw_root(root: str) -> str:
    return f"{root.rstrip('/')}/{RAW}"


def hour_path(root: str, **keys: str) -> str:
    """Glob of the hour folders that match the given partition keys, so a scan lists
    only those: ``hour_path(root, source="stream", year="2026", hour="02")``."""
    steps = [f"{k}={keys.get(k, '*')}" for k in HOUR_KEYS]
    return "/".join([raw_root(root), *steps])


def read_lines(
    spark: SparkSession,
    root: str,
    paths: Sequence[str] | None = None,
    units: bool = True,
) -> DataFrame:
    """Stored lines as text with their partition keys as strings.

    ``units=False`` reads a layout whose objects lie directly in the hour folders. A
    damaged object stops the scan; `scan_objects` passes over it and says so.
    """
    keys = PART_KEYS if units else HOUR_KEYS
    schema = "value string, " + ", ".join(f"{k} string" for k in keys)
    reader = (
        spark.read.schema(schema)
        .option("basePath", raw_root(root))
        .option("lineSep", "\n")
    )
    lines = reader.text(list(paths) if paths else raw_root(root))
    return lines.select(
        "value",
        *[F.col(k).alias(f"part_{k}") for k in keys],
        object_key_of(F.col("_metadata.file_path")).alias("object_key"),
    )


def read_archive(
    spark: SparkSession,
    root: str,
    paths: Sequence[str] | None = None,
    units: bool = True,
) -> DataFrame:
    """Archived records. Header fields keep the stored values; the sanitised path keys
    are `part_*` columns and prune the scan. The payload is the exact stored text."""
    lines = read_lines(spark, root, paths, units).where(F.trim("value") != "")
    kept = [c for c in lines.columns if c != "value"]
    return (
        lines.withColumn("head", head_of(F.col("value")))
        .withColumn("header", header_of(F.col("value"), F.col("head")))
        .select(
            *[F.coalesce(F.col("header")[n], F.lit("")).alias(n) for n in HEADER_NAMES if n != "timestamp"],
            envelope_time(F.col("header")["timestamp"]).alias("timestamp"),
            payload_of(F.col("value"), F.col("head")).alias("payload"),
            *kept,
        )
    )


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per manifest file; `manifest` is NULL where the file cannot be parsed."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .text(f"{root.rstrip('/')}/{MANIFESTS}", wholetext=True)
        .select(F.col("_metadata.file_path").alias("manifest_path"), "value")
    )
    parsed = F.from_json(
        "value", f"{MANIFEST}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return files.withColumn("m", parsed).select(
        "manifest_path",
        F.when(
            F.col("m").isNotNull() & F.col("m._corrupt").isNull(), F.col("m").dropFields("_corrupt")
        ).alias("manifest"),
    )


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Key and size of every object. The content column is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(raw_root(root))
        .select(object_key_of(F.col("path")).alias("object_key"), F.col("length").alias("compressed"))
    )


def object_versions(spark: SparkSession, root: str) -> DataFrame:
    """Key, size and time of every object: what tells its versions apart. No content is read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw_root(root))
        .select(
            object_key_of(F.col("path")).alias("object_key"), F.col("length").alias("compressed"),
            F.col("modificationTime").alias("modified"),
        )
    )


def object_folders(objects: DataFrame, root: str) -> list[str]:
    """The folders that hold some objects (`object_key`)."""
    folder = F.regexp_extract("object_key", "^(.*)/[^/]*$", 1).alias("folder")
    return [f"{root.rstrip('/')}/{r.folder}" for r in objects.select(folder).distinct().toLocalIterator()]


# --- object scan -------------------------------------------------------------------

# The Python functions below travel to the executors by value: they need neither this
# package installed there nor a shared working directory.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A gzip object is read whole by one task; a larger one is reported, not read.
MAX_OBJECT_BYTES = 1 << 30
# Content goes to Python in pieces, so that its memory does not grow with the objects.
PIECE_BYTES = 4 << 20
_SLICE = 1 << 20
_BLOCK = 1 << 20
_KEY = PAYLOAD_KEY.encode()
_OBJECT_LINES = pa.schema(
    [
        ("object_key", pa.string()),
        ("line", pa.binary()),
        ("head", pa.binary()),
        ("uncompressed", pa.int64()),
        ("error", pa.string()),
    ]
)
OBJECT_LINES = "object_key string, line binary, head binary, uncompressed bigint, error string"


def _inflate(pieces: Iterable[memoryview]) -> Iterator[bytes]:
    """Blocks of bounded size from one or several concatenated gzip members."""
    member = zlib.decompressobj(wbits=31)
    for piece in pieces:
        for start in range(0, len(piece), _SLICE):
            data = bytes(piece[start : start + _SLICE])
            while data:
                if member.eof:
                    member = zlib.decompressobj(wbits=31)
                block = member.decompress(data, _BLOCK)
                if block:
                    yield block
                data = member.unused_data if member.eof else member.unconsumed_tail
    if not member.eof:
        raise EOFError("unexpected end of gzip data")


def _line_batches(key: str, content: memoryview | Iterable[memoryview], heads: bool) -> Iterator[pa.RecordBatch]:
    """The lines of one object in blocks, then one row with its size or its error. With ``heads`` a
    line ends behind its payload key."""
    total, rest, error = 0, b"", None
    try:
        for block in _inflate([content] if isinstance(content, memoryview) else content):
            total += len(block)
            *lines, rest = (rest + block).split(b"\n")
            yield _as_batch(key, lines, heads)
        if rest:
            yield _as_batch(key, [rest], heads)
    except (zlib.error, EOFError) as failure:
        error = f"{failure}"
    yield pa.RecordBatch.from_pylist(
        [{"object_key": key, "line": None, "head": None, "uncompressed": total, "error": error}],
        schema=_OBJECT_LINES,
    )


def _as_batch(key: str, lines: list[bytes], heads: bool) -> pa.RecordBatch:
    """Lines and what is in front of their payload keys, as `head_of` finds it."""
    n = len(lines)
    found = [line.partition(_KEY)[:2] for line in lines]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key], pa.string()).take(pa.array([0] * n, pa.int32())),
            pa.array([head + at for head, at in found] if heads else lines, pa.binary()),
            pa.array([head for head, _ in found], pa.binary()),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.string()),
        ],
        schema=_OBJECT_LINES,
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool, memoryview]]:
    for batch in batches:
        for key, last, content in zip(batch.column("object_key"), batch.column("last"), batch.column("content")):
            yield key.as_py(), last.as_py(), memoryview(content.as_buffer())


def _split_objects(batches: Iterator[pa.RecordBatch], heads: bool = False) -> Iterator[pa.RecordBatch]:
    """Lines of objects whose pieces come one after the other, in order."""
    pieces = _pieces(batches)

    def content(last: bool, piece: memoryview) -> Iterator[memoryview]:
        yield piece
        while not last:
            _, last, piece = next(pieces)
            yield piece

    for key, last, piece in pieces:
        own = content(last, piece)
        yield from _line_batches(key, own, heads)
        for _ in own:  # what is left of a damaged object
            pass


def _split_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _split_objects(batches, heads=True)


def _object_files(
    spark: SparkSession, root: str, paths: Sequence[str] | None, unit: str | None, too_large: bool = False
) -> DataFrame:
    """Objects with their content, or those whose content is too large to be read, without it."""
    reader = spark.read.format("binaryFile")
    if paths is None:
        files = reader.option("recursiveFileLookup", "true").load(raw_root(root))
    else:
        files = reader.option("basePath", raw_root(root)).load(list(paths))
        if unit is not None:
            # The unit itself or its flushes.
            files = files.where((F.col("unit") == unit) | F.col("unit").startswith(f"{unit}-"))
    size, names = F.col("length"), [object_key_of(F.col("path")).alias("object_key"), F.col("length")]
    if too_large:
        return files.where(size > MAX_OBJECT_BYTES).select(*names)
    return files.where(size <= MAX_OBJECT_BYTES).select(*names, "content")


def _whole(line: Column) -> Column:
    """A line with all that is in it, and what is wrong with it."""
    return F.from_json(
        line,
        f"{ENVELOPE_HEADER}, payload map<string,string>, _corrupt string",
        {"columnNameOfCorruptRecord": "_corrupt"},
    )


def _undecodable(parsed: Column) -> Column:
    time = parsed["timestamp"]
    return (
        parsed.isNull()
        | parsed["_corrupt"].isNotNull()
        | (time.isNotNull() & envelope_time(time).isNull())
    )


def _inflated(
    spark: SparkSession, root: str, paths: Sequence[str] | None, unit: str | None, heads: bool = False
) -> DataFrame:
    """Lines of the objects, each tagged with size, checksum and key of its object; with ``heads``
    without their payloads, which then never leave Python."""
    files = _object_files(spark, root, paths, unit).select(
        # Size and checksum travel with the key: Python need not see them.
        F.concat_ws("|", F.col("length").cast("string"), F.sha2("content", 256), "object_key").alias(
            "object_key"
        ),
        "content",
    )
    size, at = F.octet_length("content"), F.col("at")
    starts = F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(PIECE_BYTES))
    pieces = files.select("object_key", "content", F.explode(starts).alias("at")).select(
        "object_key", (at + PIECE_BYTES >= size).alias("last"),
        F.substr("content", at + 1, F.lit(PIECE_BYTES)).alias("content"),
    )
    return (
        pieces.mapInArrow(_split_heads if heads else _split_objects, OBJECT_LINES)
        .withColumn("text", F.col("line").cast("string"))
        .withColumn("is_line", F.col("line").isNotNull() & (F.trim("text") != ""))
        .withColumn("head", F.col("head").cast("string"))
        .withColumn("header", F.when(F.col("is_line"), header_of(F.col("text"), F.col("head"))))
        .withColumnRenamed("object_key", "tag")
    )


def _measures() -> list[Column]:
    """Numbers and times only: a text among them (the error is a key) would have all lines sorted by object."""
    time = F.col("header.timestamp")
    known = F.when(time != ZERO_TIME_TEXT, envelope_time(time))
    return [
        F.count_if("is_line").alias("records"),
        F.min(known).alias("first"),
        F.max(known).alias("last"),
        F.max("uncompressed").alias("uncompressed"),
    ]


def _untagged(counted: DataFrame) -> DataFrame:
    tag = F.split("tag", r"\|", 3)
    return counted.select(
        tag[2].alias("object_key"), tag[0].cast("bigint").alias("compressed"), tag[1].alias("sha256"),
        *[c for c in counted.columns if c != "tag"],
    )


def describe_stored(
    spark: SparkSession, root: str, paths: Sequence[str] | None = None, unit: str | None = None
) -> DataFrame:
    """Facts for the manifests of objects just written. Payloads are not parsed."""
    counted = _inflated(spark, root, paths, unit, heads=True).groupBy("tag", "error").agg(*_measures())
    # A row for each object, or two for a damaged one.
    facts = counted.groupBy("tag").agg(
        F.sum("records").alias("records"), F.min("first").alias("first_ts"), F.max("last").alias("last_ts"),
        F.max("uncompressed").alias("uncompressed"), F.max("error").alias("error"),
    )
    return _untagged(facts)


def scan_objects(
    spark: SparkSession,
    root: str,
    paths: Sequence[str] | None = None,
    unit: str | None = None,
    line_ref: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """What each object holds, per object and source of its records.

    With ``line_ref`` (of source and payload) also per event type and identifier, for a
    comparison with a ledger: the identifier is taken from a line where it is inflated, and
    no payload is shuffled.

    One pass over the stored bytes: Python only inflates an object into lines, the
    lines are parsed and counted by Spark. All lines of an object are counted in the
    task that inflated it, so only a few counters per object are shuffled. A damaged
    object yields an error instead of failing the scan.
    """
    lines = _inflated(spark, root, paths, unit).withColumn("whole", F.when(F.col("is_line"), _whole(F.col("text"))))
    source = F.when(F.col("is_line"), F.coalesce("header.source", F.lit("")))
    bad = F.col("is_line") & F.coalesce(_undecodable(F.col("whole")), F.lit(True))
    keys = [source.alias("line_source")]
    if line_ref is not None:
        lines = lines.withColumn("payload", payload_of(F.col("text"), F.col("head")))
        keys += [
            F.when(F.col("is_line"), F.col("header.event_type")).alias("line_type"),
            F.when(F.col("is_line"), line_ref(source, F.col("payload"))).alias("line_id"),
        ]
    counted = _untagged(lines.groupBy("tag", "error", *keys).agg(*_measures(), F.count_if(bad).alias("bad_lines")))
    size = F.col("length").cast("string")
    large = _object_files(spark, root, paths, unit, too_large=True).select(
        "object_key", F.col("length").alias("compressed"), F.lit(0).cast("bigint").alias("records"),
        F.lit(0).cast("bigint").alias("bad_lines"), F.concat(F.lit("too large to be read: bytes "), size).alias("error"),
    )
    return counted.unionByName(large, allowMissingColumns=True)


def object_facts(scan: DataFrame) -> DataFrame:
    """One row per object from `scan_objects`."""
    facts = scan.groupBy("object_key").agg(
        F.first("compressed").alias("compressed"),
        F.first("sha256").alias("sha256"),
        F.sum("records").alias("records"),
        F.max("uncompressed").alias("uncompressed"),
        F.min("first").alias("first_ts"),
        F.max("last").alias("last_ts"),
        F.sum("bad_lines").alias("bad_lines"),
        F.max("error").alias("read_error"),
    )
    undecodable = F.when(
        F.col("bad_lines") > 0,
        F.concat(F.col("bad_lines").cast("string"), F.lit(" undecodable line(s)")),
    )
    return facts.select(
        "object_key", "records", "compressed", "uncompressed", "sha256", "first_ts", "last_ts",
        F.coalesce("read_error", undecodable).alias("error"),
    )
