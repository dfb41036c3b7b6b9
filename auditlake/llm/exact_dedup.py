"""Exact copies by two-pass Bloom filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import lower_ascii, mix64, stage, without

# Hashes a segment of the filter is made for, cells for each hash, cells a hash sets.
SEGMENT_ROWS = 1 << 15
CELLS_PER_ROW = 16
PROBES = 4
# The filter is sent to the executors up to this size: 16 bits for each of 64 million rows. Beyond it
# the hashes are sent to the filter.
FILTER_LIMIT = 128 << 20

# Columns of this module's own, which a table may have too.
OWN = ("__id", "__h", "__maybe", "__row", "__best")
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def filter_segments(rows: int) -> int:
    """A power of two that grows with the rows."""
    return 1 << max(3, (max(rows, 1) - 1).bit_length() - (SEGMENT_ROWS.bit_length() - 1))


def cells(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash, and its cells inside (one row for each probe)."""
    h = mix64(hashes.view(np.uint64))
    bits = np.uint64(segments.bit_length() - 1)
    segment = (h >> (np.uint64(64) - bits)).astype(np.int64)
    step = mix64(h ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    size = np.uint64(SEGMENT_ROWS * CELLS_PER_ROW)
    at = np.stack([(h + np.uint64(i) * step) % size for i in range(PROBES)])
    return segment, at.astype(np.uint32)


def filter_twice(hashes: DataFrame, segments: int) -> DataFrame:
    """(segment, bits): the cells that two rows or more have set, by one long column ``h``.

    A task sends each cell once, with a mark if several of its rows set it, so a text that a
    third of all rows share weighs no more than others."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment, at = cells(batch.column(0).to_numpy(), segments)
            size = SEGMENT_ROWS * CELLS_PER_ROW
            flat, n = np.unique((segment * size + at).ravel(), return_counts=True)
            found, first = np.unique(flat // size, return_index=True)
            ends = [*first[1:], len(flat)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.int64()),
                    pa.array([(flat[a:b] % size).astype("<u4").tobytes() for a, b in zip(first, ends)], pa.binary()),
                    pa.array([(n[a:b] > 1).tobytes() for a, b in zip(first, ends)], pa.binary()),
                ],
                names=["segment", "cells", "again"],
            )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        at = np.frombuffer(b"".join(group["cells"]), "<u4")
        again = np.frombuffer(b"".join(group["again"]), bool)
        found, n = np.unique(at, return_counts=True)
        bits = np.zeros(SEGMENT_ROWS * CELLS_PER_ROW, bool)
        bits[found[n > 1]] = True
        bits[at[again]] = True
        return pd.DataFrame({"segment": group["segment"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    return (
        hashes.mapInArrow(partial, "segment long, cells binary, again binary")
        .groupBy("segment")
        .applyInPandas(merge, "segment long, bits binary")
    )


def hits(bits: bytes, at: np.ndarray) -> np.ndarray:
    """Which hashes have all their cells (one row for each probe) set in a segment."""
    found = np.frombuffer(bits, np.uint8)
    return ((found[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def found_again(hashes: DataFrame, segments: int) -> DataFrame:
    """(h): the hashes that the filter takes for repeated. Each different hash meets its segment once, and a
    segment is made for so many hashes, however many rows share one."""

    @F.pandas_udf("long")
    def segment_of(h: pd.Series) -> pd.Series:
        return pd.Series(cells(h.to_numpy(), segments)[0])

    def probe(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        h = asked["h"].to_numpy()
        if not len(h) or there.empty:
            return pd.DataFrame({"h": h[:0]})
        return pd.DataFrame({"h": h[hits(there["bits"].iloc[0], cells(h, segments)[1])]})

    asked = hashes.select(F.col("__h").alias("h")).distinct().withColumn("segment", segment_of("h"))
    filters = filter_twice(hashes, segments)
    return asked.groupBy("segment").cogroup(filters.groupBy("segment")).applyInPandas(probe, "h long")


def with_maybe(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``__maybe``: their hash ``__h`` is possibly there twice, never false for
    one that is."""
    spark = rows.sparkSession
    segments = filter_segments(rows.count())
    if segments * SEGMENT_ROWS * CELLS_PER_ROW // 8 > limit:
        # A filter too large to send: the different hashes go to its segments, 8 bytes for each.
        repeated = found_again(rows.select("__h"), segments).select(F.col("h").alias("__h"), F.lit(True).alias("__maybe"))
        return rows.join(repeated, "__h", "left").withColumn("__maybe", F.coalesce("__maybe", F.lit(False)))
    found = filter_twice(rows.select("__h"), segments).collect()
    sent = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in found})

    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        segment, at = cells(h.to_numpy(), segments)
        out = np.zeros(len(h), bool)
        for s in np.unique(segment):
            mine = np.flatnonzero(segment == s)
            if int(s) in sent.value:
                out[mine] = hits(sent.value[int(s)], at[:, mine])
        return pd.Series(out)

    return rows.withColumn("__maybe", probe("__h"))


def mark_copies(
    docs: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, limit: int = FILTER_LIMIT
) -> DataFrame:
    """One row for each document: the columns ``keep`` (default: all), then ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so null and empty
    texts are copies of each other. The row with the largest id stays (any id is larger than
    null); of several such rows one stays. Columns of ``docs`` with the four names are replaced.
    An empty table gives an empty result.

    Pass 1 counts hashes in a filter of two bits' meaning (once, twice or more). Pass 2 looks
    each row up: rows that are not there twice go straight to the result, the others alone are
    shuffled and compared by their SHA-256.
    """
    docs = without(docs, *RESULT)
    clash = [c for c in docs.columns if c.lower() in OWN]
    if clash:
        # Other names while the work is done.
        there = {c: f"{c}_of_table" for c in clash}
        marked = mark_copies(
            docs.withColumnsRenamed(there), there.get(id_col, id_col), there.get(text_col, text_col),
            [there.get(c, c) for c in keep] if keep else None, limit,
        )
        return marked.withColumnsRenamed({new: old for old, new in there.items()})
    columns = [c for c in (keep or docs.columns) if c not in RESULT]
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(
        *columns,
        F.col(id_col).alias("__id"),
        F.xxhash64(text).alias("__h"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )
    if text_col not in columns:
        rows = stage(rows, "dedup-keys")
    rows = with_maybe(rows, limit)
    single = rows.where(~F.col("__maybe")).select(
        *columns,
        F.col("__id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # The number tells equal rows apart; it has to be written down, as a rerun may change it.
    several = stage(
        rows.where("__maybe").withColumn("__row", F.monotonically_increasing_id()), "dedup-several"
    )
    groups = stage(
        several.groupBy("text_sha256").agg(
            F.max(F.struct("__id", "__row")).alias("__best"), F.count("*").alias("group_size")
        ),
        "dedup-groups",
    )
    several = several.join(groups, "text_sha256").select(
        *columns,
        F.col("__best.__id").alias("keep_id"),
        "group_size",
        (F.col("__best.__row") == F.col("__row")).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(several)
