"""Best-fit packing of tokenised documents into sequences of one length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.byte_pairs import encoder
from auditlake.llm.common import slices, stage

SEQUENCE = 1024
END_ID = 2
# Pieces of one length are numbered in blocks of about this share of all pieces.
BLOCKS, BLOCK_ROWS = 64, 1 << 20


def cut(docs: DataFrame, ident: str, text: str, tokenizer: str, length: int = SEQUENCE, ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document with its end id.

    Documents of up to ``length`` ids are one piece. Longer ones are cut from the end into whole
    sequences, so that only the first piece may be shorter. Null texts count as empty.
    """
    end = END_ID.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in slices(batches):
            row, piece, start, size, crc, part = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                data = encode(t or "") + end
                n = len(data) // 4
                first = n if n <= length else n % length or length
                for k, at in enumerate([0, *range(first, n, length)]):
                    to = first if k == 0 else at + length
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    size.append(to - at)
                    crc.append(zlib.crc32(data[4 * at : 4 * to]))
                    if ids:
                        part.append(data[4 * at : 4 * to])
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, size, crc)),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns, names = [*columns, pa.array(part, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[ident].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col(ident).alias("id"), F.col(text).alias("text")).mapInArrow(pieces, schema)


def best_fit(counts: Mapping[int, int], length: int = SEQUENCE) -> dict[int, np.ndarray]:
    """Where the pieces of each size go: rows (first rank, first sequence, offset), by rank.

    One round for each size that is there, the longest first. Its pieces, numbered by rank, meet
    the gaps, sorted by size: the next larger gap is swept first, a gap takes as many as it
    holds, and rank i of the pieces goes to rank i of the gaps. Gaps that took pieces shrink;
    pieces that met no gap open sequences of their own. Sequences with equal contents are one
    interval here, so the state is bounded by the length of a sequence, not by the documents.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # size of gap: (first sequence, how many)
    placed: dict[int, list[tuple[int, int, int]]] = {}
    opened = 0
    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        left, rank, rows = counts[size], 0, []
        fresh = (length, [(opened, -1)])
        for gap, groups in [*sorted((g, v) for g, v in gaps.items() if g >= size), fresh]:
            fit = gap // size
            while left and groups:
                first, many = groups.pop()
                if many < 0:
                    many = -(-left // fit)
                    opened += many
                whole = min(many, left // fit)
                # Sequences that take as many as fit, then one that takes the rest.
                for n, each in ((whole, fit), (int(whole < many and left > whole * fit), left - whole * fit)):
                    if n:
                        for k in range(each):
                            rows.append((rank, first, length - gap + k * size))
                            rank += n
                        gaps.setdefault(gap - each * size, []).append((first, n))
                        first, many, left = first + n, many - n, left - n * each
                if many:
                    groups.append((first, many))
            if not left:
                break
        placed[size] = np.array(rows, np.int64)
    return placed


def pack(pieces: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """``pieces`` (with ``id``, ``piece``, ``length``) and their ``sequence_id`` and ``offset``.

    Pieces are sorted into ranges by length and numbered inside each: counts of (length, block)
    are summed before the shuffle, and a rank is the count of earlier blocks plus the place in
    its own. A length may thus hold any share of the pieces. The rounds of ``best_fit`` run on the
    counts of at most ``length`` sizes; every piece then finds its interval by its rank. Repeated
    rows are pieces of their own; an empty table gives no rows.
    """
    blocks = max(BLOCKS, pieces.count() // BLOCK_ROWS)
    pieces = pieces.withColumn("__block", F.pmod(F.xxhash64("id", "piece"), F.lit(blocks)).cast("int"))
    counts = stage(pieces.groupBy("length", "__block").count(), "pack-counts")
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(best_fit(totals, length))

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(size)), np.int64)
        sizes, ranks = size.to_numpy(), rank.to_numpy()
        for s in np.unique(sizes):
            mine = np.flatnonzero(sizes == s)
            rows = plan.value[int(s)]
            at = np.searchsorted(rows[:, 0], ranks[mine], "right") - 1
            out[0, mine] = rows[at, 1] + ranks[mine] - rows[at, 0]
            out[1, mine] = rows[at, 2]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    before = Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "length", "__block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("length", "__block").orderBy("id", "piece")
    ranked = pieces.join(starts, ["length", "__block"]).withColumn(
        "__place", place("length", F.col("__start") + F.row_number().over(inside) - 1)
    )
    kept = [c for c in pieces.columns if c != "__block"]
    return ranked.select(*kept, "__place.sequence_id", "__place.offset")


def pack_documents(
    docs: DataFrame, ident: str, text: str, tokenizer: str, length: int = SEQUENCE, ids: bool = False
) -> DataFrame:
    """Tokenise, cut and pack: see ``cut`` and ``pack``. Other columns of ``docs`` are not kept."""
    return pack(stage(cut(docs, ident, text, tokenizer, length, ids), "pack-pieces"), length)
