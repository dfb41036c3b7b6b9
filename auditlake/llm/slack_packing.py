"""Packing of tokenised documents by minimum bin slack: windows filled as close to capacity as can be."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.byte_pairs import encoder
from auditlake.llm.common import slices
from auditlake.session import workspace

SEQUENCE = 2048
END_ID = 1
# So many pieces wait in a task before windows are filled from them, and so many may be left for later.
WAITING, LEFT = 8192, 512


class Piece(NamedTuple):
    """Ids ``data`` (little-endian unsigned 32-bit) of a document, from ``start`` on."""

    ident: object
    start: int
    data: bytes
    tokens: int

    def length(self) -> int:
        return len(self.data) // 4

    def split(self, at: int) -> tuple[Piece, Piece]:
        head = self._replace(data=self.data[: 4 * at])
        return head, self._replace(start=self.start + at, data=self.data[4 * at :])


def closest(counts: Mapping[int, int], sizes: list[int], capacity: int) -> dict[int, int]:
    """The multiset of sizes (how many of each) whose sum comes closest to ``capacity`` from below.

    ``sizes`` are those with a count, ascending. Bit b of ``reached`` says that b is a sum of what was
    looked at; a count is taken in binary parts, the longest size first, until the capacity itself is
    reached. Going back over the steps, a part is taken where its sum was not reached without it.
    """
    reached, steps = 1, []
    mask, goal = (1 << capacity + 1) - 1, 1 << capacity
    for at in range(bisect_right(sizes, capacity) - 1, -1, -1):
        size = sizes[at]
        left, part = min(counts[size], capacity // size), 1
        while left and not reached & goal:
            part = min(part, left)
            more = (reached | reached << part * size) & mask
            if more != reached:
                steps.append((size, part, reached))
                reached = more
            left, part = left - part, 2 * part
        if reached & goal:
            break
    total, picked = reached.bit_length() - 1, {}
    for size, part, before in reversed(steps):
        if not before >> total & 1:
            picked[size] = picked.get(size, 0) + part
            total -= part * size
    return picked


class Pool:
    """Pieces that wait for a window."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.waiting: dict[int, list[Piece]] = {}
        self.counts: dict[int, int] = {}
        self.pieces = self.ids = 0

    def add(self, piece: Piece) -> None:
        n = piece.length()
        self.waiting.setdefault(n, []).append(piece)
        self.counts[n] = self.counts.get(n, 0) + 1
        self.pieces, self.ids = self.pieces + 1, self.ids + n

    def take(self, size: int) -> Piece:
        piece = self.waiting[size].pop()
        self.counts[size] -= 1
        if not self.counts[size]:
            del self.counts[size], self.waiting[size]
        self.pieces, self.ids = self.pieces - 1, self.ids - size
        return piece

    def best(self, longest: int, sizes: list[int]) -> dict[int, int]:
        """The fullest window that holds a piece of the size ``longest``."""
        self.counts[longest] -= 1
        picked = closest(self.counts, sizes, self.capacity - longest)
        self.counts[longest] += 1
        picked[longest] = picked.get(longest, 0) + 1
        return picked

    def exact(self) -> Iterator[list[Piece]]:
        """Windows without any slack, each pattern as often as the counts allow."""
        sizes = sorted(self.counts)
        for longest in sizes[::-1]:
            while longest in self.counts:
                picked = self.best(longest, sizes)
                if sum(s * n for s, n in picked.items()) < self.capacity:
                    break
                for _ in range(min(self.counts[s] // n for s, n in picked.items())):
                    yield [self.take(s) for s, n in picked.items() for _ in range(n)]
                gone = [s for s in picked if s not in self.counts]
                for s in gone:
                    sizes.remove(s)

    def cutting(self, keep: int) -> Iterator[list[Piece]]:
        """Fullest windows whose slack the beginning of another piece fills, until few pieces wait.

        A piece that would fit whole would be in the window, so every other one is longer than the slack.
        """
        while self.pieces > keep and self.ids >= self.capacity:
            sizes = sorted(self.counts)
            picked = self.best(sizes[-1], sizes)
            window = [self.take(s) for s, n in picked.items() for _ in range(n)]
            slack = self.capacity - sum(s * n for s, n in picked.items())
            if slack:
                head, rest = self.take(max(self.counts)).split(slack)
                window.append(head)
                self.add(rest)
            yield window

    def rest(self) -> Iterator[list[Piece]]:
        """What is left, less than a window, in windows whose lengths are powers of two."""
        pieces = [self.take(s) for s in sorted(self.counts, reverse=True) for _ in range(self.counts[s])]
        left = sum(p.length() for p in pieces)
        while left:
            room, window = 1 << left.bit_length() - 1, []
            left -= room
            while room:
                piece = pieces.pop()
                if piece.length() > room:
                    piece, more = piece.split(room)
                    pieces.append(more)
                window.append(piece)
                room -= piece.length()
            yield window

    def all(self) -> Iterator[Piece]:
        for pieces in self.waiting.values():
            yield from pieces


def _fill(source: Iterator[Piece | None], turn: int, capacity: int, waiting: int, left: int, last: bool, ids: bool):
    """Column lists of the pieces, placed or left; ``None`` in the source lets go what is there so far."""
    pool, number, rows = Pool(capacity), (turn << 58) + (TaskContext.get().partitionId() << 32), []

    def put(window: list[Piece]) -> None:
        nonlocal number
        offset = 0
        for p in window:
            kept = p.data if ids else None
            rows.append((p.ident, p.start, p.length(), zlib.crc32(p.data), p.tokens, number, offset, kept, False))
            offset += p.length()
        number += 1

    for piece in source:
        if piece is None:
            if rows:
                yield rows
            rows = []
        elif piece.length() == capacity:
            put([piece])
        else:
            pool.add(piece)
            if pool.pieces >= waiting:
                for window in pool.exact():
                    put(window)
                for window in pool.cutting(waiting // 2):
                    put(window)
    for window in pool.exact():
        put(window)
    for window in pool.cutting(0 if last else left):
        put(window)
    if last:
        for window in pool.rest():
            put(window)
    rows += [(p.ident, p.start, p.length(), 0, p.tokens, None, None, p.data, True) for p in pool.all()]
    if rows:
        yield rows


NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "left"]
TYPES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, left boolean"


def _batches(filled, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    types = [kind, *[pa.int64()] * 6, pa.binary(), pa.bool_()]
    for rows in filled:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=NAMES)


def _kept(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The placed pieces and those left for later, written apart and read again."""
    path = workspace(df.sparkSession, "slack-pieces")
    df.write.partitionBy("left").option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    return found.where(~F.col("left")), found.where("left")


def pack_documents(
    docs: DataFrame,
    ident: str,
    text: str,
    tokenizer: str,
    length: int = SEQUENCE,
    *,
    end_id: int = END_ID,
    ids: bool = False,
    waiting: int = WAITING,
    left: int = LEFT,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece.

    A task encodes its documents, cuts whole sequences from the beginning of longer ones and fills windows
    from the pieces that wait: first windows without slack; where more than half of ``waiting`` pieces stay,
    fullest windows with the slack filled by cutting another piece. At most ``left`` pieces of a task go on
    to a next turn with fewer tasks; in the last one, of one task with at most ``waiting`` pieces, everything
    is placed and less than one window is cut into powers of two. So nothing is padded, and a task holds
    no more than ``waiting`` pieces.

    Null texts count as empty (one id, the end id). Repeated rows are documents of their own, null ids stay
    null, an empty table gives no rows; other columns of ``docs`` are not kept.
    """
    end = end_id.to_bytes(4, "little")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        first = next(batches, None)
        if first is None:
            return

        def pieces() -> Iterator[Piece | None]:
            for batch in slices(_chain(first, batches)):
                for own, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    data = encode(t or "") + end
                    tokens = len(data) // 4
                    for at in range(0, tokens, length):
                        yield Piece(own, at, data[4 * at : 4 * (at + length)], tokens)
                yield None

        yield from _batches(_fill(pieces(), 0, length, waiting, left, False, ids), first.schema.field(0).type)

    def go_on(turn: int, last: bool):
        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches, None)
            if first is None:
                return

            def pieces() -> Iterator[Piece | None]:
                for batch in slices(_chain(first, batches)):
                    yield from map(Piece._make, zip(*(c.to_pylist() for c in batch.columns), strict=True))
                    yield None

            yield from _batches(_fill(pieces(), turn, length, waiting, left, last, ids), first.schema.field(0).type)

        return fill

    schema = f"id {docs.schema[ident].dataType.simpleString()}, {TYPES}"
    placed, later = _kept(docs.select(F.col(ident).alias("id"), F.col(text).alias("text")).mapInArrow(begin, schema))
    done, turn = placed, 0
    while n := later.count():
        turn, tasks = turn + 1, -(-n // waiting)
        source = later.select("id", "start", "ids", "doc_tokens").repartition(tasks)
        placed, later = _kept(source.mapInArrow(go_on(turn, tasks == 1), schema))
        done = done.unionByName(placed)
    return done.select(*NAMES[:7], *(["ids"] if ids else []))


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest
