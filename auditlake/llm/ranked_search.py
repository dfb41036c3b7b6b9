"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import slices, stage

TOP = 10
# Fixed values of the measure.
UNIT, SLOPE, LENGTH_SHARE, FULL = 1_000_000_000, 8, 90, 100
# Terms of the queries sent to the tasks at once; more queries take more turns over the documents.
TERMS_SENT = 400_000
# A block of documents is full with so many documents, or so many postings.
BLOCK_DOCS, BLOCK_POSTINGS = 2048, 1 << 20
# Lists that hold together at most this share of a block's documents are summed before the others.
SHORT_SHARE = 0.25
# Documents looked at between two looks at the threshold.
CHUNK = 512
# Results of tasks are cut to the best in so many parts before they meet.
PARTS = 256

# Bytes of term characters (A-Z in lower case), a space for every other: digits, letters and all beyond ASCII.
_TERM = bytes(c if c > 127 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order; none for null."""
    return text.encode().translate(_TERM).split() if text else []


class Block(NamedTuple):
    """Posting lists of some documents: list k, of term ``terms[k]``, lies at ``ends[k-1]:ends[k]``."""

    ids: Sequence
    lengths: np.ndarray
    terms: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    counts: np.ndarray


def impacts(block: Block, many: int, total: int) -> np.ndarray:
    """What each posting gives for a term of weight 1."""
    longest = int(block.lengths.max(initial=0))
    if LENGTH_SHARE * longest * many < 1 << 63:
        share = (LENGTH_SHARE * many * block.lengths) // total
    else:
        share = np.array([LENGTH_SHARE * many * n // total for n in block.lengths.tolist()], np.int64)
    m = FULL - LENGTH_SHARE + share
    return (UNIT * block.counts) // (1000 * block.counts + SLOPE * m[block.docs])


class Entries(NamedTuple):
    """A list as the search walks it: documents ascending, their scores, and a bound of these."""

    docs: np.ndarray
    scores: np.ndarray
    bound: int


def summed(lists: list[Entries], size: int) -> Entries:
    """Accumulators of lists taken term at a time, as one list."""
    if len(lists) == 1:
        return lists[0]
    sums = np.zeros(size, np.int64)
    for one in lists:
        sums[one.docs] += one.scores
    docs = np.flatnonzero(sums)
    return Entries(docs, sums[docs], int(sums.max(initial=0)))


class Best:
    """The best (score, id) found for a query so far: higher scores, then smaller ids (null last)."""

    def __init__(self, top: int):
        self.top, self.found = top, []

    def threshold(self) -> int:
        """The least score that can still matter."""
        return max(1, self.found[-1][0]) if len(self.found) == self.top else 1

    def add(self, found: list[tuple[int, object]]) -> None:
        self.found += found
        self.found.sort(key=lambda f: (-f[0], f[1] is None, 0 if f[1] is None else f[1]))
        del self.found[self.top :]


def walk(lists: list[Entries], ids: Sequence, best: Best) -> None:
    """Add the documents of a block that can be among the best of a query.

    Short lists are summed first; their accumulators are one more list. Lists in the order of their
    bounds: those whose bounds together stay below the threshold cannot bring a document in, so
    only the documents of the others are candidates. A candidate skips into the next list as long as
    what it has and the bounds still to come reach the threshold, which rises from chunk to chunk.
    """
    lists = sorted((one for one in lists if len(one.docs)), key=lambda one: len(one.docs))
    if not lists:
        return
    size, room, short = len(ids), SHORT_SHARE * len(ids), 0
    while short < len(lists) and room >= len(lists[short].docs):
        room -= len(lists[short].docs)
        short += 1
    if short > 1:
        lists = [summed(lists[:short], size), *lists[short:]]
    lists.sort(key=lambda one: one.bound)
    below = np.cumsum([0, *(one.bound for one in lists)]).tolist()
    optional = _optional(below, best.threshold())
    if optional == len(lists):
        return
    sums = np.zeros(size, np.int64)
    for one in lists[optional:]:
        sums[one.docs] += one.scores
    candidates = np.flatnonzero(sums)
    for at in range(0, len(candidates), CHUNK):
        docs = candidates[at : at + CHUNK]
        scores = sums[docs]
        least = best.threshold()
        for k in range(optional - 1, -1, -1):
            alive = scores + below[k + 1] >= least
            docs, scores = docs[alive], scores[alive]
            if not len(docs):
                break
            one = lists[k]
            place = np.searchsorted(one.docs, docs)
            place[place == len(one.docs)] = 0
            scores = scores + np.where(one.docs[place] == docs, one.scores[place], 0)
        alive = scores >= least
        if alive.any():
            best.add([(int(s), ids[d]) for s, d in zip(scores[alive], docs[alive], strict=True)])


def _optional(below: list[int], threshold: int) -> int:
    """How many lists, by ascending bound, cannot reach the threshold together."""
    n = 0
    while n + 1 < len(below) and below[n + 1] < threshold:
        n += 1
    return n


def search_block(block: Block, weights: np.ndarray, queries: dict[int, np.ndarray], stats: tuple[int, int], best: dict) -> None:
    """Add what a block holds to the best of each query: ``queries`` are sorted term numbers by number of query."""
    if not len(block.terms):
        return
    each = impacts(block, *stats)
    starts = np.concatenate([[0], block.ends[:-1]])
    most = np.maximum.reduceat(each, starts)
    for number, wanted in queries.items():
        at = np.searchsorted(block.terms, wanted)
        there = at < len(block.terms)
        at, wanted = at[there], wanted[there]
        at = at[block.terms[at] == wanted]
        lists = []
        for k in at.tolist():
            weight = int(weights[block.terms[k]])
            if weight > 0:
                part = slice(starts[k], block.ends[k])
                lists.append(Entries(block.docs[part], weight * each[part], weight * int(most[k])))
        walk(lists, block.ids, best[number])


INDEX = "lengths binary, terms binary, ends binary, docs binary, counts binary, docs_with long, terms_in long"


def index(docs: DataFrame, ident: str, text: str, vocabulary) -> DataFrame:
    """One row for each block of documents with its posting lists for the terms of a (broadcast) vocabulary."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        kind, ids, lengths, found, counts, owners = None, [], [], [], [], []

        def block() -> pa.RecordBatch:
            t, d, c = (np.array(x, np.int32) for x in (found, owners, counts))
            order = np.argsort(t, kind="stable")
            t, d, c = t[order], d[order], c[order]
            ends = np.append(np.flatnonzero(np.diff(t)) + 1, len(t)) if len(t) else np.zeros(0, np.int64)
            data = (np.array(lengths, np.int64), t[ends - 1], ends.astype(np.int64), d, c)
            columns = [
                pa.array([ids], pa.list_(kind)),
                *(pa.array([x.tobytes()], pa.binary()) for x in data),
                pa.array([sum(n > 0 for n in lengths)], pa.int64()),
                pa.array([sum(lengths)], pa.int64()),
            ]
            for x in (ids, lengths, found, counts, owners):
                x.clear()
            names = ["ids", "lengths", "terms", "ends", "docs", "counts", "docs_with", "terms_in"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in slices(batches):
            kind = batch.schema.field(0).type
            for own, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms(t)
                seen = Counter(k for k in map(known.get, words) if k is not None)
                found.extend(seen)
                counts.extend(seen.values())
                owners.extend([len(ids)] * len(seen))
                ids.append(own)
                lengths.append(len(words))
                if len(ids) >= BLOCK_DOCS or len(found) >= BLOCK_POSTINGS:
                    yield block()
        if ids:
            yield block()

    rows = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(build, f"ids array<{kind}>, {INDEX}")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in slices(batches, 1):
        ids, *rest = (batch.column(k)[0] for k in range(6))
        lengths, known, ends, docs, counts = (x.as_py() for x in rest)
        as64 = lambda x: np.frombuffer(x, np.int32).astype(np.int64)
        yield Block(
            ids.as_py(), np.frombuffer(lengths, np.int64), as64(known), np.frombuffer(ends, np.int64), as64(docs), as64(counts)
        )


def term_counts(blocks: DataFrame) -> DataFrame:
    """(term, df): in how many documents each term of the vocabulary lies; summed in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in slices(batches, 1):
            known, ends = (np.frombuffer(batch.column(k)[0].as_py(), t) for k, t in ((0, np.int32), (1, np.int64)))
            sums.update(dict(zip(known.tolist(), np.diff(ends, prepend=0).tolist(), strict=True)))
        columns = [pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "df"])

    found = blocks.select("terms", "ends").mapInArrow(count, "term int, df long")
    return found.groupBy("term").agg(F.sum("df").alias("df"))


def _turn(docs: DataFrame, ident: str, text: str, asked: DataFrame, top: int) -> DataFrame:
    """(number, score, id): each task's best documents for some queries (``number``, ``words``)."""
    spark = docs.sparkSession
    rows = asked.collect()
    names = sorted({w for r in rows for w in r.words})
    numbers = {bytes(w): k for k, w in enumerate(names)}
    known = spark.sparkContext.broadcast(numbers)
    blocks = stage(index(docs, ident, text, known), "search-blocks")
    sums = blocks.agg(F.sum("docs_with").alias("n"), F.sum("terms_in").alias("l")).head()
    many, total = sums.n or 0, sums.l or 0
    weights = np.zeros(len(names), np.int64)
    for r in term_counts(blocks).collect():
        weights[r.term] = math.floor(1000 * math.log((2 * many + 2) / (2 * r.df + 1)))
    queries = {r.number: np.array(sorted(numbers[bytes(w)] for w in r.words), np.int64) for r in rows}
    sent = spark.sparkContext.broadcast((weights, queries))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = sent.value
        best = {number: Best(top) for number in queries}
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type.value_type
            for block in _blocks(iter([batch])):
                search_block(block, weights, queries, (many, total), best)
        if kind is None:
            return
        found = [(number, score, own) for number, b in best.items() for score, own in b.found]
        columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())]
        part = pa.array([TaskContext.get().partitionId() % PARTS] * len(found), pa.int32())
        ids = pa.array([f[2] for f in found], kind)
        yield pa.RecordBatch.from_arrays([*columns, ids, part], names=["number", "score", "id", "part"])

    kind = docs.schema[ident].dataType.simpleString()
    columns = ["ids", "lengths", "terms", "ends", "docs", "counts"]
    return blocks.select(*columns).mapInArrow(find, f"number long, score long, id {kind}, part int")


def rank(
    docs: DataFrame,
    ident: str,
    text: str,
    items: DataFrame,
    item: str,
    item_text: str,
    *,
    top: int = TOP,
    sent: int = TERMS_SENT,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, best first.

    Documents are indexed in blocks, restricted to the terms asked for; every task searches its blocks for all
    queries of a turn and gives its best, which meet in two steps. A turn sends at most about ``sent`` terms.

    Only documents with a score above 0 are listed, equal scores by ascending id (nulls last). Null and empty
    texts have no terms. Repeated documents are documents of their own, repeated items are ranked each.
    Other columns are ignored; without documents or items there are no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [sorted(set(terms(t))) for t in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["number", "item", "words"])

    kind = items.schema[item].dataType.simpleString()
    rows = items.select(
        F.monotonically_increasing_id().alias("number"), F.col(item).alias("item"), F.col(item_text).alias("text")
    )
    asked = stage(rows.mapInArrow(cut, f"number long, item {kind}, words array<binary>"), "search-items")
    size = asked.agg(F.sum(F.size("words"))).head()[0] or 0
    turns = max(1, -(-size // sent))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    found = None
    for turn in range(turns):
        mine = asked.select("number", "words").where(F.pmod(F.xxhash64("number"), F.lit(turns)) == turn)
        one = _turn(docs, ident, text, mine, top)
        found = one if found is None else found.unionByName(one)
    for keys in (["number", "part"], ["number"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", place).where(F.col("rank") <= top)
    return found.join(asked.select("number", "item"), "number").select(
        F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"
    )
