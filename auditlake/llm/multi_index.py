"""Nearest vectors by an inverted multi-index (Babenko and Lempitsky)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import stage

# The centroids are fitted on at most so many vectors, those of the smallest hashes.
FIT_SAMPLE = 20_000
# Recall is measured by brute force for at most so many queries, those of the smallest hashes.
RECALL_SAMPLE = 200
RECALL_TARGET = 0.97
# Vectors that meet in one task, and the queries that meet them there.
BIN_ROWS, BIN_QUERIES = 8192, 4096
CELL_ROWS, MOST_CENTROIDS = 50, 512
# Queries whose cells one task looks up.
PROBE_ROWS = 1000
# Room for the rounding of a matrix product beside the exact score.
SLACK = 1e-9


def usable(rows: DataFrame, ident: str, vector: str) -> DataFrame:
    """(id, vec): vectors of the usual length as doubles in binary form. Null ids, null or zero
    vectors, null or non-finite components and vectors of another length than most take no part."""
    part = F.col("v")
    rows = rows.select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull()
        & F.forall(part, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(part, lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
            packed = pa.array([v.astype("<f8").tobytes() for v in flat], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["id", "vec"])

    rows = rows.where(F.size("v") == (usual.n if usual else 0))
    return rows.mapInArrow(pack, "id long, vec binary")


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of ``x``; the first are spread over it, and one without members stays."""
    k = max(1, min(k, len(x)))
    at = x[np.random.default_rng(7).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, at)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(at)
        np.add.at(sums, near, x)
        at[n > 0] = sums[n > 0] / n[n > 0, None]
    return at


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1) - 2 * x @ centroids.T).argmin(axis=1)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]


def cell_of(x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = halves(x)
    return nearest(a, books[0]) * len(books[1]) + nearest(b, books[1])


def traverse(far: tuple[np.ndarray, np.ndarray], counts: np.ndarray, enough: int) -> list[int]:
    """Cells by the sum of both halves' distances, nearest first, until ``enough`` vectors.

    A pair of ranks is put on the heap once the pairs before it in both directions are out.
    """
    orders = [np.argsort(f, kind="stable") for f in far]
    a, b = (f[o].tolist() for f, o in zip(far, orders))
    first, second = (o.tolist() for o in orders)
    heap, out, found = [(a[0] + b[0], 0, 0)], [], 0
    done = [0] * len(a)  # how many of each row's pairs are out
    while heap and found < enough:
        _, i, j = heapq.heappop(heap)
        cell = first[i] * len(b) + second[j]
        if counts[cell]:
            out.append(cell)
            found += counts[cell]
        done[i] = j + 1
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return out


def distances(q: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How much less than the best inner product each half's centroids give, for each query."""
    got = [h @ book.T for h, book in zip(halves(q), books)]
    return tuple(g.max(axis=1, keepdims=True) - g for g in got)


def best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, allowed=None) -> pd.DataFrame:
    """The ``k`` rows of ``x`` with the largest inner product for each query but those of its own id,
    ties to smaller ids. ``allowed``: which of them count (query, row)."""
    rough = q @ x.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    if allowed is not None:
        rough[~allowed] = -np.inf
    parts = []
    for i, row in enumerate(rough):
        bound = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
        mine = np.flatnonzero((row > -np.inf) & (row >= bound - SLACK * max(1.0, abs(bound) if np.isfinite(bound) else 1.0)))
        score = (x[mine] * q[i]).sum(axis=1)
        order = np.lexsort((ids[mine], -score))[:k]
        parts.append((np.full(len(order), q_ids[i]), ids[mine][order], score[order]))
    return pd.DataFrame({n: np.concatenate([p[i] for p in parts]) for i, n in enumerate(("query_id", "vec_id", "score"))})


RESULT = "query_id long, vec_id long, score double"


def exact_search(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """Brute force for a bounded set of queries: every row is compared where it lies."""
    sent = rows.sparkSession.sparkContext.broadcast((matrix(queries["vec"]), queries["id"].to_numpy()))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield best(*sent.value, matrix(batch["vec"]), batch["id"].to_numpy(), k)

    return ranked(rows.mapInPandas(compare, RESULT), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    rows: DataFrame, ident: str, vector: str, is_query: Column, k: int = 20, recall: float = RECALL_TARGET
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row where ``is_query`` (of
    the column ``id``) holds, among all rows but those of the query's id.

    Nearness is the inner product in double precision; ties go to the smaller id. See ``usable`` for
    rows that take no part. Of repeated query ids the smallest vector asks; repeated rows are
    candidates each. Without rows or queries there is no result.

    The halves of the vectors are quantised apart, by centroids fitted on ``FIT_SAMPLE`` rows.
    Every row is put into the cell of its two centroids. A query goes through the cells by summed
    distance with a heap, and the original vectors of the cells it passes are scored. How many
    vectors it passes is measured: for ``RECALL_SAMPLE`` queries the true neighbours are found by
    brute force, and so many vectors are passed that the share ``recall`` of them is found.

    Cells are gathered in bins, a cell that is larger than a bin is dealt over several, and so are
    the queries that meet in a bin: no cell or vector is too frequent.
    """
    spark = rows.sparkSession
    rows = stage(usable(rows, ident, vector), "vectors")
    total = rows.count()
    queries = rows.where(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    sample = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(FIT_SAMPLE).toPandas()
    tried = queries.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(RECALL_SAMPLE).toPandas()
    if sample.empty or tried.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centroids = int(np.clip(round((total / CELL_ROWS) ** 0.5), 1, MOST_CENTROIDS))
    books = tuple(k_means(h, centroids) for h in halves(matrix(sample["vec"])))
    shared = spark.sparkContext.broadcast(books)

    @F.pandas_udf("int")
    def cell(vec: pd.Series) -> pd.Series:
        return pd.Series(cell_of(matrix(vec), shared.value).astype(np.int32))

    entries = stage(rows.withColumn("cell", cell("vec")), "vector-cells")
    counts = np.zeros(len(books[0]) * len(books[1]), np.int64)
    # A row for each pair of centroids at most.
    for r in entries.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    enough = passed(entries, tried, books, counts, k, recall)
    starts, parts = bins(counts)
    plan = spark.sparkContext.broadcast((counts, starts, parts))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, starts, parts = plan.value
        for batch in batches:
            out = {"bin": [], "query_id": [], "qvec": [], "cells": []}
            a, b = distances(matrix(batch["vec"]), shared.value)
            for i, (ident, vec) in enumerate(zip(batch["id"], batch["vec"])):
                cells = np.array(traverse((a[i], b[i]), counts, enough), np.int32)
                for s in np.unique(starts[cells]):
                    mine = cells[starts[cells] == s]
                    for n in range(parts[mine[0]]):
                        for name, value in zip(out, (s + n, ident, vec, mine.tobytes())):
                            out[name].append(value)
            yield pd.DataFrame(out)

    # A row costs a walk through the cells, whatever its bytes: tasks get so many rows each.
    dealt_out = queries.repartition(max(1, -(-queries.count() // PROBE_ROWS)), "id")
    probes = stage(dealt_out.mapInPandas(probe, "bin long, query_id long, qvec binary, cells binary"), "probes")
    load = stage(
        probes.groupBy("bin").agg(F.ceil(F.count("*") / BIN_QUERIES).cast("int").alias("groups")), "probe-load"
    )
    asked = probes.join(load, "bin").withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int"))

    @F.pandas_udf("long")
    def bin_of(cell: pd.Series, ident: pd.Series) -> pd.Series:
        _, starts, parts = plan.value
        return pd.Series(starts[cell] + ident.to_numpy() % parts[cell])

    # The ids are spread by their hash where a cell is dealt over several bins.
    dealt = entries.withColumn("bin", bin_of("cell", F.xxhash64("id", "vec")))
    dealt = dealt.join(load, "bin").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))

    def rerank(asks: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if asks.empty or there.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        names, place = np.unique(there["cell"].to_numpy(), return_inverse=True)
        x, ids, parts = matrix(there["vec"]), there["id"].to_numpy(), []
        for at in range(0, len(asks), 256):
            some = asks.iloc[at : at + 256]
            wanted = np.zeros((len(some), len(names)), bool)
            for i, c in enumerate(some["cells"]):
                wanted[i] = np.isin(names, np.frombuffer(c, np.int32))
            parts.append(best(matrix(some["qvec"]), some["query_id"].to_numpy(), x, ids, k, wanted[:, place]))
        return pd.concat(parts)

    found = (
        asked.select("bin", "group", "query_id", "qvec", "cells").groupBy("bin", "group")
        .cogroup(dealt.select("bin", "group", "id", "vec", "cell").groupBy("bin", "group"))
        .applyInPandas(rerank, RESULT)
    )
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")


def passed(entries: DataFrame, tried: pd.DataFrame, books, counts: np.ndarray, k: int, recall: float) -> int:
    """How many vectors a query has to pass so that the share ``recall`` of the true neighbours of
    the tried queries is among them."""
    truth = exact_search(entries.select("id", "vec"), tried, k).join(
        entries.select(F.col("id").alias("vec_id"), "cell"), "vec_id"
    ).groupBy("query_id", "vec_id").agg(F.min("cell").alias("cell")).toPandas()
    far = distances(matrix(tried["vec"]), books)
    reached = []
    for i, ident in enumerate(tried["id"]):
        order = np.argsort((far[0][i][:, None] + far[1][i][None, :]).ravel(), kind="stable")
        upto = np.empty(len(order), np.int64)
        upto[order] = np.cumsum(counts[order])
        reached.extend(upto[truth.loc[truth["query_id"] == ident, "cell"]])
    need = np.quantile(reached, recall, method="higher") if reached else 0
    return max(int(need), 2 * k + 1)


def bins(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bin of each cell, and over how many bins it is dealt: small cells share a bin."""
    starts, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at, filled = 0, 0
    for c, n in enumerate(counts.tolist()):
        if n > BIN_ROWS:
            at += filled > 0
            starts[c], parts[c] = at, -(-n // BIN_ROWS)
            at, filled = at + int(parts[c]), 0
        else:
            if filled + n > BIN_ROWS:
                at, filled = at + 1, 0
            starts[c], filled = at, filled + n
    return starts, parts
