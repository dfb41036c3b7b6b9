"""Text quality: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import slices, stage, without

FEATURES = 256
RIDGE = 1e-3
SEED = 11

STATISTICS = (
    "characters", "words", "word_length", "letters", "digits", "signs", "capitals", "different_words",
    "top_word", "same_as_before", "lines", "repeated_lines", "line_length", "rare_signs", "sentence_ends",
    "short_words", "sign_ends", "different_pairs",
)
# Kinds of bytes: letter or part of one, digit, usual sign, unusual sign, capital, white space.
_KIND = np.full(256, 3, np.int64)
_KIND[[*range(97, 123), *range(128, 256)]] = 0
_KIND[[*range(48, 58)]] = 1
_KIND[[*b".,;:!?'\"()-"]] = 2
_KIND[[*range(65, 91)]] = 4
_KIND[[*b" \t\n\r\x0b\x0c"]] = 5


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``STATISTICS`` for a whole text; all 0 for one without words."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=6)
    size, n = kinds[:5].sum(), len(words)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = sum(len(x) * (c - 1) for x, c in Counter(lines).items())
    ends = [w[-1] for w in words]
    return [
        np.log1p(len(data)), np.log1p(n), size / n,
        kinds[0] / size, kinds[1] / size, kinds[2] / size, kinds[4] / size,
        len(counts) / n, max(counts.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        np.log1p(len(lines)), repeated / len(data), np.log1p(len(data) / len(lines)),
        kinds[3] / size, sum(e in b".!?" for e in ends) / n, sum(len(w) <= 3 for w in words) / n,
        sum(_KIND[e] in (2, 3) for e in ends) / n, len(set(zip(words, words[1:]))) / max(1, n - 1),
    ]


def measured(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``keep`` and ``__s``, the statistics of each text as doubles in binary form."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [np.array(statistics(t), "<f8").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(got, pa.binary())], names=[*batch.schema.names[1:], "__s"]
            )

    rows = docs.select(F.col(text).alias("__text"), *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(measure, f"{kept}, __s binary")


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def summed(rows: DataFrame, part) -> np.ndarray | None:
    """The sum of ``part(batch)``, an array of one shape, over all rows.

    Partitions are summed where they lie, then in groups of about the root of their number, so that
    neither a task nor the driver gets more than so many arrays."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                got = part(batch)
                total = got if total is None else total + got
        if total is not None:
            yield pd.DataFrame({"sums": [total.astype("<f8").tobytes()]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arrays = [np.frombuffer(x, "<f8") for batch in batches for x in batch["sums"]]
        if arrays:
            yield pd.DataFrame({"sums": [np.sum(arrays, axis=0).tobytes()]})

    partials = stage(rows.mapInPandas(add, "sums binary"), "normal-equations")
    groups = max(1, round(partials.count() ** 0.5))
    got = partials.repartition(groups).mapInPandas(merge, "sums binary").collect()
    return np.sum([np.frombuffer(r.sums, "<f8") for r in got], axis=0) if got else None


class Kernel:
    """Features whose inner products approximate a Gaussian kernel of the standardised statistics, and
    the statistics themselves."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES):
        rng, n = np.random.default_rng(SEED), len(mean)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        # The kernel's width is the root of the number of statistics, a usual distance of two rows.
        self.w = rng.standard_normal((n, features)) / np.sqrt(n)
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, s: np.ndarray) -> np.ndarray:
        z = np.clip((s - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack([np.ones((len(z), 1)), z, waves])


def isotonic(x: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing curve nearest to the shares positive / n, by pooling neighbours."""
    pools: list[list[float]] = []
    for a, b, c in zip(x, n, positive):
        pools.append([a * b, b, c])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], last)]
    at = np.array(pools)
    return at[:, 0] / at[:, 1], at[:, 2] / at[:, 1]


def score(
    docs: DataFrame,
    ident: str,
    text: str,
    labels: DataFrame,
    label_ident: str,
    label: str,
    train: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with ``score``, the quality (0 to 1) of a text.

    ``labels`` has ids and 0/1; ids with a null label, or where ``train`` (of its columns) does not
    hold, are not learned from, and an id with several labels has their largest. All others are,
    through sums over partitions. Only statistics of the whole text enter the score. Null and
    empty texts have statistics of 0 and are scored like others. Without labels the score is 0.5,
    with labels of one class that class. Repeated rows are scored each; a column ``score`` of
    ``docs`` is replaced.
    """
    docs = without(docs, "score", "__s", "__y", "__id", "__raw")
    columns = [c for c in (keep or docs.columns) if c != "score"]
    rows = measured(docs, text, *columns, F.col(ident).alias("__id"))
    if text not in columns:
        rows = stage(rows, "statistics")
    known = labels.where(train if train is not None else F.lit(True))
    known = known.select(F.col(label_ident).alias("__id"), F.col(label).cast("int").alias("__y"))
    known = known.where("__id is not null and __y in (0, 1)").groupBy("__id").agg(F.max("__y").alias("__y"))
    learned = stage(rows.select("__id", "__s").join(known, "__id").select("__s", "__y"), "labelled")

    def moments(batch: pd.DataFrame) -> np.ndarray:
        s = matrix(batch["__s"])
        return np.concatenate([[len(s), batch["__y"].sum()], s.sum(axis=0), (s**2).sum(axis=0)])

    got = summed(learned, moments)
    if got is None or got[1] in (0, got[0]):
        constant = 0.5 if got is None else float(got[1] > 0)
        return rows.select(*columns, F.lit(constant).alias("score"))
    n, width = got[0], len(STATISTICS)
    mean = got[2 : 2 + width] / n
    kernel = Kernel(mean, np.sqrt(np.maximum(got[2 + width :] / n - mean**2, 0)))

    def equations(batch: pd.DataFrame) -> np.ndarray:
        x = kernel(matrix(batch["__s"]))
        return np.vstack([x.T @ x, batch["__y"].to_numpy(np.float64) @ x]).ravel()

    sums = summed(learned, equations).reshape(-1, width + FEATURES + 1)
    ridge = RIDGE * n * np.eye(len(sums) - 1)
    ridge[0, 0] = 1e-9
    beta = np.linalg.solve(sums[:-1] + ridge, sums[-1])
    fitted = docs.sparkSession.sparkContext.broadcast((kernel, beta))

    @F.pandas_udf("double")
    def raw(s: pd.Series) -> pd.Series:
        kernel, beta = fitted.value
        return pd.Series(np.clip(kernel(matrix(s)) @ beta, -1, 2) if len(s) else [])

    # 3001 rows at most, as raw scores lie between -1 and 2.
    steps = learned.withColumn("x", F.round(raw("__s"), 3)).groupBy("x").agg(
        F.count("*").alias("n"), F.sum("__y").alias("positive")
    ).toPandas().astype(np.float64).sort_values("x")
    curve = isotonic(*(steps[c].to_numpy() for c in ("x", "n", "positive")))

    @F.pandas_udf("double")
    def calibrate(x: pd.Series) -> pd.Series:
        # A thousandth of the raw score keeps apart what the curve puts at one height.
        return pd.Series(0.999 * np.interp(x, *curve) + 0.001 * (x.to_numpy() + 1) / 3)

    return rows.withColumn("__raw", raw("__s")).withColumn("score", calibrate("__raw")).select(*columns, "score")
