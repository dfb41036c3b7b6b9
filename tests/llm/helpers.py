"""Small tables with the odd rows that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (None, None, None, None, None),
    (None, "no id here", None, None, 10),
    (900, None, "en", "s1", 0),
    (901, "", "en", None, 0),
    (902, " \t\n ", "en", "s1", 4),
    (903, "one", "en", "s2", 3),
    (904, "  two   spaces \n\n and\tlines <|endoftext|> ñandú 你好 \u00a0 x ", "en", "s2", 20),
    (905, "word " * 6000, "en", "s2", 30000),
    (905, "word " * 6000, "en", "s2", 30000),
    (906, "x" * 5000, "en", "s3", 5000),
]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return [words(rng, rng.randint(1, 80)) for _ in range(n)]


def documents(spark: SparkSession, found: list[str], odd: bool = True) -> DataFrame:
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(found)]
    return spark.createDataFrame(rows + (ODD if odd else []), DOCUMENTS)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)
