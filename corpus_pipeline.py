"""The corpus pipeline: toxicity, exact copies, near copies, mixing of sources, packing.

Each stage takes the documents that its predecessor kept, as written and read again, and works on all of
them. All but the last return the columns of the table ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from auditlake.llm.common import stage, table

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score less than ``TOXIC_FROM``; all labels are learned from.

    Null and empty texts score as clean. Rows are judged one by one, so repeated rows and null ids stay or go
    by their texts; an empty table stays empty.
    """
    scored = toxicity.score(docs, "doc_id", "text", table(spark, sf_dir, "labels"), "doc_id", "toxic")
    return scored.where(F.col("score") < TOXIC_FROM).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest id.

    Null and empty texts are equal; any id is larger than null; of repeated rows one stays; an empty table
    stays empty.
    """
    return exact_dedup.mark_copies(docs, "doc_id", "text").where("kept").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that n-gram similarity links.

    A null id is the smallest. Ids may be null or repeated, so rows get numbers of their own, and of equal ids
    the first number stays. Texts without words are linked with none and stay. Texts are read where
    they lie; only rows that may go are shuffled.
    """
    numbered = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    marked = ngram_join.similar_documents(numbered, "__row", "text").where("links > 0").select("__row", "class_id")
    linked = stage(numbered.select("__row", "doc_id").join(marked, "__row"), "linked")
    first = linked.groupBy("class_id").agg(F.min(F.struct("doc_id", "__row")).alias("first"))
    extra = linked.join(first, "class_id").where(F.col("first.__row") != F.col("__row")).select("__row")
    return ngram_join.drop_rows(numbered, "__row", stage(extra, "near-copies")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, or not at all.

    Null sources are one source, null texts have no words and are never taken a part time; documents are drawn by
    their ids, so that reruns agree, and rows of one id and size in any order. An empty table stays empty.
    """
    return mixing.take(docs, "source", "text", draw="doc_id")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of up to 1024 tokens and their places in the packed sequences.

    A null text is an end token alone. Repeated rows are packed each; an empty table gives no pieces.
    """
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, "doc_id", "text", tokenizer).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned lexica and signatures have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
