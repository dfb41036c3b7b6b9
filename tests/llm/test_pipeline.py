from __future__ import annotations

import random

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from helpers import ODD, empty, texts, words
from pyspark.sql import functions as F

from auditlake.llm import mixing, queries
from auditlake.llm.ngram_join import drop_rows


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, base = random.Random(21), texts(20, 120)
    toxic = [f"{t} frimpax {words(rng, 3)} blorgo {words(rng, 2)}" for t in base[:40]]
    long = words(rng, 400).split()
    near = [" ".join([*long[:k], "changed", *long[k + 1 :]]) for k in range(0, 400, 50)]
    rows = base[40:] + toxic + near + [base[50].upper(), base[51]]
    docs = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(rows)] + ODD
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(80 <= i < 120)) for i in range(len(rows))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    clean = steps["toxicity"](spark, docs, folder)
    assert clean.columns == columns
    left = {r.doc_id for r in clean.collect()}
    assert not left & set(range(80, 120)) and set(range(80)) <= left
    single = steps["exact_dedup"](spark, clean, folder)
    found = [r.text or "" for r in single.collect()]
    assert single.columns == columns and len({t.lower() for t in found}) == len(found)
    assert {t.lower() for t in found} == {(r.text or "").lower() for r in clean.collect()}
    apart = steps["ngram_join"](spark, single, folder)
    assert apart.columns == columns
    near = [r for r in apart.collect() if r.text and "changed" in r.text]
    assert len(near) == 1 and apart.count() == single.count() - 7
    mixed = steps["mixing"](spark, apart, folder)
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    packed = steps["packing"](spark, mixed, folder).collect()
    assert len([r for r in packed if r.piece == 0]) == mixed.count()


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 1024


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = empty(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_with_clashing_names(spark, folder):
    """Columns that the stages use for themselves, in a table of long blanks, added tokens and odd rows."""
    rows = [*enumerate(texts(3, 20)), (30, " " * 60_000 + "x"), (31, "\n" * 60_000), (32, "a <|endoftext|> b"), (None, None), (33, "")]
    docs = spark.createDataFrame([(i, t, "s1" if i else None) for i, t in rows], "doc_id long, text string, source string")
    names = ["score", "kept", "keep_id", "key", "size", "bin", "part", "ident", "times", "class_id", "links", "quality", "__d1"]
    docs = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)], F.col("doc_id").alias("id"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        if name == "exact_dedup":
            continue  # replaces the columns of its results
        left = step(spark, docs, folder)
        assert sorted(left.columns) == sorted(docs.columns)
        for r in left.collect():
            assert [r[n] for n in names] == list(range(len(names))) and r.id == r.doc_id
    assert steps_pack(spark, docs, folder)


def steps_pack(spark, docs, folder):
    packed = dict(corpus_pipeline.STAGES)["packing"](spark, docs, folder).collect()
    return len([r for r in packed if r.piece == 0]) == docs.count()


def test_only_dropped_rows_go(spark):
    rows = spark.range(5000).selectExpr("id AS __row", "'text ' || id AS text")
    dropped = spark.range(0, 5000, 7).selectExpr("id AS __row")
    for bits in (15, 27):
        left = {r["__row"] for r in drop_rows(rows, "__row", dropped, bits).collect()}
        assert left == set(range(5000)) - set(range(0, 5000, 7))
    assert drop_rows(rows, "__row", dropped.limit(0)).count() == 5000


def test_taken_rows_are_those_of_the_mix(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id is not null").dropDuplicates(["doc_id"])
    want = {r.doc_id: r.times for r in mixing.mix(docs, "doc_id", "source", "text").collect() if r.times}
    got = mixing.take(docs, "source", "text", "doc_id")
    assert got.columns == docs.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == want
