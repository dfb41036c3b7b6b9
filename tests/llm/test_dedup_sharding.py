from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, empty, texts
from pyspark.sql import functions as F

from auditlake.llm.exact_dedup import filter_segments, found_again, mark_copies
from auditlake.llm.sharding import assign_shards, jump_hash


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("limit", [1 << 30, 0])
@pytest.mark.parametrize("keep", [None, ["doc_id"]])
def test_copies(spark, limit, keep):
    found = texts(5, 40)
    found += [found[0].upper(), found[0], found[1] + " ", "Ñ", "ñ"] + [found[3]] * 30
    docs = documents(spark, found).withColumn("kept", F.lit("clash"))
    rows = mark_copies(docs, "doc_id", "text", keep=keep, limit=limit).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[hashlib.sha256(lowered(r.text).encode()).hexdigest()].append(r.doc_id)
    assert len(rows) == docs.count()
    kept = Counter()
    for r in rows:
        mine = groups[r.text_sha256]
        assert r.group_size == len(mine)
        assert r.keep_id == max((i for i in mine if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1} and set(kept) == set(groups)


def test_columns_with_the_names_of_the_operator(spark):
    found = [*texts(5, 6), "same", "SAME"]
    plain = documents(spark, found, odd=False)
    odd = plain.selectExpr("doc_id AS __id", "text AS __h", "1 AS __maybe", "2 AS __row", "doc_id AS __best")
    want = {tuple(r) for r in mark_copies(plain, "doc_id", "text", keep=["doc_id"]).collect()}
    got = mark_copies(odd, "__id", "__h")
    assert got.columns == ["__id", "__h", "__maybe", "__row", "__best", "keep_id", "group_size", "kept", "text_sha256"]
    assert {(r["__id"], *tuple(r)[5:]) for r in got.collect()} == want
    assert {tuple(r) for r in mark_copies(odd, "__id", "__h", keep=["__id"]).collect()} == want


def test_the_filter_lets_few_single_hashes_pass(spark):
    """Repeated hashes are all found, also one that most rows have, and few others are."""
    rows = spark.range(40_000).selectExpr("CASE WHEN id < 9000 THEN id WHEN id < 12000 THEN id - 3000 WHEN id < 20000 THEN 5 ELSE id END AS __h")
    found = [r.h for r in found_again(rows, filter_segments(40_000)).collect()]
    repeated = {5, *range(6000, 9000)}
    assert len(found) == len(set(found)) and repeated <= set(found) and len(found) - len(repeated) < 400


def test_no_documents(spark):
    assert mark_copies(empty(spark), "doc_id", "text").collect() == []
    assert assign_shards(empty(spark), "doc_id", 16).collect() == []


def one_by_one(key, shards):
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for shards in (1, 2, 16, 17, 1000):
        assert jump_hash(keys, shards).tolist() == [one_by_one(int(k), shards) for k in keys]
    before, after = jump_hash(keys, 16), jump_hash(keys, 17)
    assert set(after[before != after]) == {16}
    with pytest.raises(ValueError):
        jump_hash(keys, 0)


def test_shards(spark):
    docs = documents(spark, texts(7, 200)).withColumn("shard", F.lit("clash"))
    rows = assign_shards(docs, "doc_id", 16, tie="text").collect()
    assert len(rows) == docs.count()
    places, of = defaultdict(list), defaultdict(set)
    for r in rows:
        places[r.shard].append(r.slot)
        of[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(x) == 1 for x in of.values())
