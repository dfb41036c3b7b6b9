from __future__ import annotations

import random
from collections import Counter

import numpy as np
from helpers import documents, empty, texts, words
from pyspark.sql import functions as F

from auditlake.llm import multi_index, ngram_join
from auditlake.llm.shingles import shingle_sets


def brute(vectors, k):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for i, v in vectors:
        if i % 20 == 0 and i not in out:
            s = (x * np.array(v, float)).sum(axis=1)
            out[i] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
    return out


def search(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = {}
    for r in multi_index.search(df, "vec_id", "embedding", F.col("id") % 20 == 0, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def test_traverse_takes_cells_by_summed_distance():
    rng = np.random.default_rng(5)
    for _ in range(30):
        far = rng.random(rng.integers(1, 7)), rng.random(rng.integers(1, 7))
        counts = rng.integers(0, 4, len(far[0]) * len(far[1]))
        order = np.argsort((far[0][:, None] + far[1][None, :]).ravel(), kind="stable")
        assert multi_index.traverse(far, counts, 10**9) == [c for c in order.tolist() if counts[c]]


def test_recall_scores_and_ties(spark):
    rng = np.random.default_rng(9)
    vectors = [(i, (rng.normal(size=8) * rng.choice([0.5, 3])).tolist()) for i in range(900)]
    vectors += [(i, vectors[0][1]) for i in range(900, 960)]  # copies of a query
    odd = [(1000, None), (1001, [0.0] * 8), (1002, [1.0] * 7 + [None]), (1003, [float("nan")] * 8), (1004, [1.0, 2.0]), (None, [1.0] * 8)]
    got, want = search(spark, vectors + odd), brute(vectors, 20)
    assert got.keys() == want.keys()
    exact = {i: np.array(v) for i, v in vectors}
    found = 0
    for q, rows in got.items():
        assert len(rows) == 20 and rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        assert all(s == (exact[v] * exact[q]).sum() for v, s in rows)
        found += len({v for v, _ in rows} & {v for v, _ in want[q]})
    assert found >= 0.9 * 20 * len(want)
    assert [v for v, _ in got[0]] == [v for v, _ in want[0]]


def test_few_vectors(spark):
    assert search(spark, [(20, [1.0, 0.0])]) == {}
    assert search(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]) == {}
    few = [(20, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0]), (2, [1.0, 0.0])]
    assert search(spark, few) == {20: [(1, 5.0), (2, 5.0), (2, 1.0)]}
    assert search(spark, []) == {}


def sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(rows):
    """links and class of each row by comparing all."""
    found = [(r.doc_id, sets(r.text)) for r in rows]
    root, links = list(range(len(found))), Counter()
    for i, (_, a) in enumerate(found):
        for j in range(i):
            b = found[j][1]
            shared = len(a & b)
            if shared and 10 * shared >= 8 * (len(a) + len(b) - shared):
                links[i] += 1
                links[j] += 1
                x, y = root[i], root[j]
                root = [y if r == x else r for r in root]
    least = {r: min((found[i][0] for i in range(len(found)) if root[i] == r and found[i][0] is not None), default=None) for r in set(root)}
    return sorted((str(found[i][0]), links[i], str(least[root[i]])) for i in range(len(found)))


def test_shingles():
    found = ["", None, "a", "a b c d", "a b c d e f", "A  b\nc\td e f", "x" * 300 + " y", "a a a a a a a a a", *texts(2, 30)]
    got = [s.tolist() for s in shingle_sets(found, 5)]
    assert [len(s) for s in got] == [len(sets(t)) for t in found]
    for i, t in enumerate(found):
        for j, u in enumerate(found):
            assert len(set(got[i]) & set(got[j])) == len(sets(t) & sets(u))


def test_links(spark, monkeypatch):
    # Small parts, so that buckets and neighbourhoods are dealt over several.
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", 8)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    rng, found = random.Random(6), texts(8, 40)
    base = words(rng, 60).split()
    for _ in range(40):  # a group of near copies
        copy = list(base)
        copy[rng.randrange(60)] = words(rng, 1)
        found.append(" ".join(copy))
    found += [found[0]] * 3 + [found[1].upper(), " ".join(base[:57]), "one two three", "One two  three"]
    docs = documents(spark, found).withColumn("class_id", F.lit("clash"))
    rows = ngram_join.similar_documents(docs, "doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.links, str(r.class_id)) for r in rows) == linked(docs.collect())


def test_depth_and_nothing(spark):
    depth = ngram_join.prefix_depth()
    assert 1 - (1 - 0.8**depth) ** 20 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 20
    assert ngram_join.similar_documents(empty(spark), "doc_id", "text").collect() == []


def test_no_set_key_reaches_the_driver(spark, monkeypatch):
    frame, seen = type(spark.range(0)), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: [seen.append(r) or r for r in collect(df)])
    rng = random.Random(4)
    base = words(rng, 40)
    docs = documents(spark, [base, f"{base} more", f"{base} and", *texts(5, 20)], odd=False)
    monkeypatch.setattr(ngram_join, "FILTER_BITS", 15, raising=False)
    rows = collect(ngram_join.similar_documents(docs, "doc_id", "text"))
    assert sorted((str(r.doc_id), r.links, str(r.class_id)) for r in rows) == linked(collect(docs))
    assert not [v for r in seen for v in r if isinstance(v, (bytes, bytearray)) and len(v) == 16]
    assert ngram_join.key_filter(spark.createDataFrame([(b"\x00\x03" + bytes(14),), (b"\xff" * 16,)], "key binary"), 16).nonzero()[0].tolist() == [0, 8191]


def test_texts_of_few_words_in_all():
    """Fewer words in a batch than a shingle has."""
    for found in ([""], ["a"], ["a", "b c", None], ["a b c d"], ["a b c d e"]):
        sets = list(shingle_sets(found, 5))
        assert [len(s) for s in sets] == [int(bool((t or "").split())) for t in found]
