from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, documents, empty, texts, words
from hypothesis import given, settings
from hypothesis import strategies as st

from auditlake.llm import queries, ranked_search
from auditlake.llm.ranked_search import Best, Entries, rank, terms, walk

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


@given(st.one_of(st.text(), st.text(alphabet="aZ09.-_ ñÉ你 \x00\x7f\n")))
@settings(max_examples=200, deadline=None)
def test_terms(text):
    assert [t.decode() for t in terms(text)] == plain(text)


def expected(rows, items, top=10):
    docs = [(i, Counter(plain(t))) for i, t in rows]
    many, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            n, score = sum(c.values()), 0
            for t in set(plain(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (100 - 90 + 90 * n * many // total)))
            if score > 0:
                scores.append((score, i))
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(item, k + 1, i, s) for k, (s, i) in enumerate(scores[:top])]
    return Counter(out)


def corpus(seed, n):
    """Frequent and rare words, equal documents, a word in every document."""
    rng = random.Random(seed)
    names = [words(rng, 1) for _ in range(300)]
    found = []
    for _ in range(n):
        k = min(int(rng.expovariate(0.02)) + 1, 200)
        found.append("the " + " ".join(names[min(int(rng.expovariate(0.03)), 299)].title() for _ in range(k)))
    return found + found[: n // 10]


def questions(seed, found, n):
    rng = random.Random(seed)
    asked = [(k, " ".join(rng.choice(found).split()[:12]) + " the of") for k in range(n)]
    return [*asked, (n, None), (n + 1, " .. "), (n + 2, "nothing-like-this"), (n, "one one spaces"), (None, "word two")]


@pytest.mark.parametrize("size, chunk", [(2048, 512), (7, 3), (64, 16)])
def test_ranks_are_those_of_brute_force(spark, monkeypatch, size, chunk):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", size)
    monkeypatch.setattr(ranked_search, "CHUNK", chunk)
    found = corpus(1, 300)
    items = questions(2, found, 12)
    df = documents(spark, found).selectExpr("*", "1 AS id", "2 AS score", "3 AS rank", "4 AS number").repartition(3)
    asked = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS id", "2 AS words", "3 AS score")
    rows = [*enumerate(found), *((r[0], r[1]) for r in ODD)]
    got = rank(df, "doc_id", "text", asked, "item_id", "text").collect()
    assert Counter(map(tuple, got)) == expected(rows, items)
    # In several turns over the documents.
    got = rank(df, "doc_id", "text", asked, "item_id", "text", sent=20, top=3).collect()
    assert Counter(map(tuple, got)) == expected(rows, items, 3)


LISTS = st.lists(st.dictionaries(st.integers(0, 49), st.integers(1, 9), max_size=50), max_size=6)


@given(LISTS, LISTS, st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_walk_skips_only_what_cannot_matter(first, second, top):
    best, scores = Best(top), []
    for block, lists in enumerate((first, second)):
        ids = list(range(50 * block, 50 * block + 50))
        entries = []
        for one in lists:
            docs = np.array(sorted(one), np.int64)
            values = np.array([one[d] for d in sorted(one)], np.int64)
            entries.append(Entries(docs, values, int(values.max(initial=0))))
        walk(entries, ids, best)
        sums = sum((Counter(one) for one in lists), Counter())
        scores += [(s, ids[d]) for d, s in sums.items()]
    assert best.found == sorted(scores, key=lambda s: (-s[0], s[1]))[:top]


def test_no_documents_or_no_items(spark):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert rank(empty(spark), "doc_id", "text", items, "item_id", "text").count() == 0
    none = spark.createDataFrame([], ITEMS)
    assert rank(documents(spark, texts(1, 5)), "doc_id", "text", none, "item_id", "text").count() == 0


def test_query_over_its_whole_tables(spark, tmp_path):
    found = corpus(5, 60)
    items = questions(6, found, 5)
    documents(spark, found).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.QUERIES["op13_ranked_search"](spark, str(tmp_path)).collect()
    rows = [*enumerate(found), *((r[0], r[1]) for r in ODD)]
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == expected(rows, items)
