from __future__ import annotations

import re
from collections import defaultdict

import pytest
from helpers import documents, empty, texts
from pyspark.sql import functions as F

from auditlake.llm import mixing
from auditlake.llm.components import components
from auditlake.llm.mixing import mix, targets
from auditlake.llm.url_rules import RULES, judge_urls


def shared(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total, over = sum(w[s] for s in open_), set()
        for s in open_:
            target[s] += left * w[s] / total
        left = 0.0
        for s in open_:
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                over.add(s)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 7}, {"a": 0, "b": 4}, {"x": 9}, {f"s{i}": i * i for i in range(20)}])
def test_targets(spark, sizes):
    rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = shared(sizes)
    assert {r.source for r in rows} == set(want)
    for r in rows:
        assert r.target == pytest.approx(want[r.source], abs=1e-6)


def test_mix(spark):
    docs = documents(spark, texts(11, 300)).withColumn("taken", F.lit("clash"))
    rows = mix(docs, "doc_id", "source", "text").collect()
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(5), "doc_id", "source", "text").collect()))
    assert len(rows) == docs.count()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    want = shared(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.times * r.size and r.times <= 3
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6
    assert mix(empty(spark), "doc_id", "source", "text").collect() == []


PAGES = [
    (0, "http://a.net/x"),
    (1, "https://EXAMPLE.net/en/1?q=/de/"),
    (2, "https://m.example.com/de/7#top"),
    (3, "https://m.example.com/de"),
    (4, "http://b.org/fr/"),
    (5, "http://borg/fr/"),
    (6, "no scheme"),
    (7, None),
    (8, "x://y://net/"),
    (9, "http://net"),
    (10, "http://net?/en/"),
    (11, "http://alias.de/1"),
    (12, "http://alias.de/2#part"),
    (13, "http://alias.de/2"),
    (14, "http://both.de/"),
    (15, ""),
    (7, None),
]


def test_rules_and_aliases(spark):
    html = {
        11: '<html><LINK rel="canonical" href="http://a.net/elsewhere"></html>',
        12: '<meta http-equiv=refresh content="0; url=/1">',
        13: "<p>canonical text without a link</p>",
        14: "<link rel=canonical href=http://b.org/fr/2>",
    }
    pages = spark.createDataFrame([(i, u, html.get(i)) for i, u in PAGES], "page_id long, url string, html string")
    links = spark.createDataFrame([("http://both.de/", "http://a.net/9"), (None, "x"), ("y", None)], "src string, dst string")
    rows = judge_urls(pages.withColumn("rule", F.lit("clash")), "url", RULES, html="html", links=links).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert len(rows) == len(PAGES)
    assert got[0] == [("a.net", "/x", "net/", "block")]
    assert got[1] == [("example.net", "/en/1", "example.net/en/", "allow")]
    assert got[2] == [("m.example.com", "/de/7", "example.com/de/", "block")]
    assert got[3] == [("m.example.com", "/de", None, "allow")]
    assert got[4] == [("b.org", "/fr/", "org/fr/", "allow")]
    assert got[5] == [("borg", "/fr/", None, "allow")]
    assert got[6] == [("", "", None, "allow")] and got[7] == [("", "", None, "allow")] * 2
    assert got[8] == [("y:", "//net/", None, "allow")]
    assert got[9] == [("net", "", None, "allow")] and got[10] == [("net", "", None, "allow")]
    # A canonical link leads to a blocked page, a redirect to its source, and both spellings of 2 are one page.
    assert [got[i][0][3] for i in (11, 12, 13)] == ["block"] * 3
    # One alias is blocked, another allowed.
    assert got[14] == [("both.de", "/", None, "allow")]
    assert judge_urls(pages.limit(0), "url", RULES, html="html").collect() == []


def test_components(spark):
    import random

    rng = random.Random(4)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)]
    edges += [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(501, 560)] + edges[:20] + [(None, 3), (4, None), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in rows} == {x: find(x) for x in root} and len(rows) == len(root)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_no_bin_of_keys_is_large_for_low_quality(spark):
    for quality in (0.05, 1.0):
        keys = spark.range(20_000).select(mixing.draw_key(F.col("id"), F.lit(quality), "mix").alias("key"))
        bins = keys.groupBy(mixing.key_bin(F.col("key")).alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"))
        rows = bins.orderBy("bin").collect()
        assert max(r.n for r in rows) < 40
        assert all(x.b < y.a for x, y in zip(rows, rows[1:]))
