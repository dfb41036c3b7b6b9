from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import public_tokenizers
from helpers import ODD, documents, empty, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from auditlake.llm import queries
from auditlake.llm.slack_packing import Piece, Pool, closest, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(1, 30), max_size=9), st.integers(0, 70))
@settings(max_examples=300, deadline=None)
def test_no_multiset_comes_closer(found, capacity):
    counts = Counter(found)
    picked = closest(counts, sorted(counts), capacity)
    assert all(n <= counts[s] for s, n in picked.items())
    sums = {sum(c) for k in range(len(found) + 1) for c in itertools.combinations(found, k)}
    assert sum(s * n for s, n in picked.items()) == max(s for s in sums if s <= capacity)


@given(st.lists(st.integers(1, 16), max_size=60), st.sampled_from([16, 12]))
@settings(max_examples=100, deadline=None)
def test_pool_loses_nothing_and_leaves_no_slack(lengths, capacity):
    pool = Pool(capacity)
    for i, n in enumerate(lengths):
        if n < capacity:
            pool.add(Piece(i, 0, bytes(range(4 * n)), n))
    want = {i: bytes(range(4 * n)) for i, n in enumerate(lengths) if n < capacity}
    full = [*pool.exact(), *pool.cutting(0)]
    assert all(sum(p.length() for p in w) == capacity for w in full)
    rest = [*pool.rest()]
    assert all(sum(p.length() for p in w).bit_count() == 1 for w in rest)
    assert sum(p.length() for w in rest for p in w) < capacity
    found: dict = {}
    for p in sorted((p for w in [*full, *rest] for p in w), key=lambda p: (p.ident, p.start)):
        assert p.start * 4 == len(found.get(p.ident, b""))
        found[p.ident] = found.get(p.ident, b"") + p.data
    assert found == want and not pool.pieces and not pool.ids


def round_trip(spark, rows, df, length, **how):
    """Every id of every document in one piece, every place of every sequence in one piece, no padding."""
    library = Tokenizer.from_file(PATH)
    found = pack_documents(df, "doc_id", "text", PATH, length, ids=True, **how).collect()
    sequences: dict = {}
    for r in found:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at == length or (at < length and at.bit_count() == 1)
    assert sum(sum(n for _, n in p) < length for p in sequences.values()) <= length.bit_length()
    # Repeated rows have equal pieces or not, but together every id as often as they have it.
    want, got = Counter(), Counter()
    for row in rows:
        data = library.encode(row[1] or "", add_special_tokens=False).ids + [1]
        want.update((row[0], k, i, len(data)) for k, i in enumerate(data))
    for r in found:
        got.update(
            (r.id, r.start + k, int.from_bytes(r.ids[4 * k : 4 * k + 4], "little"), r.doc_tokens) for k in range(r.length)
        )
    assert got == want
    return found


def test_round_trip_of_odd_documents(spark):
    found = texts(5, 300)
    df = documents(spark, found).selectExpr("*", "1 AS id", "2 AS `left`", "3 AS ids", "4 AS length").repartition(5)
    rows = [(i, t) for i, t in enumerate(found)] + [(r[0], r[1]) for r in ODD]
    round_trip(spark, rows, df, 2048)
    # Many turns: few pieces wait, few are left.
    round_trip(spark, rows, df, 128, waiting=16, left=4)


def test_documents_that_never_fit_together(spark):
    """Two of 1500 ids fill no window: slack is filled by cutting."""
    rows = [(i, " a" * 1499) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    round_trip(spark, rows, df, 2048, waiting=8, left=2)


def test_empty_table(spark):
    assert pack_documents(empty(spark), "doc_id", "text", PATH).count() == 0


def test_query_is_whole_and_exact(spark, tmp_path):
    rng = random.Random(8)
    found = [" ".join(texts(k, 1) * rng.randint(1, 90)) for k in range(120)]
    documents(spark, found).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_slack_packing"](spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in [*enumerate(found), *((r[0], r[1]) for r in ODD)]:
        want[i, len(library.encode(t or "", add_special_tokens=False).ids) + 1] += 1
    ids = Counter()
    for r in got:
        ids[r.doc_id, r.doc_tokens] += r.length
    assert ids == Counter({k: k[1] * n for k, n in want.items()})
