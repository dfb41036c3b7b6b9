from __future__ import annotations

import bisect
import random
import zlib

import public_tokenizers
import pytest
from helpers import ODD, documents, empty, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from auditlake.llm.byte_pairs import Encoder
from auditlake.llm.packing import best_fit, cut, pack, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return Encoder(PATH)


def ids(data: bytes) -> list[int]:
    return [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]


@given(st.text(alphabet=" \t\n\r\x0b\x1c\x85\u00a0\u2003'ab1,.sñ你é\u0301<|>", max_size=40))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_librarys(own, library, text):
    assert ids(own.ids(text)) == library.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n", "a", "ñ ", "  b"]), max_size=12))
@settings(max_examples=200, deadline=None)
def test_added_tokens_are_the_librarys(own, library, parts):
    text = "".join(parts)
    assert ids(own.ids(text)) == library.encode(text, add_special_tokens=False).ids


@given(
    st.lists(st.tuples(st.sampled_from([" ", "\n", "\t", " \n", "\u2003", "\x1c"]), st.sampled_from(["", "a", " b", "<|endoftext|>", "."])), min_size=1, max_size=3),
    st.sampled_from(["", "x", "x y"]),
)
@settings(max_examples=25, deadline=None)
def test_long_runs_of_white_space_are_the_librarys(own, library, runs, head):
    text = head + "".join(blank * 30_000 + word for blank, word in runs)
    assert ids(own.ids(text)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", [" ", "\n", "\t"])
def test_a_million_blanks_are_encoded(own, library, blank):
    for text in (blank * 1_000_000, f"a{blank * 1_000_000}b"):
        assert ids(own.ids(text)) == library.encode(text, add_special_tokens=False).ids


def best_fit_decreasing(counts, length):
    gaps, opened = [], 0
    for size in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        at = bisect.bisect_left(gaps, size)
        gap = gaps.pop(at) if at < len(gaps) else length
        opened += gap == length
        bisect.insort(gaps, gap - size)
    return opened


def test_rounds_open_as_many_sequences_as_one_by_one():
    rng = random.Random(3)
    for _ in range(60):
        length = rng.choice([7, 16, 64])
        counts = {rng.randint(1, length): rng.randint(1, 90) for _ in range(rng.randint(1, 20))}
        placed, filled = best_fit(counts, length), {}
        for size, n in counts.items():
            rows = placed[size].tolist()
            for rank in range(n):
                first, sequence, offset = rows[bisect.bisect_right([r[0] for r in rows], rank) - 1]
                filled.setdefault(sequence + rank - first, []).append((offset, size))
        for pieces in filled.values():
            at = 0
            for offset, size in sorted(pieces):
                assert offset == at
                at += size
            assert at <= length
        assert sorted(filled) == list(range(len(filled)))
        assert len(filled) == best_fit_decreasing({s: n for s, n in counts.items() if s < length}, length) + counts.get(length, 0)


def test_documents(spark, library):
    found = texts(1, 60)
    docs = documents(spark, found)
    rows = pack_documents(docs, "doc_id", "text", PATH, length=64, ids=True).collect()
    expected = [(i, t) for i, t in enumerate(found)] + [(r[0], r[1]) for r in ODD]
    want = []
    for i, t in expected:
        got = library.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(got) if len(got) <= 64 else len(got) % 64 or 64
        starts = [0, *range(first, len(got), 64)]
        ends = [*starts[1:], len(got)]
        want += [(str(i), k, a, b - a, got[a:b]) for k, (a, b) in enumerate(zip(starts, ends))]
    assert sorted((str(r.id), r.piece, r.start, r.length, ids(r.ids)) for r in rows) == sorted(want)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in rows)
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 64
    assert len(filled) == best_fit_decreasing({s: sum(r.length == s for r in rows) for s in range(1, 65)}, 64)


def test_empty_and_extra_columns(spark):
    assert pack_documents(empty(spark), "doc_id", "text", PATH).collect() == []
    clash = documents(spark, ["a b c"], odd=False).selectExpr("doc_id", "text", "1 as piece", "2 as length", "3 as offset", "4 as id")
    row = pack(cut(clash, "doc_id", "text", PATH)).collect()[0]
    assert (row.id, row.piece, row.offset, row.length) == (0, 0, 0, 4)
