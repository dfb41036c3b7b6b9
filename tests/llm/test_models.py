from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, empty, texts, words
from pyspark.sql import functions as F

from auditlake.llm import quality, toxicity
from auditlake.llm.lattice import Lattice
from auditlake.llm.lattice_lm import existing_pieces, score

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word, pieces):
    if not word:
        yield []
    for k in range(1, min(3, len(word)) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield [word[:k], *rest]


def test_lattice_sums_all_segmentations():
    rng = random.Random(2)
    pieces = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"aa", b" a", b" "]
    p = np.random.default_rng(1).random(len(pieces))
    logp = dict(zip(pieces, np.log(p / p.sum())))
    lattice = Lattice(pieces, np.array(list(logp.values())))
    words = [b" " + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 7))) for _ in range(40)]
    expected = Counter()
    for word, got in zip(words, lattice.log_marginal(words)):
        ways = {tuple(s): math.exp(sum(logp[x] for x in s)) for s in segmentations(word, logp)}
        assert math.log(sum(ways.values())) == pytest.approx(got)
        for way, q in ways.items():
            for x in way:
                expected[x] += q / sum(ways.values())
    assert lattice.expected_counts(words) == pytest.approx([expected[x] for x in pieces])
    assert np.isfinite(lattice.log_marginal([b" " + b"abc" * 700])).all()


def test_long_words_are_taken_in_windows(monkeypatch):
    rng = random.Random(4)
    pieces = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"aa", b"cabca", b" a", b" "]
    lattice = Lattice(pieces, np.log(np.random.default_rng(3).dirichlet(np.ones(len(pieces)))))
    words = [b" " + bytes(rng.choice(b"abc") for _ in range(n)) for n in (3, 7, 8, 20, 63, 64, 65, 200)]
    logs, counts = lattice.log_marginal(words), lattice.expected_counts(words)
    for window in (1, 5, 8, 64):
        monkeypatch.setattr("auditlake.llm.lattice.LONG_WORD", window)
        assert lattice.log_marginal(words) == pytest.approx(logs)
        assert lattice.expected_counts(words) == pytest.approx(counts)


def test_a_word_of_a_megabyte():
    pieces, logp = existing_pieces(VOCABULARY)
    lattice = Lattice(pieces, logp)
    rng = random.Random(6)
    word = bytes(rng.choices(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1_000_000))
    began = time.monotonic()
    whole = lattice.log_marginal([word])[0]
    assert whole < -1e6 and np.isfinite(whole)
    used = lattice.expected_counts([word])
    # Every byte lies in one piece of each segmentation.
    assert used @ [len(p) for p in pieces] == pytest.approx(len(word), rel=1e-4)
    assert time.monotonic() - began < 60


def test_existing_vocabulary():
    pieces, logp = existing_pieces(VOCABULARY)
    assert {bytes([b]) for b in range(256)} <= set(pieces) and np.exp(logp).sum() == pytest.approx(1)


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_scores(spark):
    found = texts(3, 80) + ["Known words known WORDS", "ñandú ñandú"]
    docs = documents(spark, found).withColumn("score", F.lit("clash"))
    train = F.coalesce(F.col("doc_id"), F.lit(0)) % 7 != 2
    rows = score(docs, "doc_id", "text", train, VOCABULARY).collect()
    source = docs.select("doc_id", "text", train.alias("train")).collect()
    counts = Counter(t for r in source if r.train for t in tokens(r.text))
    total, different = sum(counts.values()), len(counts)
    want = sorted(
        (str(r.doc_id), len(t), sum(x in counts for x in t), round(sum(math.log10((counts[x] + 1) / (total + different + 1)) for x in t), 6))
        for r in source
        for t in [tokens(r.text)]
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {total}
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    # Equal texts have equal scores, and more words are less likely.
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[900] == by_id[901] == by_id[902] > by_id[903]


def test_word_probabilities_sum_to_less_than_one(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b ab", "a a c", "ca b a"])], "doc_id long, text string")
    asked = ["", *"abc", *(x + y for x in "abc" for y in "abc")]
    both = docs.withColumn("train", F.lit(True)).unionByName(
        spark.createDataFrame([(100 + i, t, False) for i, t in enumerate(asked)], "doc_id long, text string, train boolean")
    )
    rows = {r.doc_id: r.score for r in score(both, "doc_id", "text", F.col("train"), VOCABULARY).collect()}
    end = rows[100]
    assert 10**end + sum(10 ** (rows[100 + i] - end) for i in range(1, len(asked))) < 1


def test_nothing_to_learn(spark):
    assert score(empty(spark), "doc_id", "text", F.lit(True), VOCABULARY).collect() == []
    rows = score(documents(spark, ["a b", "c"]), "doc_id", "text", F.lit(False), VOCABULARY).collect()
    assert all(math.isfinite(r.score) and r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_folding():
    marked, plain = toxicity.fold("You 1d10t! ѕtupіd pa​thetic, ｍｏｒｏｎ $cum. l0$er Réeux wow!!")
    assert marked == " you idiot stupid pathetic moron scum ioser réeux wow "
    assert plain == marked.replace("é", "e")
    assert toxicity.fold(None) == toxicity.fold("") == (" ", " ")


def test_weights_and_exceptions():
    found = [toxicity.automaton({" idiot ": 5.0, " vequ": 2.0}, [" idiot proof "])] * 2
    assert toxicity.weigh("1D1OT, idiotic vequmo", found) == (7.0, 3)
    assert toxicity.weigh("an idiot-proof idiot", found) == (5.0, 4)
    assert toxicity.weigh("", found) == (0.0, 0) and toxicity.weigh("idiot", [toxicity.automaton({}, [])] * 2) == (0.0, 1)
    assert toxicity.density(np.array([5.0]), np.array([10])) > toxicity.density(np.array([5.0]), np.array([1000]))


def labelled(spark, seed, spoil):
    """300 documents; a third of them are spoiled and labelled 1."""
    found = texts(seed, 300)
    rng = random.Random(seed)
    found = [spoil(rng, t) if i % 3 == 0 else t for i, t in enumerate(found)]
    rows = [(i, int(i % 3 == 0)) for i in range(250)] + [(None, 1), (7, None), (5, 0), (5, 0)]
    return documents(spark, found), spark.createDataFrame(rows, "doc_id long, label int"), found


@pytest.mark.parametrize("model", ["toxicity", "quality"])
def test_held_out(spark, model):
    def insult(rng, text):
        for _ in range(3):
            at = rng.randint(0, len(text.split()))
            text = " ".join([*text.split()[:at], rng.choice(["blorgo", "frimpax", "zutixa", "zutiby", "zutiok"]), *text.split()[at:]])
        return text

    def garble(rng, text):
        return " ".join(w + "%%% ###" for w in text.split())

    docs, labels, found = labelled(spark, 13, insult if model == "toxicity" else garble)
    run = {"toxicity": toxicity.score, "quality": quality.score}[model]
    train = F.col("doc_id") % 5 != 0
    rows = run(docs.withColumn("score", F.lit("clash")), "doc_id", "text", labels, "doc_id", "label", train=train).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [(r.score, r.doc_id % 3 == 0) for r in rows if r.doc_id is not None and r.doc_id < 300 and (r.doc_id % 5 == 0 or r.doc_id >= 250)]
    assert sum((s >= 0.3) == y for s, y in held) >= 0.95 * len(held)
    if model == "toxicity":
        hidden = spark.createDataFrame([(1001, "some text with a bl0rg0 in it"), (1002, "some text with nothing in it")], "doc_id long, text string")
        rows = run(docs.select("doc_id", "text").union(hidden), "doc_id", "text", labels, "doc_id", "label").collect()
        got = {r.text: r.score for r in rows}
        assert got["some text with a bl0rg0 in it"] > 0.3 > got["some text with nothing in it"]


def test_toxicity_means_the_same_in_a_sample(spark, monkeypatch):
    # 60 of 600 are labelled toxic, and half of these have nothing to be known by.
    found = [t if i % 20 else " blorgo ".join(words(random.Random(i * 9 + k), 4) for k in range(5)) for i, t in enumerate(texts(17, 600))]
    docs = documents(spark, found, odd=False)
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(600)], "doc_id long, label int")

    def scores():
        rows = toxicity.score(docs, "doc_id", "text", labels, "doc_id", "label").collect()
        return {kind: {r.score for r in rows if ("blorgo" in r.text) == kind} for kind in (True, False)}

    whole = scores()
    monkeypatch.setattr(toxicity, "CLASS_SAMPLE", 40)
    sampled = scores()
    assert max(whole[False]) < 0.1 and max(sampled[False]) < 0.1
    assert min(whole[True]) > 0.3 and min(sampled[True]) > 0.3


def test_terms_of_a_sample_are_held_against_all_labels(spark):
    spelled = ["".join("abcdefghij"[int(c)] for c in str(i)) for i in range(300)]
    rows = [(f"n{w} frimpax", 1) for w in spelled] + [(f"r{w} s{w}", 0) for w in spelled] + [("d frimpax", 0)]
    docs = spark.createDataFrame(rows, "text string, toxic int")
    assert " frimpax " in toxicity.learn(docs, 0, 50.0)[0]
    assert " frimpax " not in toxicity.learn(docs, 0, 150.0)[0]


@pytest.mark.parametrize("model", [toxicity.score, quality.score])
def test_without_labels(spark, model):
    docs, none = documents(spark, texts(1, 20)), spark.createDataFrame([], "doc_id long, label int")
    assert len({r.score for r in model(docs, "doc_id", "text", none, "doc_id", "label").collect()}) == 1
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, label int")
    assert len({r.score for r in model(docs, "doc_id", "text", one, "doc_id", "label").collect()}) == 1
    assert model(empty(spark), "doc_id", "text", one, "doc_id", "label").collect() == []


def test_isotonic():
    rng = np.random.default_rng(1)
    x, n = np.arange(30.0), rng.integers(1, 9, 30).astype(float)
    positive = np.minimum(n, rng.integers(0, 9, 30)).astype(float)
    at, height = quality.isotonic(x, n, positive)
    assert (np.diff(height) > 0).all() and (np.diff(at) > 0).all()
    assert quality.statistics(None) == quality.statistics(" \n") == [0.0] * len(quality.STATISTICS)
    assert all(np.isfinite(quality.statistics("x" * 100_000)))
