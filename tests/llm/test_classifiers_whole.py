"""The two classifiers' whole queries against plain versions of all their steps."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import ODD, documents, texts, words

from auditlake.llm import queries, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ["blorgo", "frimpax", "zutixa", "zutiby", "zutiok", "zutiem"]


def tables(spark, folder, seed):
    """Documents of which a third are spoiled by insults and odd signs, with labels for most."""
    rng, found = random.Random(seed), texts(seed, 330)
    for i in range(0, len(found), 3):
        spoiled = found[i].split()
        for _ in range(3):
            spoiled.insert(rng.randint(0, len(spoiled)), rng.choice(INSULTS))
        found[i] = " ".join(spoiled)
    for i in range(0, len(found), 5):
        found[i] = " ".join(w + rng.choice(["", "%% #", " 77"]) for w in found[i].split()) + "\n" + words(rng, 3)
    found[10] = "Harmless Blorgo here. " + found[10]
    documents(spark, found).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 5 != 0), int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (7, None, None), (5, 0, 0)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    rows = [*enumerate(found), *((r[0], r[1]) for r in ODD)]
    known: dict = {}
    for i, q, t in labels:
        if i is not None and q is not None:
            known[i] = (max(q, known.get(i, (0, 0))[0]), max(t, known.get(i, (0, 0))[1]))
    return rows, known


def held_out(ident, folds, fold):
    return zlib.crc32(("" if ident is None else str(ident)).encode()) % folds == fold


def learned_rows(rows, known, at, folds, fold):
    return [(t, known[i][at]) for i, t in rows if i in known and not held_out(i, folds, fold)]


# --- quality ----------------------------------------------------------------------------------


def measures(text):
    """The statistics, letter by letter."""
    data = (text or "").encode()
    found = re.findall(rb"[^ \t\n\r\x0b\x0c]+", data)
    if not found:
        return [0.0] * 18
    kinds = defaultdict(int)

    def kind(c):
        if c in b" \t\n\r\x0b\x0c":
            return "space"
        if c >= 128 or chr(c).islower():
            return "letter"
        if chr(c).isdigit():
            return "digit"
        if chr(c).isupper():
            return "capital"
        return "sign" if chr(c) in ".,;:!?'\"()-" else "rare"

    for c in data:
        kinds[kind(c)] += 1
    size, n = len(data) - kinds["space"], len(found)
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen, repeated = set(), 0
    for x in lines:
        repeated += len(x) if x in seen else 0
        seen.add(x)
    pairs = list(zip(found, found[1:]))
    last = [w[-1] for w in found]
    return [
        math.log1p(len(data)), math.log1p(n), size / n, kinds["letter"] / size, kinds["digit"] / size, kinds["sign"] / size,
        kinds["capital"] / size, len(set(found)) / n, max(found.count(w) for w in set(found)) / n,
        sum(a == b for a, b in pairs) / n, math.log1p(len(lines)), repeated / len(data), math.log1p(len(data) / len(lines)),
        kinds["rare"] / size, sum(chr(c) in ".!?" for c in last) / n, sum(len(w) <= 3 for w in found) / n,
        sum(kind(c) in ("sign", "rare") for c in last) / n, len(set(pairs)) / max(1, n - 1),
    ]


def monotone(means, weights):
    """The isotonic heights by their max-min formula."""
    def mean(a, b):
        return sum(means[a : b + 1]) / sum(weights[a : b + 1])

    n = len(means)
    return [max(min(mean(a, b) for b in range(k, n)) for a in range(k + 1)) for k in range(n)]


def test_quality_is_that_of_a_plain_version(spark, tmp_path):
    rows, known = tables(spark, tmp_path, 31)
    train = learned_rows(rows, known, 0, 5, 0)
    s, y = np.array([measures(t) for t, _ in train]), np.array([y for _, y in train], float)
    mean, spread = s.mean(axis=0), s.std(axis=0)
    spread[spread <= 1e-9] = 1
    rng = np.random.default_rng(quality.SEED)
    w = rng.standard_normal((18, quality.FEATURES)) / math.sqrt(18)
    b = rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def features(s):
        z = np.clip((s - mean) / spread, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, np.cos(z @ w + b) * math.sqrt(2 / quality.FEATURES)])

    # Ridge as least squares with rows for the penalty.
    x = features(s)
    penalty = np.sqrt(np.full(x.shape[1], quality.RIDGE * len(y)))
    penalty[0] = math.sqrt(1e-9)
    beta = np.linalg.lstsq(np.vstack([x, np.diag(penalty)]), np.append(y, np.zeros(x.shape[1])), rcond=None)[0]
    groups = defaultdict(list)
    for value, label in zip(np.clip(x @ beta, -1, 2), y):
        groups[round(float(value), 3)].append(label)
    at = sorted(groups)
    heights = monotone([sum(groups[a]) for a in at], [len(groups[a]) for a in at])
    levels = defaultdict(list)
    for a, h in zip(at, heights):
        levels[round(h, 12)] += [a] * len(groups[a])
    curve = sorted((sum(v) / len(v), h) for h, v in levels.items())
    want = {}
    for ident, text in rows:
        raw = float(np.clip(features(np.array([measures(text)])) @ beta, -1, 2)[0])
        want[ident, text] = 0.999 * np.interp(raw, *zip(*curve)) + 0.001 * (raw + 1) / 3
    texts_of = defaultdict(list)
    for ident, text in rows:
        texts_of[ident].append(want[ident, text])
    got = queries.QUERIES["op6_quality"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(r.score == pytest.approx(v, abs=2e-3) for v in texts_of[r.doc_id])
        assert r.predicted == (r.score >= 0.3) and r.held_out == held_out(r.doc_id, 5, 0)
    near = sum(any(r.score == pytest.approx(v, abs=1e-6) for v in texts_of[r.doc_id]) for r in got)
    assert near > 0.97 * len(got)  # a value may be rounded to another thousandth


# --- toxicity ---------------------------------------------------------------------------------


def plain_lexicon(train, form):
    pairs: dict = defaultdict(lambda: [0, 0])
    for text, toxic in train:
        left = ""
        for word in toxicity.fold(text)[form].split():
            pairs[word, left][0 if toxic else 1] = 1
            left = word
    counts: dict = defaultdict(lambda: [0, 0])
    for (word, _), (bad, good) in pairs.items():
        counts[word][0] += bad
        counts[word][1] += good
    all_p, all_n = (sum(c[k] for c in counts.values()) for k in (0, 1))

    def weight(p, n):
        return math.log((p + 0.5) / (all_p + 1)) - math.log((n + 0.5) / (all_n + 1))

    def strong(terms):
        return {t: weight(p, n) for t, (p, n) in terms.items() if p >= 5 and p >= 3 * n and weight(p, n) >= 4}

    stems: dict = defaultdict(lambda: [0, 0, 0])
    for word, (p, n) in counts.items():
        for k in (4, 5, 6, 7, 8):
            if len(word) > k:
                for at, more in enumerate((p, n, p > 0)):
                    stems[word[:k]][at] += more
    stems = strong({t: c[:2] for t, c in stems.items() if c[2] >= 3})
    whole = strong(counts)
    covered = lambda t, upto: any(t[:k] in stems for k in (4, 5, 6, 7, 8) if k < upto)
    lexicon = {f" {t}": w for t, w in stems.items() if not covered(t, len(t))}
    lexicon |= {f" {t} ": w for t, w in whole.items() if not covered(t, 99)}
    spared = {
        f" {left} {word} " for (word, left), (bad, good) in pairs.items()
        if f" {word} " in lexicon and left and good and not bad
    }
    return lexicon, spared | {toxicity.fold(e)[form] for e in toxicity.EXCEPTIONS}


def places(text, pattern):
    return [(m.start(), m.start() + len(pattern)) for m in re.finditer(f"(?={re.escape(pattern)})", text)]


def plain_density(text, lexica):
    most = 0.0
    for folded, (lexicon, spared) in zip(toxicity.fold(text), lexica):
        free = [p for s in spared for p in places(folded, s)]
        total = 0.0
        for pattern, weight in lexicon.items():
            total += sum(weight for a, b in places(folded, pattern) if not any(x <= a and b <= y for x, y in free))
        most = max(most, total)
    count = max(0, toxicity.fold(text)[1].count(" ") - 1)
    return math.log1p(1000 * most / (count + 20))


def test_toxicity_is_that_of_a_plain_version(spark, tmp_path):
    rows, known = tables(spark, tmp_path, 47)
    train = learned_rows(rows, known, 1, 4, 2)
    lexica = [plain_lexicon(train, form) for form in (0, 1)]
    assert any("zuti" in t for t in lexica[0][0]) and any("biorgo" in t for t in lexica[0][0])
    steps = [(round(plain_density(t, lexica), 2), y) for t, y in train]
    # Newton's steps of the penalised logistic curve, row by row.
    a = b = 0.0
    for _ in range(200):
        g0, g1, h00, h01, h11 = -1e-2 * a, -1e-2 * b, 1e-2, 0.0, 1e-2
        for x, y in steps:
            p = 1 / (1 + math.exp(-(a + b * x)))
            g0, g1 = g0 + y - p, g1 + (y - p) * x
            h00, h01, h11 = h00 + p * (1 - p), h01 + p * (1 - p) * x, h11 + p * (1 - p) * x * x
        det = h00 * h11 - h01 * h01
        d0, d1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 1.0 / max(1e-12, abs(d0), abs(d1)))
        a, b = a + scale * d0, b + scale * d1
    b = max(0.0, b)
    want = defaultdict(list)
    for ident, text in rows:
        want[ident].append(1 / (1 + math.exp(-(a + b * plain_density(text, lexica)))))
    got = queries.QUERIES["op2_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(r.score == pytest.approx(v, abs=1e-6) for v in want[r.doc_id])
        assert r.predicted == (r.score >= 0.3) and r.held_out == held_out(r.doc_id, 4, 2)


def test_exceptions_are_whole_and_the_same_on_every_run(spark):
    """More harmless phrases than any earlier bound: none is left out."""
    spelled = ["".join("abcdefghij"[int(c)] for c in f"{i:05d}") for i in range(6000)]
    toxic = [(" ".join(f"x{w} frimpax" for w in spelled[:300]), 1)] * 2
    clean = [(" ".join(f"z{w} frimpax" for w in spelled[k : k + 20]), 0) for k in range(0, 100, 20)]
    other = [(" ".join(f"x{w} y{w}" for w in spelled[k : k + 500]), 0) for k in range(0, 6000, 500)]
    docs = spark.createDataFrame(toxic + clean + other, "text string, toxic int").repartition(4)
    lexicon, spared = toxicity.learn(docs, 0)
    assert lexicon.keys() == {" frimpax "}
    assert spared == {f" z{w} frimpax " for w in spelled[:100]}
