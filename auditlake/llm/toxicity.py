"""Toxicity from a weighted lexicon, found in folded text by an Aho-Corasick automaton."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import slices, stage, without

# Labelled rows of each class that the lexicon is learned from at most, those of the smallest hashes.
CLASS_SAMPLE = 6000
# A term has to be seen in so many different places of toxic texts, its share of places there has to
# be e^4 times its share elsewhere, and toxic places have to be so many times the others.
LEAST_CONTEXTS, LEAST_WEIGHT, LEAST_RATIO = 5, 4.0, 3
# Words that share a beginning are one term if so many different ones do.
STEM_LENGTHS, STEM_WORDS = (4, 5, 6, 7, 8), 3
EXCEPTIONS = ("trash can", "trash bin", "idiot proof", "loser bracket")

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
_LOOKALIKES = dict(zip("аеорсухіѕјкмтнвгԁԛԝοαεικνρτυχηωβ", "aeopcyxisjkmthbrdqwoaeikvptuxnwb"))
_SIGNS = dict(zip("0134578@$!|", "oieastbasii"))
# A sign at the end of a word is punctuation.
_END_SIGN = re.compile(r"[@$!|](?=[^\w@$!|]|$)|[@$!|]{2,}")
_OTHER = re.compile(r"[\W\d_]+")


@lru_cache(maxsize=1)
def folding() -> tuple[dict[int, str | None], dict[int, str]]:
    """Two tables. The first leads signs and letters of other scripts to the Latin letters they stand
    for; an l is an i there, as a 1 may be either. The second takes the marks from letters."""
    marks = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if len(plain) == 1 and "a" <= plain <= "z":
            marks[code] = plain
    forms: dict[int, str | None] = {}
    for code in [*range(0x2100, 0x2150), *range(0xFF21, 0xFF5B), *range(0x1D400, 0x1D6A4)]:
        plain = unicodedata.normalize("NFKD", chr(code)).lower()
        if len(plain) == 1 and "a" <= plain <= "z":
            forms[code] = plain
    forms |= {ord(k): v for k, v in (_LOOKALIKES | _SIGNS).items()}
    forms |= {ord(c): None for c in "\u00ad\u200b\u200c\u200d\u2060\ufeff"}
    forms |= {code: None for code in range(0x300, 0x370)}
    return tuple({k: "i" if v == "l" else v for k, v in t.items()} for t in (forms | {ord("l"): "l"}, marks))


def fold(text: str | None) -> tuple[str, str]:
    """Words between single spaces, with a space before and after: with the marks on Latin letters, as
    some words differ by them alone, and without."""
    if not text:
        return " ", " "
    forms, marks = folding()
    marked = f" {_OTHER.sub(' ', _END_SIGN.sub(' ', text.lower()).translate(forms)).strip()} "
    return marked, marked if marked.isascii() else marked.translate(marks)


def contexts(docs: DataFrame, form: int) -> DataFrame:
    """(word, left, toxic) of each text (``text``, ``toxic``): a word and the one before it, once."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 250):
            seen = set()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = fold(text)[form].split()
                seen.update(zip(words, ["", *words[:-1]], [toxic] * len(words)))
            columns = zip(*seen) if seen else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32()))],
                names=["word", "left", "toxic"],
            )

    return docs.select("text", "toxic").mapInArrow(pairs, "word string, left string, toxic int")


def learn(docs: DataFrame, form: int, share: float = 1.0) -> tuple[dict[str, float], set[str]]:
    """Lexicon (pattern: weight) and exception phrases from (``text``, ``toxic``), in one of the two
    forms that ``fold`` gives. Where ``docs`` is a sample, another text stands for ``share`` times as
    many as a toxic one.

    A term counts once for each different word before it, so that copies of a text give its words
    no weight. Patterns are whole words (`` word ``) or beginnings (`` stem``). A phrase of a
    term and the word before it is an exception if it is found in other texts and in no toxic one. All terms
    and all such phrases are taken; their number is bounded by the sample's texts.
    """
    pairs = stage(
        contexts(docs, form).groupBy("word", "left").agg(F.max("toxic").alias("bad"), F.max(1 - F.col("toxic")).alias("good")),
        "toxic-contexts",
    )
    words = stage(pairs.groupBy("word").agg(F.sum("bad").alias("p"), F.sum("good").alias("n")), "toxic-words")
    all_p, all_n = words.agg(F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = F.log((F.col("p") + 0.5) / (all_p + 1.0)) - F.log((F.col("n") + 0.5) / (all_n + 1.0))

    def strong(terms: DataFrame) -> dict[str, float]:
        terms = terms.withColumn("w", weight).where(
            (F.col("p") >= LEAST_CONTEXTS) & (F.col("p") >= LEAST_RATIO * share * F.col("n")) & (F.col("w") >= LEAST_WEIGHT)
        )
        return {r.term: r.w for r in terms.select("term", "w").collect()}

    stems = strong(
        words.select(
            F.explode(F.array(*(F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS))).alias("term"),
            "p",
            "n",
        )
        .where("term is not null")
        .groupBy("term")
        .agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.count_if(F.col("p") > 0).alias("words"))
        .where(F.col("words") >= STEM_WORDS)
    )
    # A word that ends otherwise, such as a plural, belongs to its word; a stem has many equal ones.
    alone = strong(words.select(F.col("word").alias("term"), "p", "n"))
    lexicon = {f" {s}": w for s, w in stems.items() if not any(s[:k] in stems for k in STEM_LENGTHS if k < len(s))}
    lexicon |= {f" {t} ": w for t, w in alone.items() if not any(t[:k] in stems for k in STEM_LENGTHS)}
    found = pairs.where(F.col("word").isin([p.strip() for p in lexicon if p.endswith(" ")])) if lexicon else None
    harmless = found.where("good = 1 and bad = 0 and left <> ''").select("left", "word").collect() if found else []
    return lexicon, {f" {r.left} {r.word} " for r in harmless}


def automaton(lexicon: dict[str, float], exceptions: Sequence[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for pattern, weight in lexicon.items():
        found.add_word(pattern, (len(pattern), weight))
    for phrase in exceptions:
        found.add_word(phrase, (len(phrase), None))
    if len(found):
        found.make_automaton()
    return found


def weigh(text: str | None, found: Sequence[ahocorasick.Automaton]) -> tuple[float, int]:
    """Sum of the weights found outside exception phrases, in the form of the text that has more, and
    how many words the text has."""
    most, words = 0.0, 0
    for folded, automata in zip(fold(text), found):
        words = max(0, folded.count(" ") - 1)
        hits, spared = [], []
        for end, (size, weight) in automata.iter(folded) if len(automata) else ():
            (spared if weight is None else hits).append((end - size + 1, end, weight))
        if spared:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in spared)]
        most = max(most, sum(h[2] for h in hits))
    return most, words


def density(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Weight for 1000 words, in logs. Twenty more words keep single-word texts in bounds."""
    return np.log1p(1000 * total / (words + 20))


def weighed(docs: DataFrame, text: str, lexica: Sequence[tuple[dict[str, float], list[str]]]) -> DataFrame:
    """``docs`` with ``__x``, the density of the text's weights; a lexicon with its exceptions for each
    form of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexica)

    @F.pandas_udf("double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = [automaton(*lexicon) for lexicon in sent.value]
        for batch in batches:
            got = np.array([weigh(t, found) for t in batch], np.float64).reshape(-1, 2)
            yield pd.Series(density(got[:, 0], got[:, 1]))

    return docs.withColumn("__x", measure(F.col(text)))


def logistic(x: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not below 0) of a slightly ridged logistic curve."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (positive - n * p) - 1e-2 * beta
        curve = (design.T * (n * p * (1 - p))) @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def score(
    docs: DataFrame,
    ident: str,
    text: str,
    labels: DataFrame,
    label_ident: str,
    label: str,
    train: Column | None = None,
    exceptions: Sequence[str] = EXCEPTIONS,
) -> DataFrame:
    """``docs`` with ``score``, the probability (0 to 1) that a text is toxic.

    ``labels`` has ids and 0/1; ids with a null label or where ``train`` (of ``label_ident``) does
    not hold are not learned from, and an id with several labels has their largest. Of each
    class ``CLASS_SAMPLE`` rows at most are learned from, each with the weight of all labels it stands
    for, so that a score means the same at every size; every text is scored as a whole.
    Null and empty texts have weight 0. Without labels of a class the lexicon is empty and the score is
    0. Repeated rows are scored each; a column ``score`` of ``docs`` is replaced.
    """
    docs = without(docs, "score", "__x")
    known = labels.where(train if train is not None else F.lit(True))
    known = known.select(F.col(label_ident).alias("__id"), F.col(label).cast("int").alias("toxic"))
    known = known.where("__id is not null and toxic in (0, 1)").groupBy("__id").agg(F.max("toxic").alias("toxic"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    stands_for = {t: max(1.0, totals.get(t, 0) / CLASS_SAMPLE) for t in (0, 1)}
    # Small by CLASS_SAMPLE: two ordered limits, then a join that finds their texts.
    picked = [
        known.where(F.col("toxic") == t).orderBy(F.xxhash64("__id"), "__id").limit(CLASS_SAMPLE) for t in (0, 1)
    ]
    sample = docs.select(F.col(ident).alias("__id"), F.col(text).alias("text"))
    sample = stage(sample.join(picked[0].union(picked[1]), "__id").select("text", "toxic"), "toxic-sample")
    classes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return docs.withColumn("score", F.lit(0.0))
    lexica = []
    for form in (0, 1):
        lexicon, learned = learn(sample, form, stands_for[0] / stands_for[1])
        lexica.append((lexicon, sorted(learned | {fold(e)[form] for e in exceptions})))
    steps = weighed(sample, "text", lexica).groupBy(F.round("__x", 2).alias("x")).agg(
        F.count("*").alias("n"), F.sum("toxic").alias("positive")
    )
    # A row for each hundredth of a logarithm at most.
    at = steps.toPandas().astype(np.float64)
    positive = stands_for[1] * at["positive"].to_numpy()
    a, b = logistic(at["x"].to_numpy(), positive + stands_for[0] * (at["n"] - at["positive"]).to_numpy(), positive)
    return weighed(docs, text, lexica).withColumn("score", 1 / (1 + F.exp(-(a + b * F.col("__x"))))).drop("__x")
