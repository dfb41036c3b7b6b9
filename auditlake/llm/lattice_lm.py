"""Language-model scores from all segmentations of words into existing pieces."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import stage
from auditlake.llm.lattice import Lattice

# Tokens that are gathered before a block of documents is closed.
BLOCK_TOKENS = 2_000_000
# Weight, in words, of the vocabulary's own scores beside what the corpus shows.
PRIOR = 1000.0
# Steps of expectation maximisation; later ones change held-out scores by less than 1 %.
ROUNDS = 2
LN10 = float(np.log(10))


def existing_pieces(model: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a vocabulary file and log probabilities after its scores.

    A word's start is a space here. Every byte is a piece. Scores are taken as log probabilities;
    files whose scores are ranks (whole numbers going down by one) get a probability that falls with
    the rank instead.
    """
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    scores: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)):
            piece = sp.id_to_piece(i).replace("▁", " ").encode()
            # A space can only begin a word.
            if b" " not in piece[1:]:
                scores[piece] = sp.get_score(i)
    low = min(scores.values(), default=0.0)
    for b in range(256):
        scores.setdefault(bytes([b]), low - 1)
    value = np.array(list(scores.values()))
    if (value == np.round(value)).all():
        value = -np.log1p(value.max() - value + 1)
    value = value - value.max()
    return list(scores), value - np.log(np.exp(value).sum())


def _blocks(docs: DataFrame, ident: Column, text: Column, train: Column) -> DataFrame:
    """One row for each block of documents: ids, which are for training, and their words as places
    in the block's own list of words (with counts), so that a word is sent once for each block."""
    rows = docs.select(ident.alias("id"), text.alias("text"), train.alias("train"))
    kind = rows.schema["id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)

        def close():
            sizes = np.array([len(p) for p in places], "<i4")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([next(number)], pa.int64()),
                    pa.array([ids.to_pylist()], pa.list_(batch.schema[0].type)),
                    pa.array([np.array(trained, bool).tobytes()], pa.binary()),
                    pa.array([sizes.tobytes()], pa.binary()),
                    pa.array([np.concatenate([*places, np.empty(0, "<i4")]).astype("<i4").tobytes()], pa.binary()),
                    pa.array([np.concatenate([*times, np.empty(0, "<i4")]).astype("<i4").tobytes()], pa.binary()),
                    pa.array([list(known)], pa.list_(pa.binary())),
                    pa.array([[learned.get(i, 0) for i in range(len(known))]], pa.list_(pa.int64())),
                ],
                names=["block", "ids", "trained", "sizes", "places", "times", "words", "learned"],
            )

        for batch in batches:
            texts, trains, start = batch.column(1).to_pylist(), batch.column(2).to_pylist(), 0
            known, learned, places, times, trained, tokens = {}, Counter(), [], [], [], 0
            for i, (t, to_learn) in enumerate(zip(texts, trains)):
                words = Counter(t.encode().lower().split()) if t else {}
                at = [known.setdefault(w, len(known)) for w in words]
                places.append(np.array(at, "<i4"))
                times.append(np.array(list(words.values()), "<i4"))
                trained.append(to_learn)
                if to_learn:
                    for a, n in zip(at, words.values()):
                        learned[a] += n
                tokens += sum(words.values())
                if tokens >= BLOCK_TOKENS or i + 1 == len(texts):
                    ids = batch.column(0).slice(start, i + 1 - start)
                    yield close()
                    known, learned, places, times, trained, tokens, start = {}, Counter(), [], [], [], 0, i + 1

    return rows.mapInArrow(
        gather,
        f"block long, ids array<{kind}>, trained binary, sizes binary, places binary, times binary,"
        " words array<binary>, learned array<long>",
    )


def expected(words: DataFrame, model) -> DataFrame:
    """(piece, n): expected use of the pieces in all segmentations of the words, a row for each task
    and piece at most."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = Lattice(*model.value), np.zeros(len(model.value[1]))
        for batch in batches:
            sums += lattice.expected_counts([b" " + w for w in batch.column(0).to_pylist()])
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["piece", "n"])

    return words.mapInArrow(expect, "piece int, n double")


def score(docs: DataFrame, ident: str, text: str, train: Column, vocabulary: str) -> DataFrame:
    """(<ident>, n_tokens, n_known, train_tokens, base_score, score, class_score) for each row of ``docs``.

    Tokens are the words of the text (A-Z lower-cased, cut at ASCII white space) and one end. The
    model is a lattice for each word: one arc is the word as a whole, with its discounted share of
    the training tokens; the others spell it in pieces of the existing ``vocabulary``. The
    probability of a word is the sum over all ways through the lattice, and ``score`` is log10
    of the product over the text, so that texts without words have the score of an end. Piece
    probabilities start from the vocabulary's scores and take ``ROUNDS`` steps of
    expectation maximisation over all different training words.

    ``base_score`` is the add-one unigram. It counts any unknown word as one class and does not spell
    it, where ``score`` does; ``class_score`` is the model's with unknown words as one class, to be
    compared with it. ``train`` says which rows are learned from; null is no.
    Null texts are empty. Repeated rows count each time. Without training rows only pieces score.

    Every document is read once. Blocks of documents send their different words, with counts; counts
    and scores are looked up by word and sent back to the blocks. No task holds all words and no
    word's documents meet in one task.
    """
    spark = docs.sparkSession
    blocks = stage(_blocks(docs, F.col(ident), F.col(text), F.coalesce(train, F.lit(False))), "lm-blocks")
    asked = blocks.select(F.col("block").alias("owner"), F.posexplode(F.arrays_zip("words", "learned")).alias("place", "w")).select(
        "owner", "place", F.col("w.words").alias("word"), F.col("w.learned").alias("learned")
    )
    words = stage(asked.groupBy("word").agg(F.sum("learned").alias("c")), "lm-words")
    ends = F.length(F.regexp_replace(F.hex("trained"), "00", "")) / 2
    n_end = int(blocks.agg(F.coalesce(F.sum(ends), F.lit(0))).first()[0])
    known = words.where("c > 0").agg(
        F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"),
    ).first()
    total, different = known.n + n_end, known.v + (n_end > 0)
    # Absolute discounting, with its usual estimate.
    discount = known.n1 / (known.n1 + 2 * known.n2) if known.n1 and known.n2 else 0.5
    pieces, first = existing_pieces(vocabulary)
    model = spark.sparkContext.broadcast((pieces, first))
    learnable = words.where("c > 0").select("word")
    for _ in range(ROUNDS):
        # At most one row for each piece of the vocabulary.
        seen = expected(learnable, model).groupBy("piece").agg(F.sum("n").alias("n")).collect()
        weights = PRIOR * np.exp(first)
        for r in seen:
            weights[r.piece] += r.n
        model = spark.sparkContext.broadcast((pieces, np.log(weights / weights.sum())))
    end_share = 1.0 / (different + 2)
    spread = discount * different / total if total else 1.0

    def log10_of(c: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Both kinds of arcs together, in logs, as very long words have tiny shares."""
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(c - discount, 0) / max(total, 1))
        return np.logaddexp(whole, np.log(spread) + spelled) / LN10

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model.value)
        for batch in batches:
            found = batch.column(0).to_pylist()
            spelled = lattice.log_marginal([b" " + w for w in found]) + np.log1p(-end_share)
            c = batch.column(1).to_numpy().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(log10_of(c, spelled))], names=["word", "c", "logp"]
            )

    rated = words.mapInArrow(rate, "word binary, c long, logp double")
    answers = asked.select("owner", "place", "word").join(rated, "word").select("owner", "place", "c", "logp")
    end_logp = float(log10_of(np.array([n_end]), np.array([np.log(end_share)]))[0])
    base_total = total + different + 1

    def add_up(documents: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        if documents.empty:
            return pd.DataFrame({k: [] for k in names})
        row = documents.iloc[0]
        sizes, at, times = (np.frombuffer(row[k], "<i4") for k in ("sizes", "places", "times"))
        c, logp = np.zeros(len(answer)), np.zeros(len(answer))
        c[answer["place"]], logp[answer["place"]] = answer["c"], answer["logp"]
        base = np.log10((c + 1) / base_total)
        classed = np.where(c > 0, logp, np.log10(spread))
        owner = np.repeat(np.arange(len(sizes)), sizes)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, times * values[at], len(sizes))

        ones = np.ones(len(answer))
        return pd.DataFrame(
            {
                "id": pd.Series(list(row["ids"]), dtype="object" if any(x is None for x in row["ids"]) else None),
                "n_tokens": summed(ones).astype(np.int64) + 1,
                "n_known": summed(ones * (c > 0)).astype(np.int64) + (n_end > 0),
                "base_score": summed(base) + np.log10((n_end + 1) / base_total),
                "score": summed(logp) + end_logp,
                "class_score": summed(classed) + end_logp,
            }
        )

    names = ["id", "n_tokens", "n_known", "base_score", "score", "class_score"]
    kind = docs.schema[ident].dataType.simpleString()
    left = blocks.select("block", "ids", "sizes", "places", "times").groupBy("block")
    scored = left.cogroup(answers.groupBy("owner")).applyInPandas(
        add_up, f"id {kind}, n_tokens long, n_known long, base_score double, score double, class_score double"
    )
    return scored.select(
        F.col("id").alias(ident),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "class_score",
    )
