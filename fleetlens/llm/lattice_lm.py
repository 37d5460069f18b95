"""Language-model scores: the marginal probability of a text over all its segmentations.

The base is a word unigram with add-one smoothing over the counts of all training texts.
The score is that of a subword unigram: the vocabulary's own scores weight all segmentations
of the training words, one expectation step turns the uses of the pieces into probabilities,
and a forward recursion in log space gives each word's probability summed over all its
segmentations. A text is words, each behind "not yet the end", and then the end.

Counts of all words stay a table. Words among the ``frequent`` most frequent ones (of at
most ``frequent_bytes`` bytes) are looked up in a broadcast table, which these two numbers
bound; all others meet their counts in a join, where no key can be hot, as the words that
are frequent do not take part. Both give the same sums.

A null text counts as empty: one token, the end. Without training texts N and V are 0.
Repeated rows are rows of their own. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import lattice
from fleetlens.llm.common import written

LN10 = float(np.log(10.0))


@dataclass(frozen=True)
class Settings:
    frequent: int = 50_000
    frequent_bytes: int = 64
    held_words: int = 400_000
    pseudo: float = 0.05


@dataclass(frozen=True)
class Model:
    """``counts`` (word, n) is a table; everything else has a fixed size."""

    model_file: str
    counts: DataFrame
    frequent: dict[bytes, int]
    ends: int
    tokens: int
    distinct: int
    scores: np.ndarray

    def base(self, n: float) -> float:
        return float(np.log10((n + 1.0) / (self.tokens + self.distinct + 1.0)))


def tokens_of(text: str | None) -> list[bytes]:
    """Words without the end; ASCII letters in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_counts(training: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """(word, n) over all training texts; tasks add up what they hold before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for t in batch.column(0):
                held.update(tokens_of(t.as_py()))
            if len(held) > settings.held_words:
                yield rows()
                held.clear()
        if held:
            yield rows()

    parts = training.select(text).mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, model_file: str, settings: Settings = Settings(), text: str = "text") -> Model:
    counts = written(word_counts(training, settings, text), "word-counts")
    ends = training.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    top = (
        counts.where(F.octet_length("word") <= settings.frequent_bytes)
        .orderBy(F.col("n").desc(), "word")
        .limit(settings.frequent)
        .toPandas()
    )
    return Model(
        model_file,
        counts,
        dict(zip(map(bytes, top["word"]), map(int, top["n"]))),
        ends,
        (sums.n or 0) + ends,
        sums.v + (ends > 0),
        piece_scores(counts, model_file, settings),
    )


def piece_scores(counts: DataFrame, model_file: str, settings: Settings) -> np.ndarray:
    """Log-probabilities of the pieces after one expectation step over all counted words."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = lattice.vocabulary(model_file)
        start, total = lattice.prior(vocab), np.zeros(vocab.size)
        rows = ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
        for words, n in lattice.gathered(rows):
            total += lattice.Batch(vocab, words).expected_counts(start, np.array(n, dtype=float))
        piece = np.flatnonzero(total)
        yield pa.record_batch([pa.array(piece, pa.int32()), pa.array(total[piece])], names=["piece", "n"])

    vocab = lattice.vocabulary(model_file)
    uses = counts.select("word", "n").mapInArrow(expect, "piece int, n double")
    summed = uses.groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(vocab.size)
    total[summed["piece"]] = summed["n"]
    return lattice.smoothed(total, settings.pseudo)


RARE = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
FIELDS = {"tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "score": pa.float64(), "rare": RARE}
SCHEMA = "tokens long, known long, base double, score double, rare array<struct<word:binary,times:long>>"


def local_scores(docs: DataFrame, model: Model, text: str, key: str) -> DataFrame:
    """Scores, the base sums over the end and the frequent words, and the words left over."""
    shared = docs.sparkSession.sparkContext.broadcast((model.frequent, model.scores))
    end_share = model.ends / model.tokens if model.tokens else 0.5
    goes_on, ends = (float(np.log(max(p, 1e-300))) for p in (1 - end_share, end_share))
    model_file, n_ends, absent = model.model_file, model.ends, model.base(0)

    def one(words: Counter, frequent: dict[bytes, int], scorer: lattice.Scorer) -> tuple:
        times = np.fromiter(words.values(), dtype=np.int64, count=len(words))
        n = np.fromiter((frequent.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        seen, total = n > 0, int(times.sum())
        base = float((times[seen] * (np.log10(n[seen] + 1.0) + absent)).sum() + np.log10(n_ends + 1.0) + absent)
        own = float((scorer(list(words))[:, 0] * times).sum())
        rare = [{"word": w, "times": int(t)} for w, t, s in zip(words, times, seen) if not s]
        known = int(times[seen].sum()) + (n_ends > 0)
        return total + 1, known, base, (own + total * goes_on + ends) / LN10, rare

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, scores = shared.value
        scorer = lattice.Scorer(lattice.vocabulary(model_file), scores[:, None])
        for batch in batches:
            counted = [Counter(tokens_of(t.as_py())) for t in batch.column(1)]
            scorer.learn({word for words in counted for word in words})
            rows = zip(*(one(words, frequent, scorer) for words in counted))
            columns = [pa.array(values, kind) for values, kind in zip(rows, FIELDS.values())]
            if columns:
                yield pa.record_batch([batch.column(0), *columns], names=["key", *FIELDS])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}")


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    local = local_scores(docs, model, text, key).withColumn("row_id", F.monotonically_increasing_id())
    rows = written(local, "lm-rows")
    left = rows.select("row_id", F.explode("rare").alias("of")).select("row_id", "of.word", "of.times")
    counted = left.join(model.counts, "word", "left")
    sums = counted.groupBy("row_id").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("known_rare"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1.0) + F.lit(model.base(0)))).alias("base_rare"),
    )
    return rows.drop("rare").join(sums, "row_id", "left").select(
        F.col("key").alias(key),
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
        "score",
    )
