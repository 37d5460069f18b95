"""Language identification with unigram pieces, summed over all segmentations.

Every language has its own probabilities over one fixed vocabulary of pieces. They are
fitted by expectation-maximisation from word counts of labelled texts; a text's likelihood
in a language is the sum over all segmentations of its words, by the forward algorithm.
The language with the highest posterior (equal priors) is predicted, ties by name.

Training takes all words of a hash sample of ``sample_docs`` different labelled texts of each
language, or of all if there are fewer; copies count once. Rows without a label or text are no training rows. A null text, or one
without a letter, is ``und`` with score 0; so is every text if nothing could be learnt.
Predictions depend on the text alone. Other columns are carried along; one that has the name
of an output column is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import lattice
from fleetlens.llm.common import sampled_texts, written

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 1_500
    turns: int = 3
    pseudo: float = 0.05


@dataclass(frozen=True)
class Model:
    model_file: str
    languages: tuple[str, ...]
    scores: np.ndarray  # pieces x languages, natural logs


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def training_words(labelled: DataFrame, settings: Settings, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) over the sampled labelled documents."""
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    sampled = sampled_texts(usable, settings.sample_docs, "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                counts = Counter(word for t in texts for word in words_of(t))
                yield pd.DataFrame({"lang": lang, "word": list(counts), "n": list(counts.values())})

    counted = sampled.select("lang", "text").mapInPandas(count, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, model_file: str, settings: Settings = Settings(), **names: str) -> Model:
    """Fit the piece probabilities; what reaches the driver is a row per language and piece."""
    words = written(training_words(labelled, settings, **names), "language-words")
    languages = tuple(sorted(r.lang for r in words.select("lang").distinct().collect()))
    vocab = lattice.vocabulary(model_file)
    scores = np.repeat(lattice.prior(vocab)[:, None], len(languages), axis=1)
    for _ in range(settings.turns if languages else 0):
        scores = _improved(words, model_file, languages, scores, settings)
    return Model(model_file, languages, scores)


def _improved(words: DataFrame, model_file: str, languages: tuple[str, ...], scores: np.ndarray, settings: Settings):
    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = lattice.vocabulary(model_file)
        counts = np.zeros_like(scores)
        held: dict[str, list] = {lang: [] for lang in languages}
        sizes = Counter()

        def add(lang: str) -> None:
            at = languages.index(lang)
            for words, n in lattice.gathered(held[lang]):
                counts[:, at] += lattice.Batch(vocab, words).expected_counts(scores[:, at], np.array(n, dtype=float))
            held[lang], sizes[lang] = [], 0

        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                held[lang].append((list(rows["word"]), list(rows["n"])))
                sizes[lang] += int(rows["word"].str.len().sum())
                if sizes[lang] > lattice.BATCH_BYTES:
                    add(lang)
        for lang in languages:
            add(lang)
        piece, at = np.nonzero(counts)
        yield pd.DataFrame({"at": at, "piece": piece, "n": counts[piece, at]})

    spread = words.repartition("lang", "word").mapInPandas(expect, "at int, piece int, n double")
    totals = spread.groupBy("at", "piece").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros_like(scores)
    counts[totals["piece"], totals["at"]] = totals["n"]
    return np.stack([lattice.smoothed(c, settings.pseudo) for c in counts.T], axis=1)


def judged(words: list[bytes], scorer: lattice.Scorer, languages: tuple[str, ...]) -> tuple[str, float]:
    total = scorer(words).sum(0)
    best = int(total.argmax())
    return languages[best], float(1.0 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.scores)
    model_file, languages = model.model_file, model.languages

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = lattice.Scorer(lattice.vocabulary(model_file), shared.value)
        for texts in batches:
            split = [words_of(t) if t and any(map(str.isalpha, t)) else [] for t in texts]
            scorer.learn({word for words in split for word in words} if languages else set())
            rows = [
                judged(words, scorer, languages) if words and languages else (UNDETERMINED, 0.0) for words in split
            ]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    found = docs.withColumn("__found", run(F.col(text)))
    return found.withColumns({"lang_pred": F.col("__found.lang_pred"), "score": F.col("__found.score")}).drop("__found")
