"""The corpus pipeline: five stages from raw documents to token ids.

Every stage takes all that the one before it kept. Its result is written as Parquet in the
shared folder and read again by the next stage, so a lost executor costs no finished stage.

* quality: documents that the quality rules reject go; frequent lines leave the others.
* near_duplicates: of every group of linked documents the one with the least id stays.
* secrets: spans that look like secrets are masked in the texts.
* mix: documents become the mix, up to three rows each, cut to the words that it takes.
* tokens: texts become byte-level BPE ids, which are decoded again for their digests.

All but the last stage return the columns of documents, with ``n_chars`` brought up to date.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import bpe, line_quality, mixing, ngram_join, secret_scan
from fleetlens.llm.common import tuned, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(kind))
    return changed.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_quality.without_lines(line_quality.judge(docs).where("kept")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return ngram_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settings = secret_scan.Settings()
    ratios = secret_scan.train(secret_scan.labelled_samples(docs, settings), settings)
    return _counted(secret_scan.masked(secret_scan.scan(docs, ratios, settings)), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed(docs), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern)
    return coded.select(
        "doc_id",
        "source",
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("tokens", tokens),
]

# Neither hashed permutations nor BPE can be written in SQL; tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
