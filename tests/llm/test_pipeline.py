"""The corpus pipeline stage by stage against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fleetlens.llm import bpe


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "ka me lo ti su ra".split() for b in "na vi do pe".split()]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))

    rows = [(i, prose(80), "en", "s1" if i % 3 else None, 0) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s2", 0) for i in range(5)]  # exact copies
    rows += [(200, rows[0][1] + " one more", "en", "s2", 0), (300, None, None, None, None), (301, "too short", "en", "s1", 9)]
    rows += [(400, prose(60) + " password = abcdefgh12 " + prose(60), "en", "s1", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, docs, tmp_path):
    out, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, "")
        result.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = docs.collect()
        assert name == "tokens" or docs.columns == columns
    ids = {name: {r.doc_id for r in rows} for name, rows in out.items()}
    everything = set(range(40)) | set(range(100, 105)) | {200, 400}
    assert ids["quality"] == everything
    assert ids["near_duplicates"] == set(range(40)) | {400}
    assert ids["secrets"] == ids["near_duplicates"]
    text = next(r.text for r in out["secrets"] if r.doc_id == 400)
    assert " <secret> " in text and "abcdefgh12" not in text
    before = {r.doc_id: Counter(r.text.split()) for r in out["secrets"]}
    assert all(not Counter(r.text.split()) - before[r.doc_id] for r in out["mix"])
    assert all(r.n_chars == len(r.text) for r in out["mix"])
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    expected = Counter(hashlib.sha256(np.array(enc.encode_ordinary(r.text), "<u4").tobytes()).hexdigest() for r in out["mix"])
    assert Counter(r.ids_sha256 for r in out["tokens"]) == expected
    assert Counter(r.decoded_sha256 for r in out["tokens"]) == Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in out["mix"])


def test_mix_joins_slots_by_merge(spark, docs):
    """The drawn slots of all sources would not fit the driver as a broadcast."""
    plan = corpus_pipeline.mix(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"(\w+Join)\b[^\n]*drawn_block", plan)) == {"SortMergeJoin"}


def test_empty_table(spark, docs):
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
