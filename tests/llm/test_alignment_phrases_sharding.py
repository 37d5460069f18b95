"""Alignment, phrases and sharding against brute force, with nulls, empties, ties and repeats."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlens.llm import alignment, phrases, queries, sharding

JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string"

# 11: alignment


def plain_tokens(text, a, b):
    """(id, bytes) of both tokenizers, without any of the operator's code."""
    ids = a.encode(" " + text, add_special_tokens=False).ids
    spans, tokens = [], (" " + text).encode()
    del spans
    shown = []
    for i in ids:
        size = len(a.id_to_token(i))
        shown.append((i, tokens[:size]))
        tokens = tokens[size:]
    assert tokens == b""
    pieces = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        pieces.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    return shown, pieces


def plain_alignment(texts):
    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    rows, count = [], Counter()
    for text in texts:
        if not text:
            rows.append(None)
            continue
        own, other = plain_tokens(text, a, b)
        if b"".join(x for _, x in other) != (" " + text).encode():
            rows.append(None)
            continue
        spans = []
        for tokens in (own, other):
            end, out = 0, []
            for i, raw in tokens:
                out.append((i, end, end + len(raw)))
                end += len(raw)
            spans.append(out)
        links = [(i, j) for i, s, e in spans[0] for j, t, u in spans[1] if s < u and t < e]
        shared = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
        groups, left = [], [list(x) for x in spans]
        for end in sorted(shared):
            part = []
            for k in (0, 1):
                part.append([i for i, _, e in left[k] if e <= end])
                left[k] = [x for x in left[k] if x[2] > end]
            groups.append("|".join(",".join(map(str, ids)) for ids in part))
        rows.append((len(own), len(other), groups, links))
        count.update(set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        out.append(
            (
                n_a,
                n_b,
                len(groups),
                len(links),
                sum(count[x] == best[x[0]] for x in links),
                sum(count[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest(),
            )
        )
    return out


ODD = [
    None,
    "",
    " ",
    "a",
    "<|endoftext|> and <s> </s> <unk> <0x41>",
    "▁under line",
    "Straße übermäßig, naïve façade; año nuevo!",
    "日本語のテキスト 😀 ∑ ͸ x y z",
    "two  blanks\n\nand lines\r\n\ttab \x00 end ",
    "the same text here",
    "the same text here",
    "ﬁ ligature and é accents Å",
]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    signs = ["the ", "tion", "é", "ß", " ", "\n", "日", "1", "2024", "!", "'s", "Ab", "’", "́", "x"]
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 120))) for _ in range(60)]


@pytest.mark.parametrize("block_links", [1, 500, alignment.BLOCK_LINKS])
def test_alignment(spark, odd_texts, block_links):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(odd_texts)], DOCS)
    docs = docs.withColumns({"block": F.lit("clash"), "n_a": F.lit(None), "pairs": F.lit(1)})
    out = alignment.align(docs, JSON, PIECES, block_links=block_links)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in out.collect()}
    want = plain_alignment(odd_texts)
    assert len(got) == len(odd_texts)
    for i, text in enumerate(odd_texts):
        assert got[i] == want[i], repr(text)


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert alignment.align(docs, JSON, PIECES).collect() == []
    none = spark.createDataFrame([(1, None, "en"), (None, "", "en")], DOCS)
    assert sorted(r.n_links for r in alignment.align(none, JSON, PIECES).collect()) == [0, 0]


def test_pieces_of_the_merge_are_even_and_lose_nothing():
    rng = np.random.default_rng(3)
    for _ in range(200):
        last = int(rng.integers(1, 80))
        a, b = (np.unique(np.append(rng.integers(1, last + 1, rng.integers(0, 60)), last)) for _ in range(2))
        i, j = alignment.diagonals(a, b, 4)
        assert set(np.diff(i + j)[:-1]) <= {4}
        la, lb, ea, eb = alignment.merged(a, b, 4)
        sa, sb = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = {(x, y) for x in range(len(a)) for y in range(len(b)) if sa[x] < b[y] and sb[y] < a[x]}
        assert sorted(zip(la.tolist(), lb.tolist())) == sorted(want)
        shared = np.intersect1d(a, b)
        assert a[ea].tolist() == shared.tolist() == b[eb].tolist()


def test_long_text_is_one_document(spark):
    text = "some words and numbers 12345 " * 60_000
    docs = spark.createDataFrame([(1, text, "en"), (2, text[:600], "en")], DOCS)
    rows = {r.doc_id: r for r in alignment.align(docs, JSON, PIECES, block_links=1000).collect()}
    assert rows[1].n_links > 100 * rows[2].n_links > 0


def test_fast_and_slow_encoder_agree():
    pair = alignment.pair_of(JSON, PIECES)
    rng = random.Random(8)
    signs = [chr(c) for c in [*range(0x20, 0x7F), 9, 10, 13, *range(0xA1, 0x250), *range(0x2010, 0x2028)]]
    for _ in range(400):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 90)))
        assert pair.fast.encode_ordinary(text) == pair.slow.encode(text, add_special_tokens=False).ids
    assert alignment.SPLIT == public_tokenizers.PATTERN


# 12: phrases


def plain_phrases(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\v\f\r]", low):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            found[lang, p] = (a, min(cuts))
    out = []
    for lang in totals:
        kept = []
        for (own, p), (a, (score, _, left, right)) in found.items():
            if own != lang:
                continue
            inside = any(
                own == other and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for (other, q), (b, _) in found.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("overlap_trigger", [1, 3, 32])
def test_phrases(spark, monkeypatch, overlap_trigger):
    rng = random.Random(overlap_trigger)
    words = ["a", "b", "C", "d", "Ä", "#", "e f"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n"]) for _ in range(rng.randrange(90))) for _ in range(40)]
    texts += [None, "", " \t", "...", "a a a a a a a a", "x " * 3000, "same words in a row here", "same words in a row here", "A" * 5000]
    rows = [(t, rng.choice(["en", "de", None])) for t in texts] + [("x " * 3000, "en")] * 2
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], DOCS)
    docs = docs.withColumns({"phrase": F.lit("clash"), "times": F.lit(0), "chunk": F.lit(None)})
    monkeypatch.setattr(phrases, "TRIGGER", overlap_trigger)
    got = sorted(map(tuple, phrases.mine(docs, phrases.Settings(min_count=4, top=25)).collect()))
    # Workers have the module as it is; the parse in this process has the other trigger.
    assert got == plain_phrases(rows, 4, 5, 25)
    batch = docs.select("lang", "text").toArrow().to_batches()
    for part in phrases.parser(4)(iter(batch)):
        assert part.num_rows


@pytest.mark.parametrize("trigger", [1, 2, 7, 10**9])
def test_every_ngram_starts_in_one_chunk(monkeypatch, trigger):
    import pyarrow as pa

    monkeypatch.setattr(phrases, "TRIGGER", trigger)
    monkeypatch.setattr(phrases, "LONGEST", 16)
    rng = random.Random(trigger)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(n)) for n in (1, 2, 4, 5, 6, 16, 17, 20, 21, 36, 200)]
    batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    whole, chunked = Counter(), Counter()
    for text in texts:
        words = text.split()
        whole.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    for part in phrases.parser(4)(iter([batch])):
        for tail, chunk in zip(part.column("tail").to_pylist(), part.column("chunk").to_pylist()):
            words = chunk.split()
            own = len(words) if tail else len(words) - 4
            assert own > 0
            chunked.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(own) if i + k <= len(words))
    assert whole == chunked


def test_phrases_of_nothing(spark):
    assert phrases.mine(spark.createDataFrame([], DOCS)).collect() == []


def test_scores_pass_64_bits(spark):
    row = spark.createDataFrame([(10**12, 10**13, 10**12, 3 * 10**11)], "times long, n long, l long, r long")
    assert row.select(phrases.exact_score("times", "n", "l", "r").alias("s")).first().s == 10**28 // (3 * 10**23)


def test_hash_is_the_engines(spark):
    words = ["en a", "", "Ä 日本", "x" * 100]
    df = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h"))
    assert [r.h % 2**64 for r in df.collect()] == phrases.hashed(words).tolist()
    assert xxhash.xxh64_intdigest("", 42) == int(phrases.hashed([""])[0])


# 13: sharding


def law_holds(rows, shards):
    by_shard = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        by_shard[r.shard].append(r.slot)
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))


def places(spark, texts, shards=16):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
    rows = sharding.report(docs, shards).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    law_holds(rows, shards)
    shards_of = defaultdict(Counter)
    for r in rows:
        if texts[r.doc_id] is not None:
            shards_of[texts[r.doc_id]][r.shard] += 1
    return shards_of, sorted((r.doc_id, r.shard, r.slot) for r in rows)


def test_small_groups_stay_whole(spark):
    texts = [f"text {i // (1 + i % 3)}" for i in range(400)] + [None, None, "", "", "ä", "x" * 100_000]
    shards_of, first = places(spark, texts)
    assert all(len(c) == 1 for c in shards_of.values())
    assert places(spark, texts)[1] == first


def test_only_pairs(spark):
    """All documents are linked, so that room comes from exchange alone."""
    shards_of, _ = places(spark, [f"t{i // 2}" for i in range(640)])
    assert sum(len(c) > 1 for c in shards_of.values()) <= 0.05 * len(shards_of)


def test_hot_group_fills_whole_shards(spark):
    texts = ["hot"] * 300 + [f"pair {i // 2}" for i in range(200)] + [f"single {i}" for i in range(400)]
    shards_of, _ = places(spark, texts)
    assert len(shards_of["hot"]) <= -(-300 // (900 // 16)) + 1
    assert sum(len(c) > 1 for t, c in shards_of.items() if t != "hot") <= 5


def test_few_and_no_documents(spark):
    places(spark, ["a"])
    places(spark, ["a", "a", None])
    assert sharding.report(spark.createDataFrame([], DOCS)).collect() == []


def test_repeated_rows_null_ids_and_clashing_columns(spark, tmp_path):
    rows = [(None, "a", "en")] * 5 + [(7, "b", "en")] * 4 + [(None, None, None)] * 3
    docs = spark.createDataFrame(rows, DOCS).withColumns({"slot": F.lit("clash"), "size": F.lit("x"), "end": F.lit(1)})
    law_holds(sharding.report(docs, 4).collect(), 4)
    sharding.write_shards(docs, f"{tmp_path}/shards", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 12 and {"text", "lang", "end", "slot", "shard"} <= set(back.columns)


# the registered queries


def test_registered_queries(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_alignment(spark, sf_dir).collect()
    ids = sorted(docs)
    sample = [docs[i].text for i in ids]
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in rows}
    short = [i for i in ids if len(docs[i].text or "") < 1500]
    del sample
    assert len(got) == len(docs) and short
    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    for i in short:
        own, other = plain_tokens(docs[i].text, a, b) if docs[i].text else ([], [])
        assert got[i][:2] == (len(own), len(other))
    placed = queries.op13_sharding(spark, sf_dir)
    assert placed.dtypes == [
        ("doc_id", "bigint"),
        ("size", "bigint"),
        ("text_crc32", "bigint"),
        ("law", "string"),
        ("shard", "int"),
        ("slot", "bigint"),
        ("grown_shard", "int"),
    ]
    law_holds(placed.collect(), 16)
