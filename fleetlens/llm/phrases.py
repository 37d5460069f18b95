"""Mine phrases from a prefix-free parse of the corpus.

Texts become streams of words with a mark between pieces. A window of ``OVERLAP`` tokens
whose hash is divisible by ``TRIGGER`` starts a new chunk, and a chunk reaches to the end
of the next one's first window: where chunks are cut depends on their content alone, so
copies and shared passages give the same chunks. The distinct chunks with their number of
parses are the dictionary, and n-grams are counted inside it, weighted. An n-gram of at
most ``OVERLAP + 1`` words belongs to the chunk in whose own part (all but the overlap
with the next chunk) it starts, so each occurrence is counted once.

Counting takes three passes over the dictionary: words, pairs of frequent words, longer
n-grams all of whose pairs are frequent. A phrase is never more frequent than its parts,
so this leaves nothing out. Which words and pairs are frequent reaches the tasks as bit
maps of a fixed size (``BITS``); a false positive costs time, not correctness, because the
counts themselves decide. All sums are 64-bit, scores are computed on decimals.

A null or empty text has no words, a null language is ``und``. Repeated rows count as
often as they occur. Long texts are cut like others; without a trigger a chunk ends after
``LONGEST`` tokens. Extra columns are ignored, whatever their names. An empty table gives
no rows. Equal scores are ordered by count, then by the bytes of the phrase.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import written

# Between pieces; it is itself one of the characters that cut pieces, so never a word.
MARK = "."
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]+"
BLANKS = r"[\x20\x09]+"

TRIGGER = 32
LONGEST = 1024
# Bits of the maps of frequent words and pairs: 8 MB each, whatever the corpus.
BITS = 1 << 26
# A task gathers chunks up to so many bytes before it counts them.
GATHER_BYTES = 8 << 20

COUNTED = "lang string, n_words int, phrase string, times long"


@dataclass(frozen=True)
class Settings:
    min_count: int = 100
    longest: int = 5
    top: int = 2000


def tokens_of(texts: pa.Array) -> pa.Array:
    """Lower-cased words and marks of each text, joined by single blanks."""
    low = pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))
    marked = pc.replace_substring_regex(low, PIECE_ENDS, f" {MARK} ")
    return pc.utf8_trim(pc.replace_substring_regex(marked, BLANKS, " "), " ")


def hashed(words: list[str]) -> np.ndarray:
    """The engine's 64-bit hash of each string."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), dtype=np.uint64, count=len(words))


def chunk_starts(codes: np.ndarray, hashes: np.ndarray, doc_starts: np.ndarray, doc_ends: np.ndarray, overlap: int) -> np.ndarray:
    """Where chunks begin: at each document, at each trigger, and within long stretches."""
    n = len(codes)
    starts = [doc_starts]
    if n >= overlap:
        own = hashes[codes]
        window = np.zeros(n - overlap + 1, dtype=np.uint64)
        for i in range(overlap):
            window = window * np.uint64(0x9E3779B97F4A7C15) + own[i : n - overlap + 1 + i]
        window ^= window >> np.uint64(29)
        hits = np.flatnonzero((window * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(TRIGGER) == 0)
        # A window must not reach into the next document.
        starts.append(hits[hits + overlap <= doc_ends[np.searchsorted(doc_starts, hits, "right") - 1]])
    cuts = np.unique(np.concatenate(starts))
    gaps = np.diff(np.append(cuts, n))
    more = (gaps - 1) // LONGEST
    if more.any():
        base, times = np.repeat(cuts, more), np.repeat(np.cumsum(more) - more, more)
        forced = base + (np.arange(len(base)) - times + 1) * LONGEST
        room = doc_ends[np.searchsorted(doc_starts, forced, "right") - 1] - forced
        cuts = np.unique(np.concatenate([cuts, forced[room >= overlap]]))
    return cuts


def parser(overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, text) batches to (lang, tail, chunk) batches; ``tail`` marks a document's last chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = tokens_of(batch.column("text"))
            full = pc.not_equal(lines, "")
            lines, langs = lines.filter(full), batch.column("lang").filter(full)
            if not len(lines):
                continue
            lists = pc.split_pattern(lines, " ")
            flat = lists.flatten()
            ends = np.asarray(lists.offsets)[1:] - np.asarray(lists.offsets)[0]
            doc_starts = np.concatenate([[0], ends[:-1]])
            coded = flat.dictionary_encode()
            cuts = chunk_starts(
                np.asarray(coded.indices), hashed(coded.dictionary.to_pylist()), doc_starts, ends, overlap
            )
            of_doc = np.searchsorted(doc_starts, cuts, "right") - 1
            tail = np.append(of_doc[1:] != of_doc[:-1], True)
            stops = np.where(tail, ends[of_doc], np.append(cuts[1:], 0) + overlap)
            data = " ".join(lines.to_pylist()).encode()
            behind = np.cumsum(np.asarray(pc.binary_length(flat)) + 1)
            first, last = behind[cuts] - np.asarray(pc.binary_length(flat))[cuts] - 1, behind[stops - 1] - 1
            chunks = [data[i:j] for i, j in zip(first.tolist(), last.tolist())]
            yield pa.record_batch(
                [langs.take(pa.array(of_doc)), pa.array(tail), pa.array(chunks, pa.binary()).cast(pa.string())],
                names=["lang", "tail", "chunk"],
            )

    return run


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct key one place where it stands and its weight, and every place's number of the key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.zeros(0, bool)
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    firsts = np.flatnonzero(new)
    return order[firsts], np.add.reduceat(weights[order], firsts) if len(firsts) else weights[:0], number


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = hashes % np.uint64(BITS)
    return (bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def count_in(lang: str, chunks: pa.Array, tail: np.ndarray, times: np.ndarray, sizes: range, overlap: int, maps: list[np.ndarray]):
    """(size, phrases, weights) of the n-grams of ``sizes`` words in chunks of one language."""
    lists = pc.split_pattern(chunks, " ")
    offsets = np.asarray(lists.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    coded = lists.flatten().dictionary_encode()
    codes, words = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    lengths = np.diff(offsets)
    left = np.repeat(offsets[1:], lengths) - np.arange(len(codes))
    weights = np.where(left > np.repeat(np.where(tail, 0, overlap), lengths), np.repeat(times, lengths), 0)
    names = words.to_pylist()
    usable = np.array([w != MARK for w in names])
    if maps:
        usable &= in_map(maps[0], hashed([f"{lang} {w}" for w in names]))
    fits = usable[codes]

    def phrases(places: np.ndarray, size: int) -> pa.Array:
        parts = [words.take(pa.array(codes[places + i])) for i in range(size)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", words.type)) if size > 1 else parts[0]

    if 1 in sizes:
        at = np.flatnonzero(fits & (weights > 0))
        places, sums, _ = summed(codes[at], weights[at])
        yield 1, phrases(at[places], 1), sums
    if sizes[-1] < 2:
        return
    # ids: for each place the number of the n-gram that starts there, -1 where none is of use
    at = np.flatnonzero(fits[:-1] & fits[1:] & (left[:-1] > 1))
    places, sums, number = summed(codes[at] * len(names) + codes[at + 1], weights[at])
    if 2 in sizes:
        yield 2, phrases(at[places], 2).filter(pa.array(sums > 0)), sums[sums > 0]
    if sizes[-1] < 3:
        return
    frequent = in_map(maps[1], hashed([f"{lang} {p}" for p in phrases(at[places], 2).to_pylist()]))
    ids = np.full(len(codes), -1, dtype=np.int64)
    ids[at] = np.where(frequent[number], number, -1) if len(at) else number
    for size in range(3, sizes[-1] + 1):
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0) & (left[:-1] >= size))
        places, sums, number = summed(ids[at] * (ids.max(initial=0) + 1) + ids[at + 1], weights[at])
        if size in sizes:
            yield size, phrases(at[places], size).filter(pa.array(sums > 0)), sums[sums > 0]
        ids = np.full(len(codes), -1, dtype=np.int64)
        ids[at] = number


def counter(sizes: range, overlap: int, maps) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Dictionary batches to partial counts; ``maps`` is a broadcast list of bit maps."""

    def count(gathered: list[pa.RecordBatch], bits: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(gathered).combine_chunks()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        of = np.asarray(langs.indices)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            own = table.filter(pa.array(of == k)).combine_chunks()
            chunks = own.column("chunk").combine_chunks().cast(pa.large_string())
            tail = np.asarray(own.column("tail").combine_chunks().cast(pa.int8())) == 1
            times = np.asarray(own.column("times").combine_chunks())
            for size, found, sums in count_in(lang, chunks, tail, times, sizes, overlap, bits):
                if len(found):
                    yield pa.record_batch(
                        [
                            pa.array([lang] * len(found), pa.string()),
                            pa.array(np.full(len(found), size, dtype=np.int32)),
                            found.cast(pa.string()),
                            pa.array(sums.astype(np.int64)),
                        ],
                        names=["lang", "n_words", "phrase", "times"],
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(b, dtype=np.uint64) for b in maps.value]
        gathered, held = [], 0
        for batch in batches:
            gathered.append(batch)
            held += batch.column("chunk").nbytes
            if held >= GATHER_BYTES:
                yield from count(gathered, bits)
                gathered, held = [], 0
        if gathered:
            yield from count(gathered, bits)

    return run


def parse(docs: DataFrame, settings: Settings, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: (lang, tail, chunk) and how often the parse has it (``times``)."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")
    ).where("text <> ''")
    chunks = rows.mapInArrow(parser(settings.longest - 1), "lang string, tail boolean, chunk string")
    return chunks.groupBy("lang", "tail", "chunk").agg(F.count("*").alias("times"))


def counts(dictionary: DataFrame, sizes: range, settings: Settings, maps: list[bytes]) -> DataFrame:
    """How often n-grams of ``sizes`` words occur, as far as the maps let them through."""
    shared = dictionary.sparkSession.sparkContext.broadcast(maps)
    partial = dictionary.mapInArrow(counter(sizes, settings.longest - 1, shared), COUNTED)
    return partial.groupBy("lang", "n_words", "phrase").agg(F.sum("times").alias("times"))


def bit_map(frequent: DataFrame) -> bytes:
    """A map of ``BITS`` bits with one for each (lang, phrase): at most a 64th as many rows are collected."""
    slot = F.pmod(F.xxhash64(F.concat_ws(" ", "lang", "phrase")), F.lit(BITS))
    # pmod of the signed value equals the unsigned remainder, because BITS is a power of two.
    by_word = (
        frequent.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 AS INT))")).alias("bits"))
    )
    bits = np.zeros(BITS // 64, dtype=np.int64)
    found = by_word.toArrow()
    bits[np.asarray(found.column("word").combine_chunks())] = np.asarray(found.column("bits").combine_chunks())
    return bits.tobytes()


def exact_score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (l r)) of columns whose products may pass 64 bits."""
    over, under = (f"cast({x} AS DECIMAL(17,0)) * cast({y} AS DECIMAL(17,0))" for x, y in ((a, n), (left, right)))
    return F.expr(f"(cast(1000 AS DECIMAL(4,0)) * ({over})) div ({under})")


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the cut that scores lowest: its parts' counts, and the score."""
    known = frequent.select("lang", "phrase", F.col("times").alias("known"))
    words = F.split("phrase", " ")
    cuts = (
        frequent.where("n_words > 1")
        .join(totals, "lang")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
        .withColumns(
            {
                "head": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
                "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("n_words") - F.col("k")), " "),
            }
        )
        .join(known.withColumnsRenamed({"phrase": "head", "known": "l"}), ["lang", "head"])
        .join(known.withColumnsRenamed({"phrase": "rest", "known": "r"}), ["lang", "rest"])
        .withColumn("score", exact_score("times", "n", "l", "r"))
    )
    return (
        cuts.groupBy("lang", "phrase", "n_words", F.col("times").alias("a"), "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "n_words", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def without_parts(candidates: DataFrame) -> DataFrame:
    """Leave out candidates that occur only within a longer one.

    If a longer candidate is as frequent as its part, so is every phrase between the two:
    looking one word further on either side is enough.
    """
    words = F.split("phrase", " ")
    inner = candidates.where("n_words > 2").select(
        "lang",
        "a",
        F.explode(
            F.array(
                F.array_join(F.slice(words, F.lit(1), F.col("n_words") - 1), " "),
                F.array_join(F.slice(words, F.lit(2), F.col("n_words") - 1), " "),
            )
        ).alias("phrase"),
    )
    return candidates.join(inner, ["lang", "phrase", "a"], "left_anti")


def mine(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    dictionary = written(parse(docs, settings, text, lang), "phrase-chunks")
    words = written(counts(dictionary, range(1, 2), settings, []), "phrase-words")
    often = F.col("times") >= settings.min_count
    maps = [bit_map(words.where(often))]
    pairs = written(counts(dictionary, range(2, 3), settings, maps).where(often), "phrase-pairs")
    frequent = words.where(often).unionByName(pairs)
    if settings.longest > 2:
        maps.append(bit_map(pairs))
        longer = written(counts(dictionary, range(3, settings.longest + 1), settings, maps).where(often), "phrase-longer")
        frequent = frequent.unionByName(longer)
    totals = words.groupBy("lang").agg(F.sum("times").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        without_parts(written(scored(frequent, totals), "phrase-scores"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= settings.top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
