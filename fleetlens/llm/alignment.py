"""Align the tokens of two tokenizers by the bytes that they cover.

Both tokenizers see the same bytes, so a text's tokens are two rising lists of byte ends.
Merging the lists gives everything: a token of A and one of B overlap in exactly one stretch
between neighbouring ends, and the ends that both lists hold cut the text into groups.

The merge of a batch of texts, laid end to end, is divided along its merge path: on every
``PIECE``-th diagonal a binary search finds how many ends of A and of B come before it, so
the pieces between diagonals cost the same and need nothing of each other, however long one
text is. Every piece emits its overlaps. Where equal ends of A and B fall on both sides of
a diagonal, the later piece leaves out the overlap that the earlier one has emitted and
closes the group that is open across the border.

Counts over the corpus: texts are gathered into blocks of about ``BLOCK_LINKS`` overlaps. A
block names its distinct id pairs once, with the number of documents that hold each; only
these rows are summed, and only they are joined with the sums, so a pair that every document
holds is one row a block. The documents keep the numbers of their pairs within the block.

Null, empty and not byte-preserved texts have no tokens: zeros and an empty digest. Repeated
rows are documents of their own. Rows keep their order of columns; input columns are not
looked at but for the text and those to keep. An empty table gives no rows. A text longer
than a block is a block of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fleetlens.llm.common import written

PIECE = 1 << 16
BLOCK_LINKS = 3_000_000

# The pre-splitting pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that every Unicode version classes alike; other texts take the slower library.
SETTLED = re.compile("[^\t\n\r\x20-\x7e¡-ɏ‐-‧]")


class Pair:
    """The two tokenizers, their tokens' bytes, and A's ids as text."""

    def __init__(self, file_a: str, file_b: str):
        self.slow = Tokenizer.from_file(file_a)
        self.slow.encode_special_tokens = True
        with open(file_a, encoding="utf-8") as source:
            model = json.load(source)["model"]
        self.bytes_a = byte_level(self.slow)
        ranks = {self.bytes_a[i]: i for i in model["vocab"].values()}
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        # Ids rise in the order of the merges, which is what the quick encoder takes for granted.
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        made = [model["vocab"][m] for m in merges]
        if made != sorted(made):
            self.fast = None
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.size_a, self.size_b = (np.array([len(t) for t in own]) for own in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.inner, self.last_a, self.last_b = (
            np.array([f"{i}{end}" for i in range(most)], dtype=object) for end in (",", "|", ";")
        )

    def encode_a(self, text: str) -> list[int]:
        if self.fast and not SETTLED.search(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and B; none where the bytes of either are not those of blank and text."""
        if not text:
            return [], []
        a, b = self.encode_a(" " + text), self.b.encode(text)
        whole = (" " + text).encode()
        for ids, own in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(map(own.__getitem__, ids)) != whole:
                return [], []
        return a, b


def byte_level(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each id: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    back = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}
    return [
        bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token in map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))
    ]


@functools.lru_cache(maxsize=2)
def pair_of(file_a: str, file_b: str) -> Pair:
    return Pair(file_a, file_b)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and ``b`` come first in the merge at each piece's start, and at its end; ``a`` first on ties."""
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low, d - low
        mid = (low + high)[open_] // 2
        more = a[mid] <= b[d[open_] - 1 - mid]
        low[open_] = np.where(more, mid + 1, low[open_])
        high[open_] = np.where(more, high[open_], mid)


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Overlaps (numbers in a, in b) and shared ends (numbers in a, in b) of one piece of the merge."""
    own_a, own_b = a[i0:i1], b[j0:j1]
    behind = np.searchsorted(own_b, own_a)
    at = np.searchsorted(own_a, own_b)
    shared = np.zeros(len(own_b), dtype=bool)
    inside = at < len(own_a)
    shared[inside] = own_a[at[inside]] == own_b[inside]
    ends_a = i0 + at[shared]
    # The border: A's equal end is the last one of the piece before, which has emitted the overlap.
    if i0 and len(own_b) and a[i0 - 1] == own_b[0]:
        shared[0], ends_a = True, np.append(i0 - 1, ends_a)
    alone = ~shared
    links_a = np.concatenate([np.arange(i0, i1), i0 + at[alone]])
    links_b = np.concatenate([j0 + behind, j0 + np.flatnonzero(alone)])
    return links_a, links_b, ends_a, j0 + np.flatnonzero(shared)


def merged(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """All overlaps and shared ends of two rising lists of ends with the same last end."""
    i, j = diagonals(a, b, piece)
    parts = [merge_piece(a, b, i[k], i[k + 1], j[k], j[k + 1]) for k in range(len(i) - 1)]
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts))


def aligned(texts: list[str | None], pair: Pair, piece: int = PIECE) -> dict[str, np.ndarray | list[str]]:
    """Per text ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and the digest; per overlap ``doc`` and ``key`` (id pair)."""
    ids = [pair.encode(t) for t in texts]
    n_a, n_b = (np.array([len(x[k]) for x in ids], dtype=np.int64) for k in (0, 1))
    a, b = (np.concatenate([np.zeros(0, np.int64), *(np.asarray(x[k], np.int64) for x in ids)]) for k in (0, 1))
    links_a, links_b, ends_a, ends_b = merged(np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b]), piece)
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    # Groups laid out in order: A's ids of the group, then B's, each with the sign that follows it.
    group_a, group_b = (np.searchsorted(ends, np.arange(n)) for ends, n in ((ends_a, len(a)), (ends_b, len(b))))
    signs = np.empty(len(a) + len(b), dtype=object)
    before_b, upto_a = np.append(0, ends_b + 1), ends_a + 1
    is_end_a, is_end_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    is_end_a[ends_a], is_end_b[ends_b] = True, True
    signs[np.arange(len(a)) + before_b[group_a]] = np.where(is_end_a, pair.last_a[a], pair.inner[a])
    signs[np.arange(len(b)) + upto_a[group_b]] = np.where(is_end_b, pair.last_b[b], pair.inner[b])
    stops = np.cumsum(n_a + n_b)
    digests = []
    for start, stop in zip((stops - n_a - n_b).tolist(), stops.tolist()):
        shown = "".join(signs[start:stop].tolist())[:-1].encode()
        digests.append(hashlib.sha256(shown).hexdigest() if shown else "")
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.bincount(doc_a[ends_a], minlength=len(texts)),
        "n_links": np.bincount(doc_a[links_a], minlength=len(texts)),
        "groups_sha256": digests,
        "doc": doc_a[links_a],
        "key": a[links_a] << 32 | b[links_b],
    }


def packed(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Rising pair numbers as differences, then their times, byte by byte, compressed."""
    both = np.concatenate([np.diff(numbers, prepend=0), times]).astype("<u4")
    raw = both.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    both = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]


FACTS = ("n_a", "n_b", "n_groups", "n_links")


def blocks(file_a: str, file_b: str, keep: list[str], schema: pa.Schema, size: int) -> Callable:
    """(keep, text) batches to rows of documents, and one row for each block with its pairs."""

    def rows_of(parts: list[tuple[pa.RecordBatch, dict]], block: int) -> Iterator[pa.RecordBatch]:
        n = sum(batch.num_rows for batch, _ in parts)
        first = np.cumsum([0, *(batch.num_rows for batch, _ in parts)])
        doc = np.concatenate([facts["doc"] + first[k] for k, (_, facts) in enumerate(parts)])
        keys, number = np.unique(np.concatenate([facts["key"] for _, facts in parts]), return_inverse=True)
        held, times = np.unique(doc * max(1, len(keys)) + number, return_counts=True)
        of_doc, number = np.divmod(held, max(1, len(keys)))
        cuts = np.searchsorted(of_doc, np.arange(n + 1)).tolist()
        columns = {name: pa.concat_arrays([batch.column(name) for batch, _ in parts]) for name in keep}
        columns |= {name: pa.array(np.concatenate([facts[name] for _, facts in parts])) for name in FACTS}
        columns |= {
            "block": pa.array(np.full(n, block)),
            "groups_sha256": pa.array([d for _, facts in parts for d in facts["groups_sha256"]]),
            "packed": pa.array([packed(number[i:j], times[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary()),
        }
        of_block = {
            "block": pa.array([block]),
            "pairs": pa.array([keys], pa.list_(pa.int64())),
            "docs": pa.array([np.bincount(number, minlength=len(keys))], pa.list_(pa.int64())),
        }
        for own, height in ((columns, n), (of_block, 1)):
            yield pa.record_batch(
                [own[f.name].cast(f.type) if f.name in own else pa.nulls(height, f.type) for f in schema], schema=schema
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, parts, links = pair_of(file_a, file_b), [], 0
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            facts = aligned(batch.column("__text").to_pylist(), pair)
            parts.append((batch, facts))
            links += len(facts["key"])
            if links >= size:
                yield from rows_of(parts, block)
                parts, links, block = [], 0, block + 1
        if parts:
            yield from rows_of(parts, block)

    return run


def with_counts(keep: list[str], schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Documents of a block and its counted pairs to the finished rows."""

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(pairs.column("pair").combine_chunks()))
        count = np.asarray(pairs.column("count").combine_chunks())[order]
        best = np.asarray(pairs.column("best").combine_chunks().cast(pa.int64()))[order]
        sums, hits = [], []
        for data in docs.column("packed").to_pylist():
            number, times = unpacked(data)
            sums.append(int(count[number] @ times))
            hits.append(int(best[number] @ times))
        columns = {"n_best": pa.array(hits, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table([columns[f.name] if f.name in columns else docs.column(f.name) for f in schema], schema=schema)

    return run


def align(docs: DataFrame, file_a: str, file_b: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """Per document its numbers of tokens, groups and overlaps, the digest, and what its id pairs count."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [F.col(c) for c in keep]
    own = docs.select(*kept, F.col(text).alias("__text"))
    facts = [T.StructField(c, T.LongType()) for c in FACTS]
    rows = T.StructType(
        [
            T.StructField("block", T.LongType()),
            *(own.schema[c] for c in keep),
            *facts,
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("packed", T.BinaryType()),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("docs", T.ArrayType(T.LongType())),
        ]
    )
    rows = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows])
    table = written(own.mapInArrow(blocks(file_a, file_b, list(keep), to_arrow_schema(rows), block_links), rows), "aligned")

    named = table.where("pairs IS NOT NULL").select(
        "block", F.explode(F.arrays_zip("pairs", "docs")).alias("x")
    ).select("block", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = written(named.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    of_a = F.shiftright("pair", 32)
    # One row for each id of A: the vocabulary bounds what is broadcast.
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("count").alias("highest"))
    counted = counts.join(F.broadcast(highest), of_a == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )
    needed = named.select(F.col("block").alias("of_block"), "pair").join(counted, "pair")

    out = T.StructType([*(own.schema[c] for c in keep), *facts, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("groups_sha256", T.StringType())])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in out])
    finish = with_counts(list(keep), to_arrow_schema(out))
    return (
        table.where("pairs IS NULL")
        .drop("pairs", "docs")
        .groupBy("block")
        .cogroup(needed.groupBy("of_block"))
        .applyInArrow(finish, out)
    )
