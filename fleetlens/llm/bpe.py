"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Encoded texts are kept as bytes: unsigned 32-bit ids, little-endian, one after the other.
That is the form in which token shards are stored, and decoding starts from it.

A null or empty text has no ids and decodes to no bytes. Rows are independent: repeated
rows give repeated results, an empty table an empty one. All input columns stay; one that
has the name of an output column is replaced by the output.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts beyond this many characters are encoded in pieces of about this length.
PIECE_CHARS = 65_536

# Between an ASCII letter or digit and a single blank with another one behind it, a match of
# the pre-splitting pattern always ends: a blank is only ever the first character of a match
# that holds something else, so neither side's matches depend on the other side.
SAFE = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: lines of a base64 token and its rank."""
    with open(rank_file, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text where no match can cross; a text without such places stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str | None, enc: tiktoken.Encoding, size: int = PIECE_CHARS) -> bytes:
    if not text:
        return b""
    return b"".join(
        np.asarray(enc.encode_ordinary(piece), dtype="<u4").tobytes() for piece in pieces(text, size)
    )


def token_ids(text: Column, rank_file: str, pattern: str, size: int = PIECE_CHARS) -> Column:
    """The ids of a text as little-endian bytes."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for texts in batches:
            yield pd.Series([encode_text(t, enc, size) for t in texts], dtype=object)

    return run(text)


def token_bytes(ids: Column, rank_file: str, pattern: str) -> Column:
    """The bytes that ids stand for; they need not be valid UTF-8."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for packed in batches:
            yield pd.Series(
                [enc.decode_bytes(np.frombuffer(b or b"", dtype="<u4").tolist()) for b in packed], dtype=object
            )

    return run(ids)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", size: int = PIECE_CHARS) -> DataFrame:
    """Add ``token_ids`` (packed) and ``n_tokens``."""
    packed = docs.withColumn("token_ids", token_ids(F.col(text), rank_file, pattern, size))
    return packed.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def decode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Add ``decoded``, the bytes of ``token_ids``."""
    return docs.withColumn("decoded", token_bytes(F.col("token_ids"), rank_file, pattern))


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the decoded bytes."""
    return docs.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
