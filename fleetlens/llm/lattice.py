"""All segmentations of words into the pieces of a fixed vocabulary, for many words at once.

The vocabulary is that of a SentencePiece model file: its pieces, of whatever length,
and a piece for each byte, so every word has a segmentation. A word is preceded by a blank,
the vocabulary's mark for the beginning of a word; no piece goes over the border of a word,
so the words of a text are independent and its segmentations those of its words combined.

A batch of words is one byte buffer. Pieces are found by rolling hashes of all substrings of
one length at a time. The forward recursion goes over places within words, all words at once:
the log-probability of a place is the log of the sum over the pieces that end there.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import sentencepiece

SLOT_BITS = 18
# Fixed odd numbers of the hash.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
# Words of a batch, in bytes.
BATCH_BYTES = 400_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[bytes, ...]
    slots: np.ndarray  # hash of the piece in a slot, 0: none
    ids: np.ndarray
    longest: int  # bytes of the longest piece

    @property
    def size(self) -> int:
        return len(self.pieces)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * STEP
    return np.maximum(mixed, np.uint64(1))


def substring_hashes(data: np.ndarray, room: np.ndarray, longest: int):
    """For each length up to ``longest`` the places of the substrings that fit, and their hashes.

    ``room`` is the number of bytes from a place to the end of its word.
    """
    codes = data.astype(np.uint64) + np.uint64(1)
    places = np.arange(len(data))
    rolled = np.zeros(len(data), dtype=np.uint64)
    for length in range(1, longest + 1):
        fits = np.flatnonzero(room[places] >= length)
        if not len(fits):
            return
        places = places[fits]
        rolled = rolled[fits] * FACTOR + codes[places + (length - 1)]
        yield length, places, _mixed(rolled)


def piece_hash(piece: bytes) -> int:
    """The hash of one substring, as :func:`substring_hashes` has it."""
    wrap, rolled = (1 << 64) - 1, 0
    for byte in piece:
        rolled = (rolled * int(FACTOR) + byte + 1) & wrap
    return max(1, ((rolled ^ (rolled >> 29)) * int(STEP)) & wrap)


@functools.lru_cache(maxsize=2)
def vocabulary(model_file: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    listed = [bytes([b]) for b in range(256)]
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            listed.append(piece)
    pieces = tuple(dict.fromkeys(listed))
    slots = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
    ids = np.zeros(1 << SLOT_BITS, dtype=np.int32)
    for i, piece in enumerate(pieces):
        found = piece_hash(piece)
        at = found >> (64 - SLOT_BITS)
        while slots[at]:
            at = (at + 1) % len(slots)
        slots[at], ids[at] = found, i
    return Vocabulary(pieces, slots, ids, max(map(len, pieces)))


def prior(vocab: Vocabulary) -> np.ndarray:
    """Log-probabilities by Zipf's law over the vocabulary's own order; bytes come last."""
    rank = np.arange(vocab.size, dtype=float)
    order = np.where(rank < 256, vocab.size + rank, rank - 256)
    weights = 1.0 / (order + 10.0)
    return np.log(weights / weights.sum())


def lookup(vocab: Vocabulary, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes are pieces, and the ids of these."""
    at = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    which, found = [], []
    held = vocab.slots[at]
    hit = np.flatnonzero(held == hashes)
    which.append(hit)
    found.append(vocab.ids[at[hit]])
    left = np.flatnonzero((held != hashes) & (held != 0))
    while len(left):
        at[left] = (at[left] + 1) % len(vocab.slots)
        held = vocab.slots[at[left]]
        hit = held == hashes[left]
        which.append(left[hit])
        found.append(vocab.ids[at[left[hit]]])
        left = left[~hit & (held != 0)]
    return np.concatenate(which), np.concatenate(found)


class Batch:
    """Words of one batch, longest first, with the pieces that begin at each place."""

    def __init__(self, vocab: Vocabulary, words: list[bytes]) -> None:
        self.vocab = vocab
        sizes = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.data = np.frombuffer(b"".join(b" " + words[i] for i in self.order), dtype=np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        # Nodes: a word of n bytes has n + 1 of them.
        self.nodes = self.starts + np.arange(len(words))
        # pieces[l] are those of length l by the place where they begin, if there are any.
        self.pieces = {}
        room = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.data))
        for length, places, hashes in substring_hashes(self.data, room, vocab.longest):
            which, ids = lookup(vocab, hashes)
            if not len(which):
                continue
            self.pieces[length] = np.full(len(self.data), vocab.size, dtype=np.int32)
            self.pieces[length][places[which]] = ids

    def steps(self):
        """For each place t within words: how many words reach it, and the lengths to look at."""
        reach = np.searchsorted(-self.sizes, -np.arange(1, self.sizes[0] + 1), side="right")
        for t, n in enumerate(reach, start=1):
            yield t, int(n), [l for l in self.pieces if l <= t]

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """Log-probability of every node; ``scores`` is pieces x models, natural logs."""
        table = np.vstack([scores, np.full((1, scores.shape[1]), -np.inf)])
        alpha = np.zeros((len(self.data) + len(self.sizes), scores.shape[1]))
        for t, n, lengths in self.steps():
            begin, node = self.starts[:n] + t, self.nodes[:n] + t
            ways = np.stack([alpha[node - l] + table[self.pieces[l][begin - l]] for l in lengths])
            top = ways.max(0)
            alpha[node] = top + np.log(np.exp(ways - top).sum(0))
        return alpha

    def backward(self, scores: np.ndarray) -> np.ndarray:
        table = np.vstack([scores, np.full((1, scores.shape[1]), -np.inf)])
        beta = np.zeros((len(self.data) + len(self.sizes), scores.shape[1]))
        for t, n, _ in reversed(list(self.steps())):
            # From place t - 1 of the words that reach place t, over every piece that begins there.
            begin, node = self.starts[:n] + t - 1, self.nodes[:n] + t - 1
            room = self.sizes[:n] - (t - 1)
            lengths = [l for l in self.pieces if l <= room[0]]
            ways = np.full((len(lengths), n, scores.shape[1]), -np.inf)
            for i, l in enumerate(lengths):
                fits = int(np.searchsorted(-room, -l, side="right"))
                ways[i, :fits] = beta[node[:fits] + l] + table[self.pieces[l][begin[:fits]]]
            top = ways.max(0)
            beta[node] = top + np.log(np.exp(ways - top).sum(0))
        return beta

    def log_probabilities(self, scores: np.ndarray) -> np.ndarray:
        """Marginal log-probability of each word under each model, in the order given."""
        alpha = self.forward(scores)
        out = np.empty((len(self.sizes), scores.shape[1]))
        out[self.order] = alpha[self.nodes + self.sizes]
        return out

    def expected_counts(self, scores: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, words weighted (one model)."""
        scores = scores.reshape(-1, 1)
        alpha, beta = self.forward(scores)[:, 0], self.backward(scores)[:, 0]
        word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        node = np.arange(len(self.data)) + word
        total = beta[self.nodes][word]
        weight = weights[self.order][word]
        counts = np.zeros(self.vocab.size)
        for l, ids in self.pieces.items():
            at = np.flatnonzero(ids < self.vocab.size)
            uses = np.exp(alpha[node[at]] + scores[ids[at], 0] + beta[node[at] + l] - total[at]) * weight[at]
            counts += np.bincount(ids[at], uses, minlength=self.vocab.size)
        return counts


def batches(words: list[bytes]):
    """Ranges of words of about ``BATCH_BYTES`` bytes."""
    first, held = 0, 0
    for i, word in enumerate(words):
        held += len(word) + 1
        if held >= BATCH_BYTES:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(words):
        yield first, len(words)


def gathered(rows):
    """Word and weight lists of about ``BATCH_BYTES`` bytes from shorter ones."""
    words, weights, held = [], [], 0
    for more, n in rows:
        for a, b in batches(more):
            words += more[a:b]
            weights += n[a:b]
            held += sum(map(len, more[a:b])) + b - a
            if held >= BATCH_BYTES:
                yield words, weights
                words, weights, held = [], [], 0
    if words:
        yield words, weights


def word_scores(vocab: Vocabulary, words: list[bytes], scores: np.ndarray) -> np.ndarray:
    parts = [Batch(vocab, words[a:b]).log_probabilities(scores) for a, b in batches(words)]
    return np.concatenate(parts) if parts else np.zeros((0, scores.shape[1]))


class Scorer:
    """Word scores with those of words seen before; what is held stays within ``limit`` words."""

    def __init__(self, vocab: Vocabulary, scores: np.ndarray, limit: int = 300_000) -> None:
        self.vocab, self.scores, self.limit = vocab, scores, limit
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.known = np.zeros((0, self.scores.shape[1]))

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.rows]
        if len(self.rows) + len(new) > self.limit:
            self.clear()
            new = list(words)
        self.known = np.concatenate([self.known, word_scores(self.vocab, new, self.scores)])
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """Scores by word of words learnt."""
        return self.known[np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))]


def smoothed(counts: np.ndarray, pseudo: float) -> np.ndarray:
    """Log-probabilities from expected counts."""
    return np.log((counts + pseudo) / (counts.sum() + pseudo * len(counts)))
