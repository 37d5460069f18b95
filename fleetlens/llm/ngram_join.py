"""Exact Jaccard join on word shingles with token-combination prefixes.

Texts become sets of hashed five-word shingles (tokens). Tokens have one global order: the
rare ones, then the frequent ones, each by hash. The frequent class is the at most
``frequent_tokens`` tokens in the most sets, if they are in more than ``frequent_sets``.

Two sets that link share their first common token within their prefixes (length n - ceil(75 %
of n) + 1). If the prefix of a set is all rare, only its tokens are indexed, one by one. Else
the prefix is extended by c tokens; linked sets then share c + 1 tokens of their extended
prefixes: a rare one, which is indexed alone, or only frequent ones. Frequent tokens fall into
c classes by hash, so two of the shared ones are in one class: combinations of two tokens of
a class are indexed. c is about an eighth to a quarter of the size of the set, the same for
all sets of a band of sizes, which makes the combinations about as many as the tokens. All
candidates that can link are among the sets that meet under one key.

Candidates carry a sketch, the parities of hash buckets of their tokens: 1,024, or for larger
sets as many as the next power of two of their size, about a fiftieth of the text. Buckets that
differ bound the tokens that differ from below, which rules out most candidates exactly. Of two
sketches the longer is folded to the length of the other.

Dense groups are not expanded into pairs. Each set is first verified against two of its
candidate partners, chosen by a hash that all members of a group agree on; the links make
components. After that only candidates from different components are left to verify, again
by partners first, and frequent tokens whose sets are all in one component need no
combinations.

Sets are compared by their whole texts, gathered by pair. Only sets that have a candidate need
their text and sketch; a bit map of their rows keeps most other texts from being shuffled, and
the join by hash decides. Equal sets are one set from the start. Token and set hashes have 64
bits, a set is named by its hash and size.

A text without words (null, empty, blank) has the empty set and links with nothing; one
with fewer than five words is a single token. Repeated rows are rows of their own. Columns
other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import written

FACTOR = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
SKETCH_BITS = 1024
# Bits of the map of rows whose texts are compared: at most 8 MB, whatever the corpus.
MAP_BITS = 1 << 26
# Pairs whose sketches are compared at a time.
SKETCH_PAIRS = 1 << 15
# Bits of one row of Spark's bitmap aggregate.
BUCKET_BITS = 8 * 4096


@dataclass(frozen=True)
class Settings:
    """``group_tokens``: about how many tokens are counted or indexed by one task.

    ``flush_tokens`` and ``flush_pairs``: about how many tokens and pairs a Python worker makes at a time.
    """

    words: int = 5
    percent: int = 75
    frequent_sets: int = 16
    frequent_tokens: int = 250_000
    group_tokens: int = 1_000_000
    flush_tokens: int = 1_000_000
    flush_pairs: int = 250_000
    members: int = 256
    named_rounds: int = 2
    rounds: int = 4

    def overlap(self, n: int) -> int:
        """The least number of common tokens of a set of n with any set that it links with."""
        return -(-self.percent * n // 100)


def band_of(n: int) -> int:
    return n.bit_length() - 1


def classes_of(band: int) -> int:
    """The classes of frequent tokens for sets of 2^band tokens and more.

    One more than these is no more than the overlap that a link between such sets needs.
    """
    return max(1, (1 << band) // 4)


class WordHashes(dict):
    """Hash by word; emptied when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def tokens_of(text: str | None, hashes: WordHashes, settings: Settings) -> np.ndarray:
    """The sorted distinct tokens of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    width = min(n, settings.words)
    rolled = codes[: n - width + 1]
    for i in range(1, width):
        rolled = rolled * FACTOR + codes[i : n - width + 1 + i]
    rolled = rolled + np.uint64(width)
    return distinct((rolled ^ (rolled >> np.uint64(31))) * STEP)


def set_id(tokens: np.ndarray) -> int:
    """The name of a set: a signed 64-bit hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def linked(a: np.ndarray, b: np.ndarray, settings: Settings) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < settings.percent * large:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= settings.percent * (len(a) + len(b) - common)


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """Parities of hash buckets, 64 in a number; the buckets are a power of two, at least the tokens."""
    bits = max(SKETCH_BITS, 1 << max(0, len(tokens) - 1).bit_length())
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def narrow(sketch: np.ndarray) -> np.ndarray:
    """The sketch of the same tokens with ``SKETCH_BITS`` buckets."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, SKETCH_BITS // 64), axis=0)


def shingle_sets(docs: DataFrame, settings: Settings, text: str, key: str) -> DataFrame:
    """(key, row_hash, set_id, n, sketch) for each row, written; set_id is null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [tokens_of(t.as_py(), hashes, settings) for t in batch.column(2)]
            names = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            sketches = pa.array([sketch_of(s) for s in sets], pa.list_(pa.int64()))
            columns = [batch.column(0), batch.column(1), names, sizes, sketches]
            yield pa.record_batch(columns, names=["key", "row_hash", "set_id", "n", "sketch"])

    rows = docs.select(F.col(key).alias("key"), row_hash(key, text), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, row_hash long, set_id long, n long, sketch array<bigint>"
    return written(rows.mapInArrow(run, schema), "shingle-sets")


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text)).alias("row_hash")


class FirstSeen:
    """Whether a task meets a set for the first time, as far as it remembers."""

    def __init__(self, limit: int = 500_000) -> None:
        self.limit, self.names = limit, set()

    def __call__(self, tokens: np.ndarray) -> bool:
        name = set_id(tokens)
        if name in self.names:
            return False
        if len(self.names) >= self.limit:
            self.names.clear()
        self.names.add(name)
        return True


def bits_for(tokens: int, settings: Settings) -> int:
    """So many high bits of a token make groups of about ``group_tokens``."""
    return min(30, max(6, int(tokens // settings.group_tokens).bit_length()))


def by_group(groups: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Columns cut by the (ascending) group, as bytes."""
    edges = np.flatnonzero(np.diff(groups)) + 1
    for first, last in zip([0, *edges], [*edges, len(groups)]):
        if last > first:
            yield int(groups[first]), [c[first:last].tobytes() for c in columns]


def frequent_tokens(docs: DataFrame, tokens: int, settings: Settings, text: str) -> np.ndarray:
    """The frequent class, sorted: the high ``bits + 32`` bits of its tokens."""
    bits = bits_for(tokens, settings)
    high, low = np.uint64(64 - bits), np.uint64(32 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, new, held, size = WordHashes(), FirstSeen(), [], 0
        for batch in batches:
            for t in batch.column(0):
                found = tokens_of(t.as_py(), hashes, settings)
                if new(found):
                    held.append(found)
                    size += len(found)
            if size > settings.flush_tokens:
                yield parts(held)
                held, size = [], 0
        if size:
            yield parts(held)

    def parts(held: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        rows = []
        for many in (False, True):
            some = (n > 1) == many
            cut = by_group(values[some] >> high, (values[some] >> low).astype("<u4"), n[some].astype("<u4"))
            rows += [(g, keys, times if many else None) for g, (keys, times) in cut]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "keys", "times"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, "<u4") for k in rows["keys"]]
        times = [np.ones(len(k), "<u4") if t is None else np.frombuffer(t, "<u4") for k, t in zip(keys, rows["times"])]
        values, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(at, np.concatenate(times))
        some = sums > settings.frequent_sets
        token = (np.int64(rows["part"].iloc[0]) << 32) | values[some].astype(np.int64)
        return pd.DataFrame({"token": token, "sets": sums[some].astype(np.int64)})

    counted = docs.select(text).mapInArrow(count, "part int, keys binary, times binary")
    found = counted.groupBy("part").applyInPandas(add, "token long, sets long")
    top = found.orderBy(F.col("sets").desc(), "token").limit(settings.frequent_tokens).select("token").toPandas()
    return np.sort(top["token"].to_numpy(dtype=np.int64))


def indexed_tokens(tokens: np.ndarray, common: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The rare and the frequent tokens under which a set is indexed."""
    rare, n = tokens[~common], len(tokens)
    prefix = n - settings.overlap(n) + 1
    if len(rare) >= prefix:
        return rare[:prefix], tokens[:0]
    return rare, tokens[common][: prefix + classes_of(band_of(n)) - len(rare)]


def meetings(docs: DataFrame, tokens: int, settings: Settings, text: str) -> DataFrame:
    """Written rows: pairs of sets under a rare token (kind 0: a, b) and the frequent tokens of sets (kind 1: token, set, n)."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, tokens, settings, text))
    bits = bits_for(tokens, settings)
    high, low = np.uint64(64 - bits), np.uint64(32 - bits)
    frequent_parts = 1 << bits

    def is_frequent(values: np.ndarray) -> np.ndarray:
        known, own = frequent.value, (values >> low).astype(np.int64)
        if not len(known):
            return np.zeros(len(own), dtype=bool)
        return known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, new, held, size = WordHashes(), FirstSeen(), [], 0
        for batch in batches:
            for t in batch.column(0):
                found = tokens_of(t.as_py(), hashes, settings)
                if len(found) and new(found):
                    rare, common = indexed_tokens(found, is_frequent(found), settings)
                    held.append((set_id(found), len(found), rare, common))
                    size += len(rare) + len(common)
            if size > settings.flush_tokens:
                yield parts(held)
                held, size = [], 0
        if held:
            yield parts(held)

    def parts(held: list[tuple]) -> pa.RecordBatch:
        rows = []
        for kind, at in ((0, 2), (1, 3)):
            many = [len(h[at]) for h in held]
            values = np.concatenate([h[at] for h in held])
            names = np.repeat(np.array([h[0] for h in held], dtype="<i8"), many)
            sizes = np.repeat(np.array([h[1] for h in held], dtype="<i4"), many)
            # Rare tokens meet by token; the others only pass through, spread by set.
            part = (values >> high).astype(np.int64) if kind == 0 else names % frequent_parts
            order = np.argsort(part, kind="stable")
            cut = by_group(part[order], values[order].astype("<u8"), names[order], sizes[order])
            rows += [(g, kind, *columns) for g, columns in cut]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        names = ["part", "kind", "tokens", "sets", "sizes"]
        columns = list(zip(*rows)) or [()] * 5
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, some in rows.groupby("kind"):
            values = np.concatenate([np.frombuffer(x, "<u8") for x in some["tokens"]])
            names = np.concatenate([np.frombuffer(x, "<i8") for x in some["sets"]])
            sizes = np.concatenate([np.frombuffer(x, "<i4") for x in some["sizes"]])
            if kind == 1:
                out.append(pd.DataFrame({"kind": 1, "a": values.view("<i8"), "b": names, "n": sizes}))
            else:
                a, b = pairs_within(values, names, sizes, names, settings)
                out.append(pd.DataFrame({"kind": 0, "a": a, "b": b, "n": 0}))
        return pd.concat(out)

    indexed = docs.select(text).mapInArrow(index, "part int, kind int, tokens binary, sets binary, sizes binary")
    met = indexed.groupBy("part").applyInPandas(meet, "kind int, a long, b long, n int")
    return written(met, "meetings")


def pairs_within(
    values: np.ndarray,
    names: np.ndarray,
    sizes: np.ndarray,
    groups: np.ndarray,
    settings: Settings,
    known: np.ndarray | None = None,
    sketches: np.ndarray | None = None,
    nearest: bool = False,
) -> np.ndarray:
    """Distinct pairs (a < b) of sets that share a value, of sizes that allow a link and different groups.

    About ``flush_pairs`` pairs are taken at a time, set by set, and made distinct. With ``known`` (ascending names) and their ``sketches``,
    pairs that these rule out are left out. With ``nearest`` one set stands for each group at
    a value, by a hash of both, and of any two groups the pair that differs least is given;
    of the pairs found so far only these are held.
    """
    order = np.lexsort(((names.view(np.uint64) ^ values) * FACTOR, groups, values))
    values, names, groups = values[order], names[order], groups[order]
    new_value = np.ones(len(values), dtype=bool)
    new_value[1:] = values[1:] != values[:-1]
    new_group = new_value.copy()
    new_group[1:] |= groups[1:] != groups[:-1]
    every, firsts, own = np.unique(names, return_index=True, return_inverse=True)
    sizes, group_of, whole = sizes[order][firsts].astype(np.int64), groups[firsts], max(1, len(every))
    fresh = new_group.copy()
    if not nearest:
        fresh[1:] |= own[1:] != own[:-1]
    own = own[fresh]
    # Marks stay where they are: the first of a run is always kept.
    after, last = run_ends(new_group[fresh]), run_ends(new_value[fresh])
    if known is not None:
        sketches = sketches[np.searchsorted(known, every)]

    def fitting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        fits = 100 * np.minimum(sizes[a], sizes[b]) >= settings.percent * np.maximum(sizes[a], sizes[b])
        pairs = distinct((np.minimum(a, b) * whole + np.maximum(a, b))[fits])
        if known is None:
            return pairs
        a, b = np.divmod(pairs, whole)
        bound = (100 - settings.percent) * (sizes[a] + sizes[b])
        return pairs[(100 + settings.percent) * differing(sketches, a, b) <= bound]

    def needed(found: list[np.ndarray]) -> np.ndarray:
        pairs = distinct(np.concatenate(found))
        if not nearest or not len(pairs):
            return pairs
        a, b = np.divmod(pairs, whole)
        low, high = np.minimum(group_of[a], group_of[b]), np.maximum(group_of[a], group_of[b])
        order = np.lexsort((pairs, differing(sketches, a, b), high, low))
        low, high = low[order], high[order]
        least = np.ones(len(order), dtype=bool)
        least[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        return pairs[order[least]]

    many = last - after
    at = np.flatnonzero(many)
    at = at[np.argsort(own[at], kind="stable")]
    taken = np.cumsum(many[at]) // settings.flush_pairs
    found, held = [np.zeros(0, dtype=np.int64)], 0
    for first, end in zip(*runs(np.diff(taken, prepend=-1) > 0)):
        times = many[at[first:end]]
        one = np.repeat(at[first:end], times)
        two = after[one] + np.arange(len(one)) - np.repeat(np.cumsum(times) - times, times)
        found.append(fitting(own[one], own[two]))
        held += len(found[-1])
        if held > max(settings.flush_pairs, len(found[0])):
            found, held = [needed(found)], 0
    a, b = np.divmod(needed(found), whole)
    return np.stack([every[a], every[b]])


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending distinct values, by sorting: much faster here than hashing them."""
    values = np.sort(values)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def runs(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs start and end; ``first`` marks their starts."""
    starts = np.flatnonzero(first)
    return starts, np.append(starts, len(first))[1:]


def run_ends(first: np.ndarray) -> np.ndarray:
    """For every place the end of its run."""
    starts, ends = runs(first)
    return np.repeat(ends, ends - starts)


def differing(sketches: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The buckets in which the sketches at ``a`` and ``b`` differ."""
    out = np.empty(len(a), dtype=np.int64)
    for first in range(0, len(a), SKETCH_PAIRS):
        some = slice(first, first + SKETCH_PAIRS)
        out[some] = np.bitwise_count(sketches[a[some]] ^ sketches[b[some]]).sum(1, dtype=np.int64)
    return out


def plausible(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches do not rule out; ``differ``: buckets that differ."""
    one = sets.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sets.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    # Sizes that allow a link give sketches of the same or of twice the length.
    words = F.least(F.size("sa"), F.size("sb"))

    def folded(sketch: str) -> Column:
        halves = F.zip_with(
            F.slice(sketch, F.lit(1), words), F.slice(sketch, words + 1, words), lambda x, y: x.bitwiseXOR(y)
        )
        return F.when(F.size(sketch) > words, halves).otherwise(F.col(sketch))

    differ = F.aggregate(
        F.zip_with(folded("sa"), folded("sb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    can = (100 + settings.percent) * F.col("differ") <= (100 - settings.percent) * (F.col("na") + F.col("nb"))
    fits = 100 * F.least("na", "nb") >= settings.percent * F.greatest("na", "nb")
    both = pairs.join(one, "a").join(two, "b").where(fits)
    return both.withColumn("differ", differ).where(can).select("a", "b", "differ")


def undirected(pairs: DataFrame) -> DataFrame:
    """(center, member) with each pair once, in one direction."""
    ends = pairs.where("center <> member").select(
        F.least("center", "member").alias("low"), F.greatest("center", "member").alias("high"), "center"
    )
    once = ends.groupBy("low", "high").agg(F.min("center").alias("center"))
    other = F.when(F.col("center") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    return once.select("center", other.alias("member"))


def partners(pairs: DataFrame, turn: int) -> DataFrame:
    """(center, member): for each set two of its candidates, those with the least hashes, of two hashes of the turn."""

    def least(seed: int) -> Column:
        return F.min_by("b", F.xxhash64(F.lit(2 * turn + seed), "b"))

    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    chosen = both.groupBy(F.col("a").alias("member")).agg(F.array(least(1), least(2)).alias("centers"))
    return chosen.select(F.explode("centers").alias("center"), "member")


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (center, member) that link, as (a, b), written. A center's members are cut into shares."""
    shares = pairs.groupBy("center").agg(F.ceil(F.count("*") / settings.members).alias("shares"))
    dealt = pairs.join(shares, "center").withColumn(
        "share", F.pmod(F.xxhash64("member"), F.col("shares")).cast("int")
    )
    members = dealt.select(F.col("member").alias("set"), "center", "share", F.lit(1).alias("role"))
    own = dealt.select(F.col("center").alias("set"), "center", "share", F.lit(0).alias("role")).distinct()
    wanted = members.unionByName(own).join(texts, "set")
    rows = wanted.repartition("center", "share").sortWithinPartitions("center", "share", "role", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, center = WordHashes(), None, None
        for batch in batches:
            out = []
            for name, middle, share, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = tokens_of(text, hashes, settings)
                if set_id(tokens) != name:
                    continue
                if role == 0:
                    at, center = (middle, share), tokens
                elif at == (middle, share) and linked(center, tokens, settings):
                    out.append((middle, name))
            columns = list(zip(*out)) or [(), ()]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    ordered = rows.select("set", "center", "share", "role", "text")
    return written(ordered.mapInArrow(compare, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(set, component) of the sets in links, by least labels and pointer jumping; written."""
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "link-ends",
    )
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"a": "b", "l": "lb"}), "b").groupBy("a").agg(F.min("lb").alias("ln"))
        lower = labels.join(near, "a").select("a", F.least("l", "ln").alias("l"), F.col("l").alias("old"))
        jumps = labels.select(F.col("a").alias("l"), F.col("l").alias("lj"))
        new = lower.join(jumps, "l", "left").select("a", F.least("l", F.coalesce("lj", "l")).alias("l"), "old")
        new = written(new, "labels")
        labels = new.select("a", "l")
        if not new.where("l <> old").limit(1).count():
            return labels.withColumnsRenamed({"a": "set", "l": "component"})


def with_component(df: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """Add the component of a set; one without links is its own."""
    own = labels.withColumnsRenamed({"set": column, "component": name})
    return df.join(own, column, "left").withColumn(name, F.coalesce(name, column))


def combinations(tokens: np.ndarray, n: int, settings: Settings) -> np.ndarray:
    """Hashes of the combinations of two frequent tokens of a class, for the bands of the smaller set of a pair."""
    out = []
    for band in range(band_of(max(1, settings.overlap(n))), band_of(n) + 1):
        kinds = (tokens >> np.uint64(20)) % np.uint64(classes_of(band))
        order = np.lexsort((tokens, kinds))
        kinds, own = kinds[order], tokens[order]
        at, apart = np.arange(len(own)), 1
        while True:
            at = at[at + apart < len(own)]
            at = at[kinds[at] == kinds[at + apart]]
            if not len(at):
                break
            mixed = (own[at] * FACTOR + own[at + apart]) * FACTOR + np.uint64(band + 1)
            out.append((mixed ^ (mixed >> np.uint64(31))) * STEP)
            apart += 1
    return np.concatenate(out) if out else tokens[:0]


def met_by_combinations(
    common: DataFrame, sets: DataFrame, labels: DataFrame, settings: Settings, nearest: bool = False
) -> DataFrame:
    """Distinct pairs of sets of different components that share a combination of frequent tokens.

    Pairs are ruled out by their sketches of 1,024 buckets where they meet, before they become rows. With
    ``nearest`` a task gives of any two components only the pair that differs least.
    """
    placed = with_component(common, labels, "set", "component")
    spread = placed.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    open_tokens = placed.join(spread.where("c1 <> c2").select("token"), "token")
    grouped = open_tokens.groupBy("set", "component").agg(F.collect_list("token").alias("tokens"))
    owners = grouped.join(sets.select("set", "n", "sketch"), "set")
    bits = max(3, int(2 * common.count() // settings.group_tokens).bit_length())
    high = np.uint64(64 - bits)
    names = ["part", "values", "sets", "sizes", "components", "sketches"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name, n, component, tokens, sketch in zip(*(batch.column(i) for i in range(5))):
                own = combinations(tokens.values.to_numpy().view(np.uint64), n.as_py(), settings)
                held.append((own, name.as_py(), n.as_py(), component.as_py(), narrow(sketch.values.to_numpy())))
                size += len(own)
                if size > settings.flush_tokens:
                    yield parts(held)
                    held, size = [], 0
        if size:
            yield parts(held)

    def parts(held: list[tuple]) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
        values = np.concatenate([h[0] for h in held])
        facts = [np.array([h[i] for h in held], dtype="<i8") for i in (1, 2, 3)]
        sketches = np.stack([h[4] for h in held])
        part = (values >> high).astype(np.int64)
        order = np.argsort(part, kind="stable")
        columns = [values[order], *(f[owner[order]] for f in facts)]
        rows = [(g, *c, None) for g, c in by_group(part[order], *columns)]
        for g in range(1 << bits):  # the sketch of a set once for every part that it is in
            present = np.unique(owner[part == g])
            if len(present):
                rows.append((g, None, facts[0][present].tobytes(), None, None, sketches[present].tobytes()))
        kinds = (pa.int32(), *[pa.binary()] * 5)
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        has_sketch = rows["sketches"].notna()
        own, facts = rows[~has_sketch], rows[has_sketch]

        def joined(some: pd.Series, kind: str) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in some])

        known, firsts = np.unique(joined(facts["sets"], "<i8"), return_index=True)
        sketches = joined(facts["sketches"], "<u8").reshape(-1, SKETCH_BITS // 64)[firsts]
        columns = [joined(own[c], "<i8") for c in names[2:5]]
        a, b = pairs_within(joined(own["values"], "<u8"), *columns, settings, known, sketches, nearest)
        return pd.DataFrame({"a": a, "b": b})

    schema = "part int, values binary, sets binary, sizes binary, components binary, sketches binary"
    indexed = owners.select("set", "n", "component", "tokens", "sketch").mapInArrow(index, schema)
    return indexed.groupBy("part").applyInPandas(meet, "a long, b long").distinct()


def named_partners(common: DataFrame, labels: DataFrame, sets: DataFrame, turn: int, settings: Settings) -> DataFrame:
    """(center, member): for each set up to two sets of other components, of those that its frequent tokens name.

    A token names, of the sets that hold it, the one whose component has the least hash of the
    turn, and of this component the least set. Of what is named and can link, a set takes that
    with the least hash, so that a group agrees, and that which differs least by its sketch.
    """
    placed = with_component(common, labels, "set", "component")
    rank = F.struct(
        F.xxhash64(F.lit(turn), "component").alias("hash"), "component", F.col("set").alias("center"), "n"
    )
    named = placed.groupBy("token").agg(F.min(rank).alias("named"))
    fits = 100 * F.least("n", "named.n") >= settings.percent * F.greatest("n", "named.n")
    offered = (
        placed.join(named, "token")
        .where((F.col("component") != F.col("named.component")) & fits)
        .select(F.col("named.center").alias("a"), F.col("set").alias("b"))
        .distinct()
    )
    agreed = F.min_by("a", F.struct(F.xxhash64(F.lit(turn), "a"), "a"))
    nearest = F.min_by("a", F.struct("differ", "a"))
    chosen = plausible(offered, sets, settings).groupBy(F.col("b").alias("member"))
    return chosen.agg(F.array(agreed, nearest).alias("centers")).select(F.explode("centers").alias("center"), "member")


def apart_pairs(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that are in different components."""
    placed = with_component(with_component(pairs, labels, "a", "ca"), labels, "b", "cb")
    return placed.where("ca <> cb").select("a", "b")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links (a, b): only components that these connect are labelled anew."""
    placed = with_component(with_component(links, labels, "a", "ca"), labels, "b", "cb").where("ca <> cb")
    ends = written(placed.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "joints")
    if not ends.limit(1).count():
        return labels
    joints = components(ends)
    single = joints.select("set").join(labels, "set", "left_anti").withColumn("component", F.col("set"))
    renamed = joints.select(F.col("set").alias("component"), F.col("component").alias("least"))
    every = labels.unionByName(single).join(renamed, "component", "left")
    return written(every.select("set", F.coalesce("least", "component").alias("component")), "labels")


def all_links(pairs: DataFrame, common: DataFrame, sets: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(set, component): verify partners of each set, a few at a time, until no candidates are apart.

    Sets with frequent tokens first agree on partners over some rounds, so that dense groups
    are few components when combinations are indexed. Combinations first give the nearest sets
    of any two components, and when these are verified all candidates that are still apart.
    They are verified by partners again, and after ``rounds`` all that is left at once.
    """
    labels = pairs.sparkSession.createDataFrame([], "set long, component long")
    for turn in range(settings.named_rounds):
        near = named_partners(common, labels, sets, turn, settings)
        if not turn:
            near = near.unionByName(partners(pairs, 0))
        near = written(undirected(near), "chosen")
        if not near.limit(1).count():
            break
        labels = merged(labels, verified(near, texts, settings))
    near = met_by_combinations(common, sets, labels, settings, nearest=True)
    near = plausible(near, sets, settings)
    near = written(near.select(F.col("a").alias("center"), F.col("b").alias("member")), "chosen")
    if near.limit(1).count():
        labels = merged(labels, verified(near, texts, settings))
    met = plausible(met_by_combinations(common, sets, labels, settings), sets, settings).select("a", "b")
    rest = written(apart_pairs(pairs, labels).unionByName(met).distinct(), "rest")
    for turn in range(1, settings.rounds + 1):
        if not rest.limit(1).count():
            break
        chosen = rest.select(F.col("a").alias("center"), F.col("b").alias("member"))
        if turn < settings.rounds:
            chosen = written(undirected(partners(rest, turn)), "chosen")
        labels = merged(labels, verified(chosen, texts, settings))
        if turn < settings.rounds:
            done = chosen.select(F.least("center", "member").alias("a"), F.greatest("center", "member").alias("b"))
            rest = written(apart_pairs(rest.join(done, ["a", "b"], "left_anti"), labels), "rest")
    return labels


def slot_of(hashed: str) -> Column:
    return F.pmod(hashed, F.lit(MAP_BITS))


def bit_map(rows: DataFrame) -> np.ndarray:
    """A map of ``MAP_BITS`` bits with one for each row_hash, by buckets that Spark fills."""
    slot = slot_of("row_hash") + 1  # the buckets of Spark's bitmaps begin at 1
    found = (
        rows.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .toPandas()
    )
    bits = np.zeros((MAP_BITS // BUCKET_BITS, BUCKET_BITS // 8), dtype=np.uint8)
    for bucket, own in zip(found["bucket"], found["bits"]):
        bits[bucket - 1] = np.frombuffer(own, dtype=np.uint8)
    return bits.reshape(-1)


def candidate_texts(docs: DataFrame, needed: DataFrame, text: str, key: str) -> DataFrame:
    """(set, text) of the needed rows. What the bit map lets through beside them the join leaves out."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_map(needed))

    @F.pandas_udf("boolean")
    def marked(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy()
        return pd.Series((bits.value[at >> 3] >> (at & 7)) & 1 == 1)

    own = docs.select(row_hash(key, text), F.col(text).alias("text")).where(marked(slot_of("row_hash")))
    return needed.select("set", "row_hash").join(own, "row_hash").select("set", "text")


def join(docs: DataFrame, settings: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, row_hash, component): the component's least key for each row.

    ``component`` names the component itself; it is null for the empty set.
    """
    rows = shingle_sets(docs, settings, text, key)
    tokens = rows.agg(F.sum("n")).first()[0] or 0
    met = meetings(docs, tokens, settings, text)
    reps = (
        rows.where("n > 0")
        .groupBy(F.col("set_id").alias("set"), "n")
        .agg(F.min("row_hash").alias("row_hash"), F.min("key").alias("least"), F.first("sketch").alias("sketch"))
    )
    reps = written(reps, "representatives")
    met_pairs = plausible(met.where("kind = 0").select("a", "b").distinct(), reps, settings)
    pairs = written(met_pairs.select("a", "b"), "pairs")
    common = written(
        met.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("set"), "n").distinct(), "common"
    )
    met_sets = pairs.select(F.explode(F.array("a", "b")).alias("set")).unionByName(common.select("set")).distinct()
    needed = written(met_sets.join(reps, "set").select("set", "n", "row_hash", "sketch"), "needed")
    texts = written(candidate_texts(docs, needed, text, key), "texts")

    labels = all_links(pairs, common, needed, texts, settings)
    smallest = (
        with_component(reps.select("set", "least"), labels, "set", "component")
        .groupBy("component")
        .agg(F.min("least").alias("component_id"))
    )
    named = with_component(reps.select("set"), labels, "set", "component").join(smallest, "component")
    named = named.select(F.col("set").alias("set_id"), "component_id", "component")
    return rows.join(named, "set_id", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "key").alias("component_id"),
        "row_hash",
        "component",
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Keep one row of every component, that of its least key; rows with the empty set all stay.

    Null keys come last; of different texts under one key the one with the least hash stays,
    and one of rows that repeat key and text, by the hash of all its columns.
    """
    found = join(docs, settings, text, key).select(F.col(key).alias("key"), "row_hash", "component")
    found = written(found, "found")
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row_hash"))
    firsts = found.where("component IS NOT NULL").groupBy("component").agg(first.alias("first")).select("first.row_hash")
    counts = found.groupBy("row_hash").agg(F.count("*").alias("rows"))
    firsts = written(firsts.join(counts, "row_hash"), "firsts")
    empty = found.where("component IS NULL").select("row_hash").distinct()

    def rows_of(hashes: DataFrame) -> DataFrame:
        named = hashes.select(F.col("row_hash").alias("__row"))
        return docs.withColumn("__row", row_hash(key, text)).join(named, "__row", "left_semi")

    order = F.xxhash64(F.to_json(F.struct(*docs.columns)))
    repeated = rows_of(firsts.where("rows > 1")).withColumn("__order", order)
    rank = F.row_number().over(Window.partitionBy("__row").orderBy("__order"))
    one = repeated.withColumn("__rank", rank).where("__rank = 1")
    return rows_of(firsts.where("rows = 1").unionByName(empty.withColumn("rows", F.lit(1)))).select(*docs.columns).unionByName(
        one.select(*docs.columns)
    )
