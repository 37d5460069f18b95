"""Mix sources to target weights: pack words into blocks, draw blocks, join them by index.

The words of a source, documents one after the other, are cut into blocks of ``block_words``.
A source's target becomes a whole number of slots. The slots of all sources form one deck,
and a pseudorandom permutation deals the deck to output shards of ``shard_slots`` slots, so
the source counts of a shard are a multinomial draw under the condition that the totals over
all shards meet the targets. Slot j of a source takes block ``permutation(j mod blocks)`` in
round ``j div blocks`` (at most three rounds): every block is taken once before any is taken
twice. The permutations are swap-or-not shuffles over exactly the indices in use, computed
from hashes, so reruns agree and no order has to be stored or sorted. The drawn slots are joined
with the blocks by source and index: what the mix takes of a document is the sum over these
slots, and shard and place say where it stands in the output.

Weights: sources by code point, null last, weigh 1, 2, 3 and so on in turn and share all
words; a target stops at ``repeats`` times its source's size and the excess is shared again.

A null text has size 0 and is never taken; null is a source like any other. Repeated rows
are rows of their own. Running totals go over hash buckets of a source, about the square
root of the number of rows, so that a hot source is spread. Everything is DataFrame
expressions; only per-source totals meet in one task. Long texts are cut into blocks like
others. Input columns stay out of the way of helper columns, which are kept apart from them
in one struct; an empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import words_of, written

# Rounds of the shuffle; slots made by one task.
ROUNDS = 16
CHUNK = 16_384


@dataclass(frozen=True)
class Plan:
    block_words: int = 128
    shard_slots: int = 256
    repeats: int = 3
    seed: int = 20_261


def shuffled(index: Column, size: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0 to size-1 (swap-or-not), another one for each key."""

    def step(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("partner"), turn, *keys), size) - x, size)
        coin = F.xxhash64(F.lit("coin"), turn, F.greatest(x, partner), *keys).bitwiseAND(F.lit(1))
        return F.when(coin == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), step)


def with_sizes(docs: DataFrame, text: str, source: str, *keep: str) -> DataFrame:
    """Written rows with a row number, the size, the source and the key of the packing order."""
    return written(
        docs.select(
            *keep,
            F.col(source).cast("string").alias("mix_source"),
            F.size(words_of(F.col(text))).cast("long").alias("size"),
            F.xxhash64(F.col(text)).alias("text_hash"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "mix-rows",
    )


def targets(rows: DataFrame, plan: Plan) -> DataFrame:
    """Per source its size, target, blocks and slots, and where its slots begin in the deck."""
    sources = rows.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col("mix_source").asc_nulls_last())
    weighed = sources.select(
        "mix_source",
        "source_size",
        ((F.row_number().over(in_order) - 1) % 3 + 1).alias("weight"),
        (F.col("source_size") * plan.repeats).cast("double").alias("most"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
    )
    # In order of the share at which a source is full, each source's share if exactly those
    # before it are full. It grows while sources fill up and then falls: the peak is the level.
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("mix_source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    filled = weighed.select(
        "*",
        (
            (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        ).alias("share"),
    )
    level = F.max("share").over(everything)
    aimed = filled.withColumn("target", F.least("most", level * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / plan.block_words)
    slots = F.when(
        F.col("source_size") > 0,
        F.least(blocks * plan.repeats, F.round(F.col("target") * blocks / F.col("source_size"))),
    ).otherwise(0)
    deck = Window.orderBy(F.col("mix_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        aimed.withColumns({"blocks": blocks.cast("long"), "slots": slots.cast("long")})
        .withColumns(
            {
                "first_slot": F.coalesce(F.sum("slots").over(deck), F.lit(0)),
                "all_slots": F.sum("slots").over(everything),
            }
        )
        .select("mix_source", "source_size", "target", "blocks", "slots", "first_slot", "all_slots")
    )


def draw(sources: DataFrame, plan: Plan) -> DataFrame:
    """One row for each slot of the mix: shard, place in the shard, source, block."""
    chunks = sources.where("slots > 0").withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long")))
    )
    # As many partitions as chunks: a chunk's row is tiny, the slots that it becomes are not.
    total = sources.agg(F.max("all_slots")).first()[0] or 0
    chunks = chunks.repartition(min(10_000, 1 + total // CHUNK), "mix_source", "from")
    slots = chunks.withColumn(
        "slot", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK, F.col("slots")) - 1))
    )
    turn = F.floor(F.col("slot") / F.col("blocks"))
    seed = F.lit(plan.seed)
    place = shuffled(F.col("first_slot") + F.col("slot"), F.col("all_slots"), seed)
    return slots.withColumn("place", place).select(
        "mix_source",
        turn.alias("turn"),
        shuffled(F.col("slot") % F.col("blocks"), F.col("blocks"), seed, F.col("mix_source"), turn).alias("block"),
        F.floor(F.col("place") / plan.shard_slots).alias("shard"),
        (F.col("place") % plan.shard_slots).alias("place"),
    )


def packed(rows: DataFrame, plan: Plan) -> DataFrame:
    """Per row and block that it reaches into: the first word there and the number of words."""
    buckets = F.lit(max(1, round(rows.count() ** 0.5)))
    keyed = rows.where("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), buckets))
    order = Window.partitionBy("mix_source", "bucket").orderBy("doc_id", "text_hash", "size")
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
    earlier = Window.partitionBy("mix_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("mix_source", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .withColumnsRenamed({"mix_source": "offset_source", "bucket": "offset_bucket"})
    )
    same = F.col("mix_source").eqNullSafe(F.col("offset_source")) & (F.col("bucket") == F.col("offset_bucket"))
    first = F.col("before") + F.col("offset")
    n = plan.block_words
    return (
        local.join(offsets.hint("merge"), same)
        .select("row_id", "mix_source", "size", first.alias("first"))
        .withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("first") / n), F.floor((F.col("first") + F.col("size") - 1) / n)))
        )
        .select(
            "row_id",
            "mix_source",
            "size",
            "block",
            (F.greatest(F.col("block") * n, "first") - F.col("first")).alias("from_word"),
            (
                F.least((F.col("block") + 1) * n, F.col("first") + F.col("size"))
                - F.greatest(F.col("block") * n, "first")
            ).alias("words"),
        )
    )


def taken_blocks(rows: DataFrame, sources: DataFrame, plan: Plan) -> DataFrame:
    """One row for each packed piece and slot of the mix that takes it, with ``turn``, ``shard`` and ``place``."""
    slots = draw(sources, plan).withColumnsRenamed({"mix_source": "drawn_source", "block": "drawn_block"})
    same = F.col("mix_source").eqNullSafe(F.col("drawn_source")) & (F.col("block") == F.col("drawn_block"))
    # A slot counts as no larger than the chunk that it comes from, so without the hint all slots would be broadcast.
    return packed(rows, plan).join(slots.hint("merge"), same).drop("drawn_source", "drawn_block")


def report(docs: DataFrame, plan: Plan = Plan(), text: str = "text", source: str = "source") -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it.

    ``first_shard`` and ``first_place`` are where the mix first shows words of it, ``n_slots`` in
    how many slots it has words; null, null and 0 where nothing is taken.
    """
    rows = with_sizes(docs, text, source, "doc_id")
    sources = written(targets(rows, plan), "mix-sources")
    taken = (
        taken_blocks(rows, sources, plan)
        .groupBy("row_id")
        .agg(
            F.sum("words").alias("taken"),
            F.count("*").alias("n_slots"),
            F.min(F.col("shard") * plan.shard_slots + F.col("place")).alias("first"),
        )
    )
    facts = sources.select(F.col("mix_source").alias("of_source"), "source_size", "target")
    return (
        rows.join(taken, "row_id", "left")
        .join(facts, F.col("mix_source").eqNullSafe(F.col("of_source")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
            F.floor(F.col("first") / plan.shard_slots).alias("first_shard"),
            (F.col("first") % plan.shard_slots).alias("first_place"),
        )
    )


def shard_counts(docs: DataFrame, plan: Plan = Plan(), text: str = "text", source: str = "source") -> DataFrame:
    """The draw itself: slots per output shard and source."""
    sources = written(targets(with_sizes(docs, text, source, "doc_id"), plan), "mix-sources")
    return draw(sources, plan).groupBy("shard", F.col("mix_source").alias("source")).agg(F.count("*").alias("slots"))


def keyed(docs: DataFrame) -> DataFrame:
    """Rows as one struct, with a key that a second reading of them gives again.

    Rows of a file are known by file and place in it. Other rows are written first.
    """
    try:
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("_metadata.row_index"))
        return docs.select(place.alias("row_id"), F.struct(*docs.columns).alias("doc"))
    except AnalysisException:
        numbered = docs.select(F.monotonically_increasing_id().alias("row_id"), F.struct(*docs.columns).alias("doc"))
        return written(numbered, "mix-docs")


def mixed(docs: DataFrame, plan: Plan = Plan(), text: str = "text", source: str = "source", id: str = "doc_id") -> DataFrame:
    """The documents of the mix, up to three rows each; words in blocks that are not taken are left out.

    The columns are those of ``docs``. A row of the mix is a document in one round of its
    source's blocks; one that is taken whole keeps its text as it is. Within a file, rows
    stand in the order of the shards and places where the mix first shows them.
    """
    rows = keyed(docs)
    sized = written(
        rows.select(
            "row_id",
            F.col("doc")[id].alias("doc_id"),
            F.col("doc")[source].cast("string").alias("mix_source"),
            F.size(words_of(F.col("doc")[text])).cast("long").alias("size"),
            F.xxhash64(F.col("doc")[text]).alias("text_hash"),
        ),
        "mix-sizes",
    )
    sources = written(targets(sized, plan), "mix-sources")
    rounds = (
        taken_blocks(sized, sources, plan)
        .groupBy("row_id", "turn", "size")
        .agg(
            F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("pieces"),
            F.sum("words").alias("taken"),
            F.min(F.struct("shard", "place")).alias("first"),
        )
        .select("row_id", F.struct("first", "pieces", (F.col("taken") == F.col("size")).alias("whole")).alias("copy"))
        .groupBy("row_id")
        .agg(F.collect_list("copy").alias("copies"))
    )
    # At most three copies a row; they are made after the texts have moved.
    copies = rows.join(rounds, "row_id").select("doc", F.explode("copies").alias("copy"))
    body = F.col("doc")[text]
    words = F.when(~F.col("copy.whole"), words_of(body))
    cut = F.flatten(
        F.transform("copy.pieces", lambda p: F.slice("__words", p["from_word"].cast("int") + 1, p["words"].cast("int")))
    )
    shown = copies.withColumn("__words", words).withColumn(
        "__text", F.when(F.col("copy.whole"), body).otherwise(F.array_join(cut, " "))
    )
    in_order = shown.select("doc", "__text", "copy.first").sortWithinPartitions("first")
    return in_order.select(*[F.col("__text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])
