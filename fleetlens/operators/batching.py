"""Ordered batches of log entries and bounded parts of payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.ordered import with_position


def number_batches(
    logs: DataFrame,
    keys: list[str],
    order: list[str],
    size: int,
    slice_by: Column | None,
    into: str = "batch",
) -> DataFrame:
    """Cut each key's entries, in order, into batches of ``size``; the last is short."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    return (
        with_position(logs, keys, order, slice_by, "__position")
        .withColumn(into, F.floor(F.col("__position") / F.lit(size)))
        .withColumn("seq", F.pmod(F.col("__position"), F.lit(size)))
        .drop("__position")
    )


def admit(
    logs: DataFrame,
    keys: list[str],
    order: list[str],
    capacity: int,
    slice_by: Column | None,
) -> tuple[DataFrame, DataFrame]:
    """Entries that a queue of ``capacity`` takes per key (host, source and tick), and what it sheds.

    The described agent queues a source's lines between two ticks and drops the newest when
    the queue is full. Our jobs wait instead; this is for comparing with it. The first
    ``capacity`` entries of a key are kept as they are. The second table has a row for every
    key: ``kept``, ``shed`` and the first entry's place in ``order`` that was shed, exactly.
    """
    if capacity < 0:
        raise ValueError("capacity must not be negative")
    placed = with_position(logs, keys, order, slice_by, "__position")
    kept = placed.filter(F.col("__position") < capacity).drop("__position")
    inside = F.col("__position") < capacity
    counts = placed.groupBy(*keys).agg(
        F.count_if(inside).alias("kept"),
        F.count_if(~inside).alias("shed"),
        F.min(F.when(~inside, F.struct(*order))).alias("first_shed"),
    )
    return kept, counts


def collect_batches(numbered: DataFrame, keys: list[str], entry: Column, into: str = "logs") -> DataFrame:
    """One row per batch with its entries as an array; never longer than the batch size."""
    packed = numbered.groupBy(*keys, "batch").agg(
        F.collect_list(F.struct(F.col("seq"), entry.alias("entry"))).alias("packed")
    )
    ordered = F.array_sort(
        "packed", lambda a, b: (a["seq"] - b["seq"]).cast("int")
    )
    return packed.select(
        *keys, "batch", F.transform(ordered, lambda p: p["entry"]).alias(into)
    )
