"""Statistic sets of a stream: the rollup of batch, interval by interval.

Rows are reduced twice. Within a task, Arrow batches become one partial set per series
and interval, so a series with a third of all samples sends a few rows, not all of them. The
sets travel and are kept as Arrow tables, one for each bucket of series and interval, so that
Python is called for a bucket and not for every series; tables of the state are merged once
they have doubled. An event-time timer closes the buckets of an interval. Partial sets that
come after that are passed on as sets of their own, flagged ``late``. The buckets are part of
the state: their number stays as it is for a checkpoint's life.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetlens.functions.maps import sorted_entries
from fleetlens.functions.timestamps import from_micros, slice_of
from fleetlens.operators.rollup import SERIES

# The processor is sent to the workers as code, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SET = "n long, total double, least double, most double, resolution long"
_OUT = f"series string, start long, late boolean, {_SET}"
_FIELDS = ["n", "total", "least", "most", "resolution"]
# Buckets of an interval.
BUCKETS = 32
# Rows that a task reduces at once, and sets that a table or an output frame has at most.
_ROWS = 131_072
_CHUNK = 16_384


def partial_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One set for each series and interval of some batches, as a table for each bucket and interval."""
    keys = ["bucket", "start", "series"]
    how = [("value", "count"), ("value", "sum"), ("value", "min"), ("value", "max"), ("resolution", "max")]

    def reduced(taken: list[pa.RecordBatch]) -> pa.RecordBatch:
        sets = pa.Table.from_batches(taken).group_by(keys, use_threads=False).aggregate(how)
        sets = sets.select([*keys, *[f"{c}_{h}" for c, h in how]]).rename_columns([*keys, *_FIELDS])
        sets = sets.sort_by([("bucket", "ascending"), ("start", "ascending")]).combine_chunks()
        bucket, start = (sets[c].to_numpy() for c in keys[:2])
        # Where a table begins: grouping again would not keep the order.
        first = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (start[1:] != start[:-1])])
        ends = [*first[1:].tolist(), sets.num_rows]
        narrow = sets.select(["series", *_FIELDS])
        tables = pa.array([sent(narrow.slice(i, end - i)) for i, end in zip(first.tolist(), ends)], pa.binary())
        columns = [sets[c].take(pa.array(first)).combine_chunks() for c in keys[:2]]
        return pa.RecordBatch.from_arrays([*columns, tables], names=["bucket", "start", "sets"])

    taken, n = [], 0
    for batch in batches:
        taken.append(batch)
        n += batch.num_rows
        if n >= _ROWS:
            yield reduced(taken)
            taken, n = [], 0
    if n:
        yield reduced(taken)


def sent(sets: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, sets.schema) as writer:
        writer.write_table(sets)
    return sink.getvalue().to_pybytes()


def received(sets: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(sets)).read_all()


def merged(sets: list[pa.Table]) -> pa.Table:
    """One set for each series; a part that is null or NaN counts as absent."""
    how = list(zip(_FIELDS, ["sum", "sum", "min", "max", "max"]))
    all_sets = pa.concat_tables(sets)
    for i, (name, kind) in enumerate(zip(all_sets.column_names, all_sets.schema.types)):
        if pa.types.is_floating(kind):
            values = all_sets[name]
            all_sets = all_sets.set_column(i, name, pc.if_else(pc.is_nan(values), pa.scalar(None, kind), values))
    out = all_sets.group_by("series", use_threads=False).aggregate(how)
    return out.select(["series", *[f"{c}_{h}" for c, h in how]]).rename_columns(["series", *_FIELDS])


def packed(sets: pa.Table) -> list[tuple[bytes]]:
    """Sets as entries of the state."""
    return [(sent(sets.slice(start, _CHUNK)),) for start in range(0, sets.num_rows, _CHUNK)]


class OpenSets(StatefulProcessor):
    """The sets of a bucket of series and an interval until the watermark has passed the interval."""

    def __init__(self, interval_us: int) -> None:
        self.interval_us = interval_us

    def init(self, handle) -> None:
        self.handle = handle
        self.sets = handle.getListState("sets", "sets binary")
        # Sets that are merged, and those that came since.
        self.held = handle.getValueState("held", "merged long, added long")

    def _known(self) -> list[pa.Table]:
        return [received(entry[0]) for entry in self.sets.get()]

    def _frames(self, key, late: bool, sets: pa.Table) -> Iterator[pd.DataFrame]:
        for start in range(0, sets.num_rows, _CHUNK):
            frame = sets.slice(start, _CHUNK).to_pandas().astype({"n": "int64", "resolution": "Int64"})
            yield frame.assign(start=int(key[1]), late=late)[["series", "start", "late", *_FIELDS]]

    def handleInputRows(self, key, rows, timerValues):
        closes = (int(key[1]) + self.interval_us) // 1000 - 1
        new = merged([received(sets) for frame in rows for sets in frame["sets"]])
        if timerValues.getCurrentWatermarkInMs() > closes:
            yield from self._frames(key, True, new)
            return
        held = self.held.get()
        if held is None:
            self.handle.registerTimer(closes)
        known, added = held or (0, 0)
        added += new.num_rows
        if added < known:
            self.sets.appendList(packed(new))
        else:
            new = merged([*self._known(), new]) if known else new
            self.sets.put(packed(new))
            known, added = new.num_rows, 0
        self.held.update((known, added))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._frames(key, False, merged(self._known()))
        self.sets.clear()
        self.held.clear()

    def close(self) -> None:
        pass


def rolled(metrics: DataFrame, interval_seconds: int, delay: str, end: str | None = None) -> DataFrame:
    """The columns of the batch rollup, and ``late``, of a stream of metric rows."""
    watched = metrics.withColumn("__watched", F.col("ts")).withWatermark("__watched", delay)
    if end is not None:
        watched = watched.filter(F.col("__watched") < F.lit(end).cast("timestamp"))
    key = F.struct(*SERIES, sorted_entries(F.col("dimensions")).alias("dims"))
    narrow = watched.select(
        F.to_json(key, {"ignoreNullFields": "false"}).alias("series"),
        slice_of(F.col("ts"), interval_seconds).alias("start"),
        F.col("value").cast("double").alias("value"),
        F.col("storage_resolution").cast("long").alias("resolution"),
    )
    sets = (
        narrow.withColumn("bucket", F.pmod(F.xxhash64("series"), F.lit(BUCKETS)).cast("int"))
        .mapInArrow(partial_sets, "bucket int, start long, sets binary")
        .groupBy("bucket", "start")
        .transformWithStateInPandas(
            statefulProcessor=OpenSets(interval_seconds * 1_000_000),
            outputStructType=_OUT,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    fields = ", ".join(f"{c} string" for c in SERIES)
    named = sets.withColumn("s", F.from_json("series", f"{fields}, dims array<struct<key: string, value: string>>"))
    return named.select(
        *[F.col(f"s.{c}").alias(c) for c in SERIES[:4]],
        from_micros(F.col("start")).alias("ts"),
        F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("value"),
        *[F.col(f"s.{c}").alias(c) for c in SERIES[4:]],
        F.map_from_entries("s.dims").alias("dimensions"),
        F.struct(
            F.col("least").alias("minimum"),
            F.col("most").alias("maximum"),
            F.col("total").alias("sum"),
            F.col("n").cast("int").alias("sample_count"),
        ).alias("stats"),
        F.col("resolution").cast("int").alias("storage_resolution"),
        "late",
    )
