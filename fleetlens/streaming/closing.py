"""Groups of a stream - a host's snapshot, an endpoint's tick - held until they are complete.

The rows of a group may arrive in many micro-batches. They are kept as state and
released together in the one micro-batch in which the watermark passes the group's time, by
an event-time timer. What comes after that is passed on at once, flagged ``late``. A batch
operator then shapes whole groups, so a stream gives what a batch over the same rows gives.

Groups that close at the same time share their state: their rows are dealt to buckets and
travel as lines of a text for each bucket, so that Python is called for a bucket and not for
every group, and a hot group is spread. Only where a group's rows are compared while they are
held does every group have a state of its own.

The watermark follows a copy of the time column that is dropped before the state: Spark
would otherwise leave late rows out silently. Rows at or after ``end`` only move the watermark; a run
over a bounded input closes its last groups with such a row, where a running stream has
the next snapshot.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

# The processors are sent to the workers as code, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUT = "closes long, late boolean, row string"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
# Buckets of the groups that close at the same time.
BUCKETS = 32
# Rows and bytes that a task packs at once, and characters that leave the state at once.
_ROWS, _BYTES, _CHARS = 65_536, 16 << 20, 4 << 20


def packed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as lines of one text for each group of some batches."""

    def lines(taken: list[pa.RecordBatch]) -> pa.RecordBatch:
        groups = pa.Table.from_batches(taken).group_by("group", use_threads=False).aggregate([("closes", "min"), ("row", "list")])
        groups = groups.combine_chunks()
        columns = [groups["group"], groups["closes_min"], pc.binary_join(groups["row_list"], "\n")]
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in columns], names=["group", "closes", "row"])

    taken, rows, size = [], 0, 0
    for batch in batches:
        taken.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= _ROWS or size >= _BYTES:
            yield lines(taken)
            taken, rows, size = [], 0, 0
    if rows:
        yield lines(taken)


class Held(StatefulProcessor):
    """Keeps rows as a list of texts; chunks of it are released when their groups close."""

    by_group = False

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "row string")
        self.closes = handle.getValueState("closes", "closes long")

    def handleInputRows(self, key, rows, timerValues):
        known = None
        for frame in rows:
            closes = int(frame["closes"].iloc[0])
            # A timer that is not yet due releases the group; after it, rows are late.
            if timerValues.getCurrentWatermarkInMs() > closes:
                yield frame[["closes", "row"]].assign(late=True)[["closes", "late", "row"]]
                continue
            known = known or self.closes.get()
            if known is None:
                known = (closes,)
                self.closes.update(known)
                self.handle.registerTimer(closes)
            self.keep(frame)

    def keep(self, frame: pd.DataFrame) -> None:
        self.rows.appendList([(r,) for r in frame["row"]])

    def released(self):
        return (r[0] for r in self.rows.get())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closes, chunk, size = int(self.closes.get()[0]), [], 0
        for row in self.released():
            chunk.append(row)
            size += len(row)
            if size >= _CHARS:
                yield pd.DataFrame({"closes": closes, "late": False, "row": chunk})
                chunk, size = [], 0
        if chunk:
            yield pd.DataFrame({"closes": closes, "late": False, "row": chunk})
        self.rows.clear()
        self.closes.clear()

    def close(self) -> None:
        pass


class HeldTop(Held):
    """Keeps only the rows that can be among the ``n`` highest by one of the measures.

    A list of at most ``n`` rows for each measure, ties by ``tie``, whatever arrives.
    """

    by_group = True

    def __init__(self, measures: tuple[str, ...], tie: str, n: int) -> None:
        self.measures, self.tie, self.n = measures, tie, n

    def keep(self, frame: pd.DataFrame) -> None:
        known = {}
        for row in [*self.released(), *frame["row"]]:
            parsed = json.loads(row)
            known.setdefault(parsed[self.tie], (parsed, row))
        kept = {}
        for measure in self.measures:
            best = sorted(known.values(), key=lambda x: (-float(x[0][measure]), x[0][self.tie]))[: self.n]
            kept |= {parsed[self.tie]: row for parsed, row in best}
        self.rows.put([(row,) for row in kept.values()])


def closed_groups(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    closes: str,
    delay: str,
    processor: StatefulProcessor,
    end: str | None = None,
) -> DataFrame:
    """The rows of each group of ``keys`` once it is closed, and rows that come later.

    ``closes`` is an SQL expression for the time in ms after which a group has no more rows.
    The columns are those of ``rows``, and ``late``.
    """
    watched = rows.withColumn("__watched", F.col(ts)).withWatermark("__watched", delay)
    if end is not None:
        # On the watched column, so that the filter stays above the watermark.
        watched = watched.filter(F.col("__watched") < F.lit(end).cast("timestamp"))
    packed = watched.select(
        F.to_json(F.struct(*keys), _JSON).alias("group"),
        F.expr(closes).cast("long").alias("closes"),
        F.to_json(F.struct(*rows.columns), _JSON).alias("row"),
    )
    if not processor.by_group:
        bucket = F.concat_ws("/", "closes", F.pmod(F.xxhash64("row"), F.lit(BUCKETS)))
        packed = packed.withColumn("group", bucket).mapInArrow(packed_lines, "group string, closes long, row string")
    kept = packed.groupBy("group").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=_OUT, outputMode="Append", timeMode="EventTime"
    )
    kept = kept.select(F.explode(F.split("row", "\n")).alias("row"), "late")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
    return kept.select(F.from_json("row", schema, _JSON).alias("r"), "late").select("r.*", "late")
