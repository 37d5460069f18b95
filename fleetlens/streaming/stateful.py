"""Previous counter sample per container, kept as stream state."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetlens.functions.timestamps import from_micros
from fleetlens.operators.rates import rate_columns

# The processor is sent to the workers as code, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTERS = ["cpu_total", "cpu_system", "rx", "tx"]
_KEY = "series string"
# A null counter travels as 0 with its bit in ``nulls``.
_ROW = "us bigint, cpu_total bigint, cpu_system bigint, online int, rx bigint, tx bigint, nulls int"
_PREV = "us bigint, cpu_total bigint, cpu_system bigint, rx bigint, tx bigint, nulls int"
_OUT = (
    f"{_KEY}, {_ROW}, has_prev boolean, late boolean, "
    + ", ".join(f"prev_{c} bigint" for c in ["us", *COUNTERS])
    + ", prev_nulls int"
)
# Counters travel as signed 64-bit numbers shifted by 2^63, which keeps every bit.
_SHIFT = "cast(9223372036854775808 as decimal(20,0))"


class PreviousSample(StatefulProcessor):
    """Pairs each sample with the one before it.

    A sample that is not newer than the stored one of an earlier micro-batch is late: it is
    passed on without a previous sample, and the state stays as it is.
    """

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", _PREV, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        fields = ["us", "cpu_total", "cpu_system", "rx", "tx", "nulls"]
        samples = pd.concat(list(rows)).sort_values(fields)
        stored = self.last.get() if self.last.exists() else None
        late = samples["us"] <= stored[0] if stored is not None else samples["us"] != samples["us"]
        new = samples[~late]
        previous = samples[fields].astype("int64") * 0
        previous.loc[~late.to_numpy()] = new[fields].shift(1, fill_value=0).to_numpy()
        has_prev = (~late).to_numpy(copy=True)
        if len(new):
            first = int(has_prev.argmax())
            if stored is None:
                has_prev[first] = False
            else:
                previous.iloc[first] = list(stored)
            last = new.iloc[-1]
            self.last.update(tuple(int(last[f]) for f in fields))
        own = samples[["series", "us", "cpu_total", "cpu_system", "online", "rx", "tx", "nulls"]]
        yield pd.concat(
            [own.assign(has_prev=has_prev, late=late.to_numpy()), previous.add_prefix("prev_")], axis=1
        )

    def close(self) -> None:
        pass


def stream_rates(
    samples: DataFrame, series: str, compat: bool = False, ttl_ms: int | None = None
) -> DataFrame:
    """Rates of a stream of counter samples; the columns of the batch operator and ``late``.

    Only the pairing of neighbours needs state. It is one small row per container in
    the state store, and the arithmetic stays in the same column expressions as in
    batch. ``ttl_ms`` forgets containers that stopped reporting.
    """
    encode = lambda c: (
        (F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)") - F.expr(_SHIFT)).cast("bigint").alias(c)
    )

    def decode(c: str, nulls: str = "nulls"):
        absent = F.col(nulls).bitwiseAND(1 << COUNTERS.index(c.removeprefix("prev_"))) != 0
        return F.when(~absent, (F.col(c).cast("decimal(20,0)") + F.expr(_SHIFT)).cast("decimal(20,0)"))

    narrow = samples.select(
        F.col(series).cast("string").alias("series"),
        F.unix_micros("ts").alias("us"),
        encode("cpu_total"),
        encode("cpu_system"),
        F.coalesce(F.col("online"), F.lit(0)).cast("int").alias("online"),
        encode("rx"),
        encode("tx"),
        sum((F.col(c).isNull().cast("int") * (1 << k) for k, c in enumerate(COUNTERS)), F.lit(0)).alias("nulls"),
    )
    paired = narrow.groupBy("series").transformWithStateInPandas(
        statefulProcessor=PreviousSample(ttl_ms),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )
    prev = F.when(
        F.col("has_prev"),
        F.struct(
            from_micros(F.col("prev_us")).alias("ts"),
            *[decode(f"prev_{c}", "prev_nulls").alias(c) for c in COUNTERS],
        ),
    )
    decoded = paired.select(
        "series",
        from_micros(F.col("us")).alias("ts"),
        *[decode(c).alias(c) for c in COUNTERS],
        "online",
        "late",
        prev.alias("prev"),
    )
    return rate_columns(decoded, compat).drop("prev")
