"""CPU percentages and network rates from consecutive counter samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.timestamps import seconds_between, slice_of
from fleetlens.operators.ordered import with_previous

_WRAP = "cast(18446744073709551616 as decimal(20,0))"  # 2^64


def counter_delta(now: Column, before: Column, compat: bool = False) -> Column:
    """Growth of an unsigned counter. A decrease is a reset and counts as 0;
    ``compat`` wraps it around 2^64 instead."""
    delta = now.cast("decimal(20,0)") - before.cast("decimal(20,0)")
    if compat:
        return F.when(delta < 0, delta + F.expr(_WRAP)).otherwise(delta).cast("double")
    return F.greatest(delta, F.lit(0).cast("decimal(20,0)")).cast("double")


def cpu_percent(
    total: Column, system: Column, online: Column, prev: Column, compat: bool = False
) -> Column:
    """Share of the system CPU time since the previous sample, times the CPUs.

    0 on the first sample and whenever a delta is not positive.
    """
    cpu = counter_delta(total, prev["cpu_total"], compat)
    sys = counter_delta(system, prev["cpu_system"], compat)
    usable = prev.isNotNull() & (cpu > 0) & (sys > 0) & (online > 0)
    return F.when(usable, cpu / sys * online * 100.0).otherwise(0.0)


def byte_rate(
    now_ts: Column, now: Column, prev_ts: Column, before: Column, compat: bool = False
) -> Column:
    """Bytes per second since the previous sample; 0 on the first one.

    In ``compat`` mode the previous sample is always stamped after the current one, so
    the rate is 0 throughout.
    """
    if compat:
        return F.lit(0.0)
    seconds = seconds_between(now_ts, prev_ts)
    return F.when(
        prev_ts.isNotNull() & (seconds > 0), counter_delta(now, before) / seconds
    ).otherwise(0.0)


def interface_total(networks: Column, counter: str) -> Column:
    """Sum of one counter over all interfaces of a sample."""
    zero = F.lit(0).cast("decimal(38,0)")
    total = F.aggregate(
        F.map_values(networks),
        zero,
        lambda acc, n: (acc + F.coalesce(n[counter], zero)).cast("decimal(38,0)"),
    )
    return F.coalesce(total, zero)


def rate_columns(paired: DataFrame, compat: bool = False) -> DataFrame:
    """Add ``cpu_percent``, ``rx_rate``, ``tx_rate`` and ``reset`` to samples that carry
    the previous one as ``prev``."""
    prev = F.col("prev")
    cpu = cpu_percent(F.col("cpu_total"), F.col("cpu_system"), F.col("online"), prev, compat)
    shrunk = [F.col(c) < prev[c] for c in ("cpu_total", "rx", "tx")]
    rate = lambda c: byte_rate(F.col("ts"), F.col(c), prev["ts"], prev[c], compat)
    return paired.withColumns(
        {
            "cpu_percent": cpu,
            "rx_rate": rate("rx"),
            "tx_rate": rate("tx"),
            "reset": F.coalesce(shrunk[0] | shrunk[1] | shrunk[2], F.lit(False)),
        }
    )


def sample_rates(
    samples: DataFrame,
    keys: list[str],
    order: list[str],
    slice_seconds: int | None = 3600,
    compat: bool = False,
) -> DataFrame:
    """Rates of counter samples against the previous sample of the same container.

    ``samples`` carries ``ts, cpu_total, cpu_system, online, rx, tx``; ``order`` is total
    within a container. Slices must be narrow enough that the samples of one container
    within a slice fit one task (see ``fit_slice_seconds``).
    """
    values = ["ts", "cpu_total", "cpu_system", "rx", "tx"]
    slices = None if slice_seconds is None else slice_of(F.col("ts"), slice_seconds)
    return rate_columns(with_previous(samples, keys, order, values, slices), compat).drop("prev")


def network_totals(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Received and sent bytes per key over its interfaces, one row per interface in."""
    return samples.groupBy(*keys).agg(
        F.sum("rx_bytes").alias("rx_total"), F.sum("tx_bytes").alias("tx_total")
    )
