"""Heaviest processes per snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TOP_N = 20
SNAPSHOT = ["host_id", "snapshot_ts"]


def top_by(
    processes: DataFrame, measure: str, n: int = TOP_N, keys: list[str] | None = None
) -> DataFrame:
    """The ``n`` highest rows by ``measure`` within ``keys``, ties by pid.

    Filtering on the rank lets Spark keep only ``n`` rows per group in every task
    before the shuffle, so a host with a huge process table is not moved whole.
    """
    keys = keys or SNAPSHOT
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(measure), F.asc("pid")))
    return processes.withColumn("rank", rank).filter(F.col("rank") <= n)


def top_processes(processes: DataFrame, n: int = TOP_N, compat: bool = False) -> DataFrame:
    """Union of the top ``n`` by CPU and the top ``n`` by memory, one row per pid.

    ``compat`` gives the top ``2n`` by CPU alone.
    """
    if compat:
        return top_by(processes, "cpu_percent", 2 * n).drop("rank")
    both = (
        top_by(processes, "cpu_percent", n)
        .drop("rank")
        .unionByName(top_by(processes, "mem_percent", n).drop("rank"))
    )
    return distinct_by_pid(both)


def distinct_by_pid(processes: DataFrame) -> DataFrame:
    """One row per process id and snapshot."""
    return processes.dropDuplicates([*SNAPSHOT, "pid"])
