"""Process table snapshots to process rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import empty_map
from fleetlens.functions.timestamps import from_millis


def process_rows(raw: DataFrame) -> DataFrame:
    """Process rows; an attribute that could not be read is zero or empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
    real = lambda c: F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c)
    return raw.select(
        "host_id",
        "snapshot_ts",
        F.col("pid").cast("int").alias("pid"),
        whole("ppid"),
        text("executable"),
        text("cmdline"),
        text("user"),
        real("cpu_percent"),
        real("mem_percent"),
        whole("threads"),
        from_millis(F.col("start_ms")).alias("start_time"),
        empty_map().alias("labels"),
    )


def process_payloads(processes: DataFrame) -> DataFrame:
    """One row per host and snapshot with its processes, heaviest first.

    Meant for the output of ``top_processes``, which bounds the array.
    """
    fields = [c for c in processes.columns if c not in ("host_id", "snapshot_ts")]
    packed = processes.groupBy("host_id", "snapshot_ts").agg(
        F.collect_list(F.struct((-F.col("cpu_percent")).alias("neg"), *fields)).alias("p")
    )
    by_load = F.array_sort(
        "p",
        lambda a, b: F.when(a["neg"] < b["neg"], -1)
        .when(a["neg"] > b["neg"], 1)
        .when(a["pid"] < b["pid"], -1)
        .when(a["pid"] > b["pid"], 1)
        .otherwise(0),
    )
    return packed.select(
        "host_id",
        "snapshot_ts",
        F.transform(by_load, lambda p: F.struct(*[p[f].alias(f) for f in fields])).alias("processes"),
    )
