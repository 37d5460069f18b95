"""Statistic sets per series and interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import sorted_entries

SERIES = ["host_id", "namespace", "sub_namespace", "name", "type", "unit"]


def stat_rollup(metrics: DataFrame, interval_seconds: int = 3600) -> DataFrame:
    """Count, sum, minimum and maximum of every series and interval as metric rows.

    The series key holds the dimensions as sorted entries. Aggregation is partial
    before the shuffle, so a series with a third of all samples costs one row per task.
    Works on streams too, with a watermark on ``ts``.
    """
    rolled = metrics.groupBy(
        *SERIES,
        sorted_entries(F.col("dimensions")).alias("dims"),
        F.window("ts", f"{interval_seconds} seconds").alias("interval"),
    ).agg(
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.sum("value").alias("sum"),
        F.count("value").cast("int").alias("sample_count"),
        F.max("storage_resolution").alias("storage_resolution"),
    )
    return rolled.select(
        "host_id",
        "namespace",
        "sub_namespace",
        "name",
        F.col("interval")["start"].alias("ts"),
        (F.col("sum") / F.col("sample_count")).alias("value"),
        "type",
        "unit",
        F.map_from_entries("dims").alias("dimensions"),
        F.struct("minimum", "maximum", "sum", "sample_count").alias("stats"),
        "storage_resolution",
    )


def is_histogram(stats: Column) -> Column:
    """A statistic set with samples is exported as a histogram, all else as a gauge."""
    return stats.isNotNull() & (stats["sample_count"] > 0)
