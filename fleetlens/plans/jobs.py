"""The three jobs end to end: captures in, nested exports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timestamps import tick_of
from fleetlens.operators.otlp import otlp_logs, otlp_metrics
from fleetlens.operators.payloads import (
    METRIC_ORDER,
    attach_meta,
    identified,
    log_payloads,
    metric_payloads,
    route_endpoints,
    with_tie,
)
from fleetlens.operators.topn import top_processes
from fleetlens.options import LogOptions, MetricOptions, ProcessOptions, log_settings
from fleetlens.sources.processes import process_payloads
from fleetlens.sources.registry import log_registry, metric_registry


def with_tick(df: DataFrame, seconds: int) -> DataFrame:
    """Add the start of the interval a row falls in."""
    return df.withColumn("tick", tick_of(F.col("ts"), seconds))


def metric_export(
    spark: SparkSession,
    captures: dict,
    meta: DataFrame,
    start_ts,
    tick_seconds: int = 60,
    options: MetricOptions = MetricOptions(),
) -> DataFrame:
    """OTLP-shaped metrics per endpoint and tick of the configured sources.

    ``captures`` names the captured tables, see ``registry.read_capture``.
    """
    containers = {"compat": options.compat, **captures.get("containers", {})}
    captures = {**captures, "containers": containers}
    metrics = metric_registry().collect(spark, options.sources, captures)
    routed = with_tick(with_tie(route_endpoints(metrics)), tick_seconds)
    payloads = metric_payloads(
        routed,
        meta,
        METRIC_ORDER,
        F.lit(start_ts).cast("timestamp"),
        options.max_points,
        F.unix_seconds("ts"),
        options.product,
    )
    return otlp_metrics(payloads, options.compat)


def log_export(
    spark: SparkSession,
    captures: dict,
    meta: DataFrame,
    tick_seconds: int = 30,
    options: LogOptions = LogOptions(),
    os: str = "linux",
) -> DataFrame:
    """OTLP-shaped log batches per host, source and tick of the configured sources."""
    captures = dict(captures)
    for name, values in log_settings(options).items():
        captures[name] = {**values, **captures.get(name, {})}
    captures["channels"] = (list(options.channels), list(options.exclude_channels), options.collect_all)
    logs = with_tick(log_registry().collect(spark, options.sources, captures, os), tick_seconds)
    # Entries that are equal in all of these are interchangeable.
    tied = logs.withColumn("tie", F.xxhash64("level", "message", "category", "pid"))
    payloads = log_payloads(
        tied,
        meta,
        ["host_id", "source", "tick"],
        ["ts", "tie"],
        options.batch_size,
        F.unix_seconds("ts"),
        options.product,
    )
    return otlp_logs(payloads, options.compat)


def process_export(
    processes: DataFrame, meta: DataFrame, options: ProcessOptions = ProcessOptions()
) -> DataFrame:
    """Heaviest processes per host and snapshot with the host's identity and metadata."""
    top = top_processes(processes, options.top_n, options.compat)
    return identified(attach_meta(process_payloads(top), meta))
