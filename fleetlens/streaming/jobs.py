"""The three independent streams: metrics, logs, processes - and rates.

Each has its own checkpoint, so each resumes on its own. A stream picks up whole files
from a folder that rotation fills, oldest first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.functions.timestamps import tick_of, within_lookback
from fleetlens.operators.otlp import otlp_logs, otlp_metrics
from fleetlens.operators.payloads import (
    METRIC_ORDER,
    assemble_payloads,
    attach_meta,
    identified,
    log_payloads,
    metric_payloads,
    route_endpoints,
    with_tie,
)
from fleetlens.operators.topn import SNAPSHOT, top_processes
from fleetlens.options import LogOptions, MetricOptions, ProcessOptions, StreamOptions, log_settings
from fleetlens.schemas import RAW_PROCESS
from fleetlens.sources.processes import process_payloads, process_rows
from fleetlens.sources.registry import log_registry, metric_registry, read_capture
from fleetlens.streaming.closing import Held, HeldTop, closed_groups
from fleetlens.streaming.rollup import rolled
from fleetlens.streaming.stateful import stream_rates


def read_files(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """A stream over the files of a folder, with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def recent_only(records: DataFrame, start_ts, minutes: int = 5, ts: str = "ts") -> DataFrame:
    """Start policy: skip what is older than the look-back before the start."""
    return records.filter(within_lookback(F.col(ts), F.lit(start_ts).cast("timestamp"), minutes))


def _start(df: DataFrame, options: StreamOptions, name: str):
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", options.checkpoint)
        .trigger(**options.trigger)
    )


def write_rows(rows: DataFrame, options: StreamOptions, name: str, fmt: str = "parquet") -> StreamingQuery:
    """Append rows as files; the file sink's log makes each batch appear once."""
    return (
        _start(rows, options, name)
        .format(fmt)
        .option("path", options.output)
        .outputMode("append")
        .start()
    )


def write_batches(
    rows: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    options: StreamOptions,
    name: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Shape every micro-batch as a whole and write it under its own folder of query and batch.

    A batch that is run again after a failure overwrites its folder, so no payload is
    written twice; another checkpoint is another query and leaves earlier output alone. Rows
    flagged ``late`` are not shaped but written as they are to the side output.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"query={query}/micro_batch={batch_id}"
        if "late" in batch.columns:
            batch.persist()
            late = batch.filter("late").drop("late")
            late.write.mode("overwrite").format(fmt).save(f"{late_folder(options)}/{place}")
            shape(batch.filter("NOT late").drop("late")).write.mode("overwrite").format(fmt).save(f"{options.output}/{place}")
            batch.unpersist()
        else:
            shape(batch).write.mode("overwrite").format(fmt).save(f"{options.output}/{place}")

    return _start(rows, options, name).foreachBatch(handle).start()


def late_folder(options: StreamOptions) -> str:
    """Where rows go that come after their group is closed."""
    return options.late or f"{options.output.rstrip('/')}-late"


def metric_stream(
    metrics: DataFrame,
    tick_seconds: int,
    options: StreamOptions,
    job: MetricOptions = MetricOptions(),
    meta: DataFrame | None = None,
    start_ts=None,
    nested: bool = False,
) -> StreamingQuery:
    """Payloads per endpoint and tick; with identity and tags when ``meta`` is given.

    An endpoint's rows of a tick are held until the watermark has passed the tick's end,
    whichever micro-batches they come in. ``parts`` is the number of its payloads. ``nested``
    payloads (which need ``meta``) have the OTLP shape of the batch export.
    """
    routed = with_tie(route_endpoints(metrics)).withColumn("tick", tick_of(F.col("ts"), tick_seconds))
    closes = f"unix_millis(tick) + {tick_seconds * 1000 - 1}"
    whole = closed_groups(routed, ["endpoint_id", "tick"], "ts", closes, options.delay, Held(), options.end)

    def shape(batch: DataFrame) -> DataFrame:
        slices = F.unix_seconds("ts")
        if meta is None:
            keys = ["host_id", "kind", "endpoint_id", "tick"]
            return with_parts(assemble_payloads(batch, keys, METRIC_ORDER, job.max_points, slices))
        start = F.lit(start_ts).cast("timestamp")
        payloads = with_parts(metric_payloads(batch, meta, METRIC_ORDER, start, job.max_points, slices, job.product))
        return otlp_metrics(payloads, job.compat) if nested else payloads

    return write_batches(whole, shape, options, "fleetlens_metrics")


def with_parts(payloads: DataFrame) -> DataFrame:
    """Add ``parts``, the number of payloads of the endpoint and tick."""
    counted = payloads.groupBy("endpoint_id", "tick").agg(F.count("*").alias("parts"))
    return payloads.join(counted, ["endpoint_id", "tick"])


def log_stream(logs: DataFrame, options: StreamOptions) -> StreamingQuery:
    """Flat log rows, appended as they come."""
    return write_rows(logs, options, "fleetlens_logs")


def log_export_stream(
    logs: DataFrame,
    meta: DataFrame,
    tick_seconds: int,
    options: StreamOptions,
    job: LogOptions = LogOptions(),
    order: tuple[str, ...] = ("ts", "tie"),
) -> StreamingQuery:
    """OTLP-shaped log batches per host, source and tick, as the batch export makes them.

    The entries of a tick are held until it is complete. ``order`` must be total within a
    host and source; ``tie`` is added where the rows have no such column.
    """
    rows = logs.withColumn("tick", tick_of(F.col("ts"), tick_seconds))
    if "tie" not in rows.columns:
        rows = rows.withColumn("tie", F.xxhash64("level", "message", "category", "pid"))
    keys = ["host_id", "source", "tick"]
    closes = f"unix_millis(tick) + {tick_seconds * 1000 - 1}"
    whole = closed_groups(rows, keys, "ts", closes, options.delay, Held(), options.end)

    def shape(batch: DataFrame) -> DataFrame:
        slices = F.unix_seconds("ts")
        return otlp_logs(log_payloads(batch, meta, keys, list(order), job.batch_size, slices, job.product), job.compat)

    return write_batches(whole, shape, options, "fleetlens_log_export")


def rate_stream(
    samples: DataFrame, series: str, options: StreamOptions, compat: bool = False, ttl_ms: int | None = None
) -> StreamingQuery:
    return write_rows(stream_rates(samples, series, compat, ttl_ms), options, "fleetlens_rates")


def process_stream(
    processes: DataFrame,
    options: StreamOptions,
    job: ProcessOptions = ProcessOptions(),
    meta: DataFrame | None = None,
) -> StreamingQuery:
    """Heaviest processes per host and snapshot as payloads.

    One payload per host and snapshot: a list of the candidates, bounded by the top-N, is
    held until the watermark has passed the snapshot.
    """
    measures = ("cpu_percent",) if job.compat else ("cpu_percent", "mem_percent")
    top = HeldTop(measures, "pid", 2 * job.top_n if job.compat else job.top_n)
    whole = closed_groups(
        processes, SNAPSHOT, "snapshot_ts", "unix_millis(snapshot_ts)", options.delay, top, options.end
    )

    def shape(batch: DataFrame) -> DataFrame:
        payloads = process_payloads(top_processes(batch, job.top_n, job.compat))
        return payloads if meta is None else identified(attach_meta(payloads, meta))

    return write_batches(whole, shape, options, "fleetlens_processes")


def rollup_stream(metrics: DataFrame, interval_seconds: int, options: StreamOptions) -> StreamingQuery:
    """Statistic sets per series and interval, once each interval is complete; late sets to the side output."""
    sets = rolled(metrics, interval_seconds, options.delay, options.end)
    return write_batches(sets, lambda batch: batch, options, "fleetlens_rollup")


def start_exports(
    spark: SparkSession,
    captures: dict,
    meta: DataFrame,
    start_ts,
    folder: str,
    metrics: MetricOptions = MetricOptions(),
    logs: LogOptions = LogOptions(),
    processes: ProcessOptions = ProcessOptions(),
    tick_seconds: tuple[int, int] = (60, 30),
    once: bool = False,
    **stream,
) -> dict[str, StreamingQuery]:
    """The three exports as streams over captures that files are added to.

    Each runs at the interval of its options, or over what is there and then ends
    (``once``), with a checkpoint of its own below ``folder``; more ``StreamOptions`` can be
    named. ``captures`` is as for the batch jobs, with ``processes`` among its tables or files.
    """

    def paced(name: str, interval: str) -> StreamOptions:
        trigger = {"availableNow": True} if once else {"processingTime": interval}
        return StreamOptions(f"{folder}/{name}", f"{folder}/checkpoints/{name}", trigger, **stream)

    limit = stream.get("max_files_per_trigger")
    reading = {**captures, "stream": True, **({"max_files_per_trigger": limit} if limit else {})}
    reading["containers"] = {"compat": metrics.compat, **captures.get("containers", {})}
    for name, values in log_settings(logs).items():
        reading[name] = {**values, **captures.get(name, {})}
    reading["channels"] = (list(logs.channels), list(logs.exclude_channels), logs.collect_all)
    points = metric_registry().collect(spark, metrics.sources, reading)
    entries = log_registry().collect(spark, logs.sources, reading)
    table = process_rows(read_capture(spark, reading, "processes", RAW_PROCESS))
    return {
        "metrics": metric_stream(points, tick_seconds[0], paced("metrics", metrics.interval), metrics, meta, start_ts, True),
        "logs": log_export_stream(entries, meta, tick_seconds[1], paced("logs", logs.interval), logs),
        "processes": process_stream(table, paced("processes", processes.interval), processes, meta),
    }
