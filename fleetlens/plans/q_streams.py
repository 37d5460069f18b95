"""Queries that run a stream over a whole table and read back what it wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timestamps import from_micros
from fleetlens.options import MetricOptions, StreamOptions
from fleetlens.plans import adapters as A
from fleetlens.plans import q_endpoints, q_logs, q_metrics, q_processes
from fleetlens.plans import sqltext as S
from fleetlens.plans.catalog import query
from fleetlens.session import work_folder
from fleetlens.sources.processes import process_rows
from fleetlens.sources.registry import log_registry
from fleetlens.sources.syslog import AUTH_LOG_PATHS, auth_logs
from fleetlens.streaming import jobs
from fleetlens.streaming.follow import follow
from fleetlens.streaming.stateful import stream_rates


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files.

    The path is written as a glob, because a stream takes a plain path for a folder and
    a table may be a single file.
    """
    schema = A.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_instant(stream_table(spark, sf_dir, "events"))


def new_options(spark: SparkSession, label: str, **more) -> StreamOptions:
    folder = work_folder(spark, label)
    return StreamOptions(output=f"{folder}/out", checkpoint=f"{folder}/checkpoint", **more)


# Pieces that a table is cut into, rows that a file of a piece has at least where there are several,
# and a row that comes after all others.
FILES = 5
FILE_ROWS = 25_000
END = "2030-01-01 00:00:00"


def cut_stream(rows: DataFrame, piece: Column, ts: str) -> DataFrame:
    """A table as a stream of pieces that arrive one after the other, one for each trigger.

    ``piece`` tells the piece of a row; groups are cut wherever it changes. All pieces with rows
    have the same number of files, one unless the least of them is large: a trigger takes so many.
    The last file has one row, of nulls but for its time, that closes what is open.
    """
    spark = rows.sparkSession
    folder = f"{work_folder(spark, 'cut')}/in"
    sizes = {r[0]: r[1] for r in rows.groupBy(piece.alias("piece")).count().collect()}
    sizes = {k: sizes[k] for k in range(FILES) if sizes.get(k)}
    files = max(1, min(sizes.values(), default=0) // FILE_ROWS)
    for k in sizes:
        # Dealt in turn, no file stays empty: each has rows of any input partition that has so many.
        rows.filter(piece == k).repartition(files).write.mode("append").parquet(folder)
    last = [F.lit(END if c == ts else None).cast(kind).alias(c) for c, kind in rows.dtypes]
    spark.range(1).select(*last).write.mode("append").parquet(folder)
    return jobs.read_files(spark, folder, rows.schema, "parquet", files)


@query(
    "stream_rates",
    f"""WITH {S.SAMPLES}
SELECT cid AS container_id, us, round(cpu_percent, 6) AS cpu_percent, round(rx_rate, 6) AS rx_rate,
  round(tx_rate, 6) AS tx_rate, reset FROM rated""",
)
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates with the previous sample of each container kept as state."""
    options = new_options(spark, "rates")
    samples = A.counter_samples(stream_events(spark, sf_dir))
    jobs.write_rows(stream_rates(samples, "id"), options, "fleetlens_rates_check").awaitTermination()
    return spark.read.parquet(options.output).select(
        F.substring("series", 1, 12).alias("container_id"),
        F.unix_micros("ts").alias("us"),
        *[F.round(c, 6).alias(c) for c in ("cpu_percent", "rx_rate", "tx_rate")],
        "reset",
    )


@query("stream_logs", q_logs.AUTH_SQL)
def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = new_options(spark, "logs")
    rows = auth_logs(A.syslog_lines(stream_events(spark, sf_dir)))
    jobs.log_stream(rows, options).awaitTermination()
    return q_logs.auth_text(spark.read.parquet(options.output))


def host_files(lines: DataFrame, root: str, before: int, rotated: int) -> None:
    """Each host's log as it stands at a time: lines before ``rotated`` are in the file that rotation left.

    A task writes the files of its hosts, line by line and as a whole, so it can run again.
    """

    def write(batches):
        import posixpath

        import pyarrow.fs as pafs

        store, folder = pafs.FileSystem.from_uri(root) if ":" in root else (pafs.LocalFileSystem(), root)
        open_file, out = None, None
        for batch in batches:
            for host, us, value in zip(batch["host_id"], batch["us"], batch["value"]):
                place = posixpath.join(folder, host, "auth.log.1" if us < rotated else "auth.log")
                if place != open_file:
                    if out:
                        out.close()
                    store.create_dir(posixpath.dirname(place))
                    open_file, out = place, store.open_output_stream(place)
                out.write(value.encode() + b"\n")
        if out:
            out.close()
        yield from ()

    in_order = lines.filter(F.col("us") < before).repartition("host_id").sortWithinPartitions("host_id", "us", "event_id")
    in_order.mapInPandas(write, "done int").write.format("noop").mode("overwrite").save()


@query("auth_raw", q_logs.AUTH_SQL)
def auth_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Auth logs as text files below their host's folder, read by the registry."""
    path = work_folder(spark, "auth-raw")
    lines = A.syslog_lines(A.events(spark, sf_dir)).select("event_id", "us", "host_id", "value")
    host_files(lines, f"{path}/syslog", S.EPOCH_US + 400 * 86_400_000_000, 0)
    options = {"path": path, "format": "raw", "ref_ts": from_micros(F.lit(A.REF_US))}
    return q_logs.auth_text(log_registry().collect(spark, ["security"], options))


@query("follow_auth_log", q_logs.AUTH_SQL)
def follow_auth_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs followed through growth, rotation and restarts: each look is a new run of one query."""
    options = new_options(spark, "follow")
    root = f"{work_folder(spark, 'logs')}/hosts"
    lines = A.syslog_lines(A.events(spark, sf_dir)).select("event_id", "us", "host_id", "value")
    day = 86_400_000_000
    for before, rotated in ((9, 0), (17, 0), (23, 17), (400, 17)):
        host_files(lines, root, S.EPOCH_US + before * day, S.EPOCH_US + rotated * day)
        found = follow(spark, root, ["auth.log"], split_bytes=1 << 20)
        raw = found.select("host_id", "value", F.lit(AUTH_LOG_PATHS[1]).alias("path"), from_micros(F.lit(A.REF_US)).alias("ref_ts"))
        jobs.log_stream(auth_logs(raw), options).awaitTermination()
    return q_logs.auth_text(spark.read.parquet(options.output))


@query(
    "stream_metrics",
    f"""WITH {S.APP},
placed AS (
  SELECT *, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY endpoint_id, day_us) AS size
  FROM routed WINDOW w AS (PARTITION BY endpoint_id, day_us ORDER BY us, event_id)
)
SELECT host_id, kind, endpoint_id, day_us AS tick_us, rn // 100 AS part, (max(size) + 99) // 100 AS parts, count(*) AS n,
  string_agg(CAST(us AS VARCHAR), ',' ORDER BY rn) AS times
FROM placed GROUP BY host_id, kind, endpoint_id, day_us, rn // 100""",
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads per endpoint and day from pieces that cut the days, one for each micro-batch."""
    options = new_options(spark, "metrics", delay="7 days", end=END)
    rows = A.app_metrics(A.events(spark, sf_dir))
    # Six days and a bit: the borders fall within days.
    piece = F.least(F.floor((F.unix_micros("ts") - S.EPOCH_US) / (6.1 * 86_400_000_000)), F.lit(FILES - 1))
    jobs.metric_stream(cut_stream(rows, piece, "ts"), 86400, options, MetricOptions(max_points=100)).awaitTermination()
    written = spark.read.parquet(options.output)
    return q_endpoints.payload_text(written).join(
        written.select("endpoint_id", F.unix_micros("tick").alias("tick_us"), "part", "parts"),
        ["endpoint_id", "tick_us", "part"],
    )


@query("stream_processes", q_processes.PAYLOAD_SQL)
def processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One top list per host and snapshot, though each snapshot is cut over all files."""
    options = new_options(spark, "processes", end=END)
    rows = process_rows(A.process_table(A.table(spark, sf_dir, "customer")))
    piece = F.pmod("pid", F.lit(FILES))
    jobs.process_stream(cut_stream(rows, piece, "snapshot_ts"), options).awaitTermination()
    return q_processes.payload_text(spark.read.parquet(options.output))


@query("stream_otlp_logs", q_endpoints.OTLP_LOGS_SQL)
def otlp_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested log export as a stream; one tick holds all entries, as in the batch query."""
    options = new_options(spark, "log-export", delay="1 day", end=END)
    logs = q_endpoints.chat_logs(spark, sf_dir)
    pieces = cut_stream(logs, F.pmod(F.col("conv_id") + F.col("turn"), F.lit(FILES)), "ts")
    hosts = q_endpoints.chat_hosts(spark, sf_dir)
    order = ("ts", "conv_id", "turn")
    jobs.log_export_stream(pieces, hosts, 20 * 365 * 86400, options, order=order).awaitTermination()
    return q_endpoints.nested_log_text(spark.read.parquet(options.output))


@query("stream_rollup", q_metrics.ROLLUP_SQL)
def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistic sets from pieces that cut the days."""
    options = new_options(spark, "rollup", delay="7 days", end=END)
    rows = A.app_metrics(A.events(spark, sf_dir))
    piece = F.least(F.floor((F.unix_micros("ts") - S.EPOCH_US) / (6.1 * 86_400_000_000)), F.lit(FILES - 1))
    jobs.rollup_stream(cut_stream(rows, piece, "ts"), 86400, options).awaitTermination()
    return q_metrics.rollup_text(spark.read.parquet(options.output))
