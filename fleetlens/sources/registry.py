"""Named sources: select by name, skip the unknown, union the rest."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators.channels import select_channels
from fleetlens.sources import containers, eventlog, host, journal, raw, syslog

log = logging.getLogger(__name__)

Builder = Callable[[SparkSession, dict], DataFrame]


class Registry:
    """Source plug-ins that all yield one record shape.

    A plug-in is a function ``(spark, options) -> DataFrame``; it may return a batch or
    a streaming frame.
    """

    def __init__(self, columns: list[str]) -> None:
        self.columns = columns
        self._builders: dict[str, tuple[Builder, str | None]] = {}

    def register(self, name: str, builder: Builder, os: str | None = None) -> None:
        """Add a source; ``os`` restricts it to hosts of that system."""
        self._builders[name] = (builder, os)

    def select(self, names: Iterable[str], os: str = "linux") -> dict[str, Builder]:
        """Builders in first-named order; repeated names collapse."""
        chosen: dict[str, Builder] = {}
        for name in names:
            entry = self._builders.get(name)
            if entry is None:
                log.warning("unknown source %s (skipping)", name)
            elif entry[1] not in (None, os):
                log.warning("source %s needs %s (skipping)", name, entry[1])
            else:
                chosen[name] = entry[0]
        return chosen

    def collect(
        self, spark: SparkSession, names: Iterable[str], options: dict, os: str = "linux"
    ) -> DataFrame:
        """Union of the named sources; one that cannot be built raises its error."""
        chosen = self.select(names, os).values()
        return self._union([builder(spark, options).select(*self.columns) for builder in chosen])

    def collect_available(
        self, spark: SparkSession, names: Iterable[str], options: dict, os: str = "linux"
    ) -> tuple[DataFrame, dict[str, Exception]]:
        """Union of the sources that can be built, and the errors of the others by name."""
        frames, failed = [], {}
        for name, builder in self.select(names, os).items():
            try:
                frames.append(builder(spark, options).select(*self.columns))
            except Exception as error:  # reported to the caller
                log.error("source %s failed: %s", name, error)
                failed[name] = error
        return self._union(frames), failed

    def _union(self, frames: list[DataFrame]) -> DataFrame:
        if not frames:
            raise ValueError("no usable source among the named ones")
        return reduce(DataFrame.unionByName, frames)


def read_capture(spark: SparkSession, options: dict, name: str, schema: str) -> DataFrame:
    """A captured table: given as a frame, or read from ``path/name``.

    ``format`` is ``json`` or ``parquet`` for captures in our own columns, ``raw`` for what
    the journal, the container runtimes and the auth log write themselves (see
    ``sources.raw``); ``stream=True`` reads it as a stream.
    """
    given = options.get("tables", {}).get(name)
    if given is not None:
        return given
    reader = spark.readStream if options.get("stream") else spark.read
    if options.get("max_files_per_trigger") and options.get("stream"):
        reader = reader.option("maxFilesPerTrigger", options["max_files_per_trigger"])
    fmt, path = options.get("format", "json"), f"{options['path'].rstrip('/')}/{name}"
    if fmt == "raw" and name == "syslog":
        lines = reader.format("text").option("recursiveFileLookup", "true").load(path)
        return raw.auth_lines(lines.select("value", F.col("_metadata.file_path").alias("file")), options["ref_ts"])
    if fmt == "raw" and name in raw.RAW:
        return raw.RAW[name](reader.format("text").load(path))
    return reader.schema(schema).format("json" if fmt == "raw" else fmt).load(path)


def _one(name: str, schema, make) -> Builder:
    return lambda spark, options: make(read_capture(spark, options, name, schema))


def _three(runtime: str, list_schema, stats_schema, inspect_schema, make) -> Builder:
    def build(spark: SparkSession, options: dict) -> DataFrame:
        tables = [
            read_capture(spark, options, f"{runtime}_{part}", schema)
            for part, schema in (
                ("list", list_schema),
                ("stats", stats_schema),
                ("inspect", inspect_schema),
            )
        ]
        return make(*tables, **options.get("containers", {}))

    return build


def metric_registry() -> Registry:
    registry = Registry(schemas.METRIC_COLUMNS)
    registry.register("cpu", _one("host_cpu", schemas.RAW_HOST_CPU, host.cpu_metrics))
    registry.register("mem", _one("host_mem", schemas.RAW_HOST_MEM, host.mem_metrics))
    registry.register("disk", _one("host_disk", schemas.RAW_HOST_DISK, host.disk_metrics))
    registry.register("host", _one("host_info", schemas.RAW_HOST_INFO, host.host_metrics))
    registry.register("net", _one("host_net", schemas.RAW_HOST_NET, host.net_metrics))
    registry.register(
        "docker",
        _three(
            "docker",
            schemas.RAW_DOCKER_LIST,
            schemas.RAW_DOCKER_STATS,
            schemas.RAW_DOCKER_INSPECT,
            containers.docker_metrics,
        ),
    )
    registry.register(
        "podman",
        _three(
            "podman",
            schemas.RAW_PODMAN_LIST,
            schemas.RAW_PODMAN_STATS,
            schemas.RAW_PODMAN_INSPECT,
            containers.podman_metrics,
        ),
    )
    return registry


def log_registry() -> Registry:
    registry = Registry(schemas.LOG_COLUMNS)

    def journal_source(spark: SparkSession, options: dict) -> DataFrame:
        records = read_capture(spark, options, "journal", schemas.RAW_JOURNAL)
        return journal.journal_logs(records, options.get("users"), **options.get("journal", {}))

    def auth_source(spark: SparkSession, options: dict) -> DataFrame:
        lines = read_capture(spark, options, "syslog", schemas.RAW_SYSLOG)
        return syslog.auth_logs(lines, **options.get("syslog", {}))

    def event_source(spark: SparkSession, options: dict) -> DataFrame:
        events = read_capture(spark, options, "events_xml", schemas.RAW_EVENT_XML)
        if "channels" in options:
            include, exclude, collect_all = options["channels"]
            events = select_channels(events, include, exclude, collect_all)
        return eventlog.event_logs(events, **options.get("events_xml", {}))

    registry.register("journald", journal_source, os="linux")
    registry.register("security", auth_source, os="linux")
    registry.register("eventviewer", event_source, os="windows")
    return registry
