"""Container captures (list, stats, inspect) to metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import drop_null, empty_map, literal_map, merge_maps, prefix_keys
from fleetlens.functions.points import explode_points, flat_points_of, point, points_of, with_dims
from fleetlens.functions.text import (
    format_ports,
    image_version,
    normalize_key,
    null_if_empty,
    short_id,
    strip_slash,
)
from fleetlens.functions.timestamps import from_seconds, rfc3339, seconds_between, slice_of
from fleetlens.operators.ordered import with_latest
from fleetlens.operators.rates import interface_total, rate_columns

MAX_UPTIME_SECONDS = 1e6

# Fixed values: (metric, counter field, unit) of a container's network interface.
INTERFACE_COUNTERS = [
    ("net_rx_bytes", "rx_bytes", "bytes"),
    ("net_tx_bytes", "tx_bytes", "bytes"),
    ("net_rx_packets", "rx_packets", "count"),
    ("net_tx_packets", "tx_packets", "count"),
    ("net_rx_errors", "rx_errors", "count"),
    ("net_tx_errors", "tx_errors", "count"),
    ("net_rx_dropped", "rx_dropped", "count"),
    ("net_tx_dropped", "tx_dropped", "count"),
]

# Fixed values: (metric, type, unit) that one runtime does not report and sets to 0.
PODMAN_ZEROS = [
    ("cpu_throttle_periods", "counter", "count"),
    ("cpu_throttled_periods", "counter", "count"),
    ("cpu_throttled_time", "counter", "nanoseconds"),
    ("pids_current", "gauge", "count"),
    ("blkio_service_bytes", "counter", "bytes"),
]


ON = ["host_id", "id"]


def _timed(table: DataFrame) -> DataFrame:
    """A capture without times holds from the beginning: null sorts first."""
    return table if "ts" in table.columns else table.withColumn("ts", F.lit(None).cast("timestamp"))


def _slices(seconds: int | None):
    return None if seconds is None else lambda ts: slice_of(ts, seconds)


def join_captures(
    containers: DataFrame,
    stats: DataFrame,
    inspect: DataFrame,
    on: list[str] | None = None,
    slice_seconds: int | None = 3600,
) -> DataFrame:
    """Stats with the list and inspect record of the same time, or the latest before it.

    A container that was not listed by then is skipped; a missing inspect record is
    tolerated. A list row counts until the container's next one, so the number of rows
    is that of the stats with an earlier list row, however often the list was taken.
    """
    on = on or ON
    others = {"listed": _timed(containers), "inspected": _timed(inspect)}
    joined = with_latest(stats, others, on, "ts", _slices(slice_seconds)).filter("listed IS NOT NULL")
    fields = [
        F.col(name)[c].alias(c) for name, other in others.items() for c in other.columns if c not in (*on, "ts")
    ]
    return joined.select(*stats.columns, *fields)


def is_running(state: Column) -> Column:
    return F.lower(state) == "running"


def uptime_seconds(state: Column, started: Column, now: Column) -> Column:
    """Seconds since start of a running container; 0 when negative or above 1e6."""
    seconds = seconds_between(now, started)
    usable = is_running(state) & started.isNotNull() & seconds.between(0, MAX_UPTIME_SECONDS)
    return F.when(usable, seconds).otherwise(0.0)


def container_dims(runtime: str, extra: dict[str, Column]) -> Column:
    """Dimensions that all rows of a container share; null ones are left out."""
    fixed = literal_map(
        {
            "container_id": short_id(F.col("id")),
            "name": strip_slash(F.get("names", F.lit(0))),
            "image": F.col("image"),
            "status": F.col("state"),
            "runtime": runtime,
            "mount_count": F.greatest(F.size("mounts"), F.lit(0)).cast("string"),
            "container_version": image_version(F.col("image")),
        }
        | extra
    )
    return F.map_concat(drop_null(fixed), prefix_keys(F.col("labels"), "label."))


def _interfaces() -> Column:
    """Network interfaces with the container's dimensions plus their own name."""
    return with_dims(
        F.map_entries("networks"),
        lambda e: merge_maps(F.col("dims"), literal_map({"interface": e["key"]})),
    )


def _zero(value: Column) -> Column:
    """A counter the capture leaves out counts as 0."""
    return F.coalesce(value.cast("double"), F.lit(0.0))


COUNTERS = ["ts", "cpu_total", "cpu_system", "rx", "tx"]


def _sampled(
    stats: DataFrame,
    listed: DataFrame,
    inspected: DataFrame,
    extra: Column,
    on: list[str],
    slice_seconds: int | None,
    compat: bool,
) -> DataFrame:
    """Stats with rates, and the ``dims``, ``state`` and ``started`` that hold at their time.

    One pass over one ordered series: the previous sample, the list row and the inspect
    row all come from it. Dimensions are built once per list row; ``extra`` are those that
    need the inspect row.
    """
    prepared = stats.withColumns(
        {
            "cpu_total": F.col("cpu")["total"],
            "cpu_system": F.col("cpu")["system"],
            "online": F.coalesce(F.col("cpu")["online"], F.lit(0)),
            "rx": interface_total(F.col("networks"), "rx_bytes"),
            "tx": interface_total(F.col("networks"), "tx_bytes"),
        }
    ).withColumn("tie", F.xxhash64("cpu_total", "cpu_system", "rx", "tx"))
    others = {"listed": listed, "inspected": inspected}
    series = with_latest(prepared, others, on, "ts", _slices(slice_seconds), "tie", ("prev", COUNTERS))
    known = series.filter("listed IS NOT NULL").withColumns(
        {
            "dims": merge_maps(F.col("listed.dims"), extra),
            "state": F.col("listed.state"),
            "started": F.coalesce("inspected.started", "listed.started"),
        }
    )
    return rate_columns(known, compat).withColumn("interfaces", _interfaces())


def _lifecycle(sub: str, started: Column, dims: Column) -> Column:
    return F.array(
        point(
            sub, "uptime_seconds", uptime_seconds(F.col("state"), started, F.col("ts")),
            "gauge", "seconds", dims,
        ),
        point(
            sub, "running", F.coalesce(is_running(F.col("state")), F.lit(False)).cast("double"),
            "gauge", "bool", dims,
        ),
    )


def _rates(sub: str, dims: Column) -> Column:
    return F.array(
        point(sub, "cpu_percent", F.col("cpu_percent"), "gauge", "percent", dims),
        point(sub, "net_rx_rate_bytes", F.col("rx_rate"), "gauge", "bytes/s", dims),
        point(sub, "net_tx_rate_bytes", F.col("tx_rate"), "gauge", "bytes/s", dims),
    )


def _totals(sub: str, dims: Column) -> Column:
    return F.array(
        point(sub, "net_rx_bytes_total", F.col("rx"), "counter", "bytes", dims),
        point(sub, "net_tx_bytes_total", F.col("tx"), "counter", "bytes", dims),
    )


def docker_metrics(
    containers: DataFrame,
    stats: DataFrame,
    inspect: DataFrame,
    on: list[str] | None = None,
    slice_seconds: int | None = 3600,
    compat: bool = False,
) -> DataFrame:
    """All rows of a Docker capture.

    ``on`` names one container's series, in all three tables. List and inspect rows hold
    from their ``ts`` on; tables without that column hold throughout.
    """
    on = on or ON
    listed = _timed(containers).select(
        *on,
        "ts",
        container_dims("docker", {}).alias("dims"),
        "state",
        F.when(F.col("created") > 0, from_seconds(F.col("created"))).alias("started"),
    )
    inspected = _timed(inspect).select(
        *on, "ts", "health_status", F.lit(None).cast("timestamp").alias("started")
    )
    health = drop_null(literal_map({"health_status": F.col("inspected.health_status")}))
    joined = _sampled(stats, listed, inspected, health, on, slice_seconds, compat)
    dims = F.col("dims")
    cpu, mem = F.col("cpu"), F.col("memory")

    def counter(name: str, value: Column, unit: str, extra: dict | None = None) -> Column:
        d = merge_maps(dims, literal_map(extra)) if extra else dims
        return point("Docker", name, _zero(value), "counter", unit, d)

    def gauge(name: str | Column, value: Column, unit: str) -> Column:
        return point("Docker", name, _zero(value), "gauge", unit, dims)

    throttle = cpu["throttling"]
    fixed = F.array(
        counter("cpu_total_usage", cpu["total"], "nanoseconds"),
        counter("cpu_system_usage", cpu["system"], "nanoseconds"),
        gauge("cpu_online_cpus", cpu["online"], "count"),
        counter("cpu_throttle_periods", throttle["periods"], "count"),
        counter("cpu_throttled_periods", throttle["throttled_periods"], "count"),
        counter("cpu_throttled_time", throttle["throttled_time"], "nanoseconds"),
        gauge("mem_usage_bytes", mem["usage"], "bytes"),
        gauge("mem_limit_bytes", mem["limit"], "bytes"),
        gauge("mem_max_usage_bytes", mem["max"], "bytes"),
        gauge("pids_current", F.col("pids"), "count"),
    )
    per_cpu = points_of(
        cpu["percpu"],
        lambda v, i: counter(
            "cpu_percpu_usage", v, "nanoseconds", {"cpu": F.concat(F.lit("cpu"), i.cast("string"))}
        ),
    )
    mem_stats = points_of(
        F.map_entries(mem["stats"]),
        lambda e: gauge(F.concat(F.lit("mem_"), normalize_key(e["key"])), e["value"], "bytes"),
    )
    interfaces = flat_points_of(
        F.col("interfaces"),
        lambda e: F.array(
            *[
                point("Docker", name, _zero(e["item"]["value"][field]), "counter", unit, e["dims"])
                for name, field, unit in INTERFACE_COUNTERS
            ]
        ),
    )
    blkio = points_of(
        F.col("blkio"),
        lambda b: counter(
            "blkio_service_bytes",
            b["value"],
            "bytes",
            {
                "op": F.lower(b["op"]),
                "device": F.concat_ws(":", b["major"].cast("string"), b["minor"].cast("string")),
            },
        ),
    )
    groups = [
        _lifecycle("Docker", F.col("started"), dims),
        fixed,
        per_cpu,
        mem_stats,
        interfaces,
        _totals("Docker", dims),
        blkio,
        _rates("Docker", dims),
    ]
    return explode_points(joined, "Container", groups)


def podman_metrics(
    containers: DataFrame,
    stats: DataFrame,
    inspect: DataFrame,
    on: list[str] | None = None,
    slice_seconds: int | None = 3600,
    compat: bool = False,
) -> DataFrame:
    """All rows of a Podman capture; what it does not report is a constant 0."""
    on = on or ON
    listed = _timed(containers).select(
        *on,
        "ts",
        container_dims("podman", {"ports": null_if_empty(format_ports(F.col("ports")))}).alias("dims"),
        "state",
        F.lit(None).cast("timestamp").alias("started"),
    )
    inspected = _timed(inspect).select(*on, "ts", rfc3339(F.col("started_at")).alias("started"))
    joined = _sampled(stats, listed, inspected, empty_map(), on, slice_seconds, compat)
    dims, cpu, mem = F.col("dims"), F.col("cpu"), F.col("memory")
    zero = F.lit(0.0)
    fixed = F.array(
        point("Podman", "cpu_total_usage", _zero(cpu["total"]), "counter", "nanoseconds", dims),
        point("Podman", "cpu_kernelmode", _zero(cpu["kernel"]), "counter", "nanoseconds", dims),
        point("Podman", "cpu_usermode", _zero(cpu["user"]), "counter", "nanoseconds", dims),
        point("Podman", "cpu_online_cpus", _zero(cpu["online"]), "gauge", "count", dims),
        point("Podman", "cpu_system_usage", _zero(cpu["system"]), "counter", "nanoseconds", dims),
        point("Podman", "mem_usage_bytes", _zero(mem["usage"]), "gauge", "bytes", dims),
        point("Podman", "mem_limit_bytes", _zero(mem["limit"]), "gauge", "bytes", dims),
        point("Podman", "mem_max_usage_bytes", zero, "gauge", "bytes", dims),
        *[point("Podman", n, zero, kind, unit, dims) for n, kind, unit in PODMAN_ZEROS],
    )
    reported = {"rx_bytes", "tx_bytes"}
    interfaces = flat_points_of(
        F.col("interfaces"),
        lambda e: F.array(
            *[
                point(
                    "Podman",
                    name,
                    _zero(e["item"]["value"][field]) if field in reported else zero,
                    "counter",
                    unit,
                    e["dims"],
                )
                for name, field, unit in INTERFACE_COUNTERS
            ]
        ),
    )
    groups = [
        _lifecycle("Podman", F.col("started"), dims),
        fixed,
        interfaces,
        _totals("Podman", dims),
        _rates("Podman", dims),
    ]
    return explode_points(joined, "Container", groups)
