"""Captures as their programs write them, to the columns that the sources read.

A journal export is a line of JSON per entry. A field is a string, null when it was too
long, an array of byte values when it is no text, or a list when the entry has it more
than once; it is parsed as a variant and each form is brought to one string. Container
captures are lines of ``{"host_id", "ts", "body"}`` whose body is what the runtime's API
returned. Auth logs are plain text below a folder of the host.

A line that is no JSON gives no row, and what a line lacks is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import JOURNAL_FIELDS, ddl
from fleetlens.sources.syslog import AUTH_LOG_PATHS

# --- journal ------------------------------------------------------------------


def field_text(name: str, entry: str = "__entry") -> Column:
    """One journal field of a variant as text: of a list the last value, of bytes the text they spell.

    Only where the text form begins like an array is the shape looked at.
    """
    path = f"$['{name}']"
    text = F.try_variant_get(entry, path, "string")
    shape = F.schema_of_variant(F.try_variant_get(entry, path, "variant"))
    numbers = F.try_variant_get(entry, path, "array<int>")
    digits = F.array_join(F.transform(numbers, lambda n: F.lpad(F.hex(n.bitwiseAND(255)), 2, "0")), "")
    spelled = F.make_valid_utf8(F.unhex(digits).cast("string"))
    last = F.try_element_at(F.try_variant_get(entry, path, "array<string>"), F.lit(-1))
    return (
        F.when(~text.startswith("["), text)
        .when(shape == "ARRAY<BIGINT>", spelled)
        .when(shape.startswith("ARRAY<"), last)
        .otherwise(text)
    )


def journal_records(lines: DataFrame) -> DataFrame:
    """Columns of a journal capture from lines of ``value``; the host is the one that the entry names."""
    parsed = lines.select(F.try_parse_json("value").alias("__entry")).filter("__entry IS NOT NULL")
    realtime = F.try_variant_get("__entry", "$['__REALTIME_TIMESTAMP']", "bigint")
    fields = parsed.select(realtime.alias("realtime_us"), *[field_text(f).alias(f) for f in JOURNAL_FIELDS])
    return fields.select(F.col("_HOSTNAME").alias("host_id"), "*")


# --- containers ---------------------------------------------------------------

# The members of the runtimes' API objects that are read.
_LISTED = "Id: string, Names: array<string>, Image: string, State: string, Labels: map<string,string>, Mounts: array<string>"
DOCKER_LIST = ddl(f"array<struct<{_LISTED}, Created: bigint>>")
DOCKER_STATS = ddl(
    "struct<id: string, read: string, "
    "cpu_stats: struct<cpu_usage: struct<total_usage: u64, percpu_usage: array<u64>>, system_cpu_usage: u64, "
    "online_cpus: int, throttling_data: struct<periods: u64, throttled_periods: u64, throttled_time: u64>>, "
    "memory_stats: struct<usage: u64, limit: u64, max_usage: u64, stats: map<string,u64>>, "
    "networks: map<string, struct<rx_bytes: u64, tx_bytes: u64, rx_packets: u64, tx_packets: u64, "
    "rx_errors: u64, tx_errors: u64, rx_dropped: u64, tx_dropped: u64>>, "
    "blkio_stats: struct<io_service_bytes_recursive: array<struct<major: int, minor: int, op: string, value: u64>>>, "
    "pids_stats: struct<current: u64>>"
)
DOCKER_INSPECT = "struct<Id: string, State: struct<Health: struct<Status: string>>>"
PODMAN_LIST = f"array<struct<{_LISTED}, Ports: array<struct<PrivatePort: int, PublicPort: int, Type: string>>>>"
PODMAN_STATS = ddl(
    "struct<id: string, read: string, "
    "cpu_stats: struct<cpu_usage: struct<total_usage: u64, usage_in_kernelmode: u64, usage_in_usermode: u64>, "
    "system_cpu_usage: u64, online_cpus: int>, memory_stats: struct<usage_bytes: u64, limit_bytes: u64>, "
    "networks: map<string, struct<rx_bytes: u64, tx_bytes: u64>>>"
)
PODMAN_INSPECT = "struct<Id: string, State: struct<StartedAt: string>>"


def _bodies(lines: DataFrame, body: str) -> DataFrame:
    """(host_id, ts, body) of capture lines."""
    envelope = F.from_json("value", f"host_id string, ts timestamp, body {body}")
    return lines.select(envelope.alias("e")).filter("e.body IS NOT NULL").select("e.*")


def _listed(lines: DataFrame, body: str, more: dict[str, Column]) -> DataFrame:
    rows = _bodies(lines, body).select("host_id", "ts", F.explode("body").alias("c"))
    same = {"id": "Id", "names": "Names", "image": "Image", "state": "State", "labels": "Labels", "mounts": "Mounts"}
    return rows.select("host_id", "ts", *[F.col(f"c.{v}").alias(k) for k, v in same.items()], *[v.alias(k) for k, v in more.items()])


def docker_list(lines: DataFrame) -> DataFrame:
    return _listed(lines, DOCKER_LIST, {"created": F.col("c.Created")})


def podman_list(lines: DataFrame) -> DataFrame:
    ports = F.transform(
        "c.Ports",
        lambda p: F.struct(
            p["PrivatePort"].alias("private_port"), p["PublicPort"].alias("public_port"), p["Type"].alias("type")
        ),
    )
    return _listed(lines, PODMAN_LIST, {"ports": ports})


def _sample_time() -> Column:
    """When the sample was taken; the runtime's own time where the capture has none."""
    return F.coalesce("ts", F.col("body.read").try_cast("timestamp"))


def docker_stats(lines: DataFrame) -> DataFrame:
    b, cpu, mem = F.col("body"), F.col("body.cpu_stats"), F.col("body.memory_stats")
    return _bodies(lines, DOCKER_STATS).select(
        "host_id",
        _sample_time().alias("ts"),
        b["id"].alias("id"),
        F.struct(
            cpu["cpu_usage"]["total_usage"].alias("total"),
            cpu["system_cpu_usage"].alias("system"),
            cpu["online_cpus"].alias("online"),
            cpu["cpu_usage"]["percpu_usage"].alias("percpu"),
            cpu["throttling_data"].alias("throttling"),
        ).alias("cpu"),
        F.struct(
            mem["usage"].alias("usage"),
            mem["limit"].alias("limit"),
            mem["max_usage"].alias("max"),
            mem["stats"].alias("stats"),
        ).alias("memory"),
        b["networks"].alias("networks"),
        b["blkio_stats"]["io_service_bytes_recursive"].alias("blkio"),
        b["pids_stats"]["current"].alias("pids"),
    )


def podman_stats(lines: DataFrame) -> DataFrame:
    cpu, mem = F.col("body.cpu_stats"), F.col("body.memory_stats")
    return _bodies(lines, PODMAN_STATS).select(
        "host_id",
        _sample_time().alias("ts"),
        F.col("body.id").alias("id"),
        F.struct(
            cpu["cpu_usage"]["total_usage"].alias("total"),
            cpu["cpu_usage"]["usage_in_kernelmode"].alias("kernel"),
            cpu["cpu_usage"]["usage_in_usermode"].alias("user"),
            cpu["system_cpu_usage"].alias("system"),
            cpu["online_cpus"].alias("online"),
        ).alias("cpu"),
        F.struct(mem["usage_bytes"].alias("usage"), mem["limit_bytes"].alias("limit")).alias("memory"),
        F.col("body.networks").alias("networks"),
    )


def docker_inspect(lines: DataFrame) -> DataFrame:
    rows = _bodies(lines, DOCKER_INSPECT)
    return rows.select("host_id", "ts", F.col("body.Id").alias("id"), F.col("body.State.Health.Status").alias("health_status"))


def podman_inspect(lines: DataFrame) -> DataFrame:
    rows = _bodies(lines, PODMAN_INSPECT)
    return rows.select("host_id", "ts", F.col("body.Id").alias("id"), F.col("body.State.StartedAt").alias("started_at"))


# --- auth logs ----------------------------------------------------------------


def auth_lines(lines: DataFrame, ref_ts) -> DataFrame:
    """Lines below ``<host>/<file>`` with their host and file; of a host's auth logs the first one known counts.

    ``lines`` has ``value`` and ``file``, the path it was read from. ``ref_ts`` is the time that
    the year-less times of the lines are read against.
    """
    base = F.substring_index("file", "/", -1)
    named = lines.select(
        F.substring_index(F.substring_index("file", "/", -2), "/", 1).alias("host_id"),
        "value",
        F.coalesce(*[F.when(base == p.rsplit("/", 1)[-1], F.lit(p)) for p in AUTH_LOG_PATHS]).alias("path"),
        F.lit(ref_ts).cast("timestamp").alias("ref_ts"),
    ).filter("path IS NOT NULL")
    for n, later in enumerate(AUTH_LOG_PATHS[1:], 1):
        # Hosts that have an earlier one: a row per host, so the join is on few rows.
        better = named.filter(F.col("path").isin(AUTH_LOG_PATHS[:n])).select("host_id", F.lit(later).alias("path")).distinct()
        named = named.join(better, ["host_id", "path"], "left_anti")
    return named.select("host_id", "value", "path", "ref_ts")


RAW = {
    "journal": journal_records,
    "docker_list": docker_list,
    "docker_stats": docker_stats,
    "docker_inspect": docker_inspect,
    "podman_list": podman_list,
    "podman_stats": podman_stats,
    "podman_inspect": podman_inspect,
}
