"""Queries over host and container captures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.maps import render_map
from fleetlens.functions.text import format_ports, null_if_empty, short_id
from fleetlens.operators.rates import network_totals, sample_rates
from fleetlens.operators.rollup import stat_rollup
from fleetlens.plans import adapters as A
from fleetlens.plans import sqltext as S
from fleetlens.plans.catalog import query
from fleetlens.session import work_folder
from fleetlens.sources import containers, host
from fleetlens.sources.registry import metric_registry


def metric_text(df: DataFrame) -> DataFrame:
    """Metric rows with the dimensions as text, the form the SQL counterparts give."""
    return df.select(
        "host_id",
        F.unix_micros("ts").alias("us"),
        "sub_namespace",
        "name",
        "type",
        "unit",
        F.round("value", 6).alias("value"),
        render_map(F.col("dimensions")).alias("dims"),
    )


CONTAINER_KEYS = ["container_id", "cpu", "device", "interface", "op"]


def container_text(df: DataFrame) -> DataFrame:
    """Container rows with the dimensions that tell them apart as columns, and the number
    of all; ``container_dims`` compares the full maps."""
    dims = F.col("dimensions")
    return df.select(
        F.unix_micros("ts").alias("us"),
        "sub_namespace",
        "name",
        "type",
        "unit",
        F.round("value", 6).alias("value"),
        *[dims[k].alias(k) for k in CONTAINER_KEYS],
        dims["status"].alias("status"),
        F.size(dims).alias("n_dims"),
    )


# --- rates --------------------------------------------------------------------


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = A.counter_samples(A.events(spark, sf_dir))
    return sample_rates(samples, ["id"], ["ts", "event_id"])


@query(
    "top_containers",
    f"""WITH {S.SAMPLES}
SELECT cid AS container_id, count(*) AS samples, round(max(cpu_percent), 6) AS peak_cpu_percent,
  round(max(rx_rate), 6) AS peak_rx_rate, round(max(tx_rate), 6) AS peak_tx_rate
FROM rated GROUP BY cid ORDER BY max(cpu_percent) DESC, cid LIMIT 20""",
)
def top_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CPU share and network rate per container; the 20 with the highest CPU peak."""
    return (
        rated(spark, sf_dir)
        .groupBy(short_id(F.col("id")).alias("container_id"))
        .agg(
            F.count("*").alias("samples"),
            F.max("cpu_percent").alias("peak"),
            F.round(F.max("rx_rate"), 6).alias("peak_rx_rate"),
            F.round(F.max("tx_rate"), 6).alias("peak_tx_rate"),
        )
        .orderBy(F.desc("peak"), "container_id")
        .limit(20)
        .select(
            "container_id",
            "samples",
            F.round("peak", 6).alias("peak_cpu_percent"),
            "peak_rx_rate",
            "peak_tx_rate",
        )
    )


@query(
    "cpu_percent",
    f"""WITH {S.SAMPLES}
SELECT cid AS container_id, event_id, us, round(cpu_percent, 6) AS cpu_percent, reset FROM rated""",
)
def cpu_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(spark, sf_dir).select(
        short_id(F.col("id")).alias("container_id"),
        "event_id",
        "us",
        F.round("cpu_percent", 6).alias("cpu_percent"),
        "reset",
    )


@query(
    "net_rate",
    f"""WITH {S.SAMPLES}
SELECT cid AS container_id, event_id, us, round(rx_rate, 6) AS rx_rate, round(tx_rate, 6) AS tx_rate
FROM rated""",
)
def net_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(spark, sf_dir).select(
        short_id(F.col("id")).alias("container_id"),
        "event_id",
        "us",
        F.round("rx_rate", 6).alias("rx_rate"),
        F.round("tx_rate", 6).alias("tx_rate"),
    )


@query(
    "net_totals",
    f"""WITH {S.SAMPLES}
SELECT cid AS container_id, us, CAST(sum(rx) AS BIGINT) AS rx_total, CAST(sum(tx) AS BIGINT) AS tx_total
FROM counters GROUP BY cid, us""",
)
def net_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    interfaces = A.docker_stats(A.events(spark, sf_dir)).select(
        "id", "us", F.explode("networks").alias("interface", "net")
    )
    flat = interfaces.select("id", "us", "net.rx_bytes", "net.tx_bytes")
    return network_totals(flat, ["id", "us"]).select(
        short_id(F.col("id")).alias("container_id"),
        "us",
        F.col("rx_total").cast("bigint").alias("rx_total"),
        F.col("tx_total").cast("bigint").alias("tx_total"),
    )


ROLLUP_SQL = f"""WITH {S.APP}
SELECT host_id, sub_namespace, name, day_us AS us, dims, CAST(count(*) AS INTEGER) AS sample_count,
  round(sum(value), 4) AS sum, min(value) AS minimum, max(value) AS maximum,
  round(avg(value), 6) AS value
FROM app GROUP BY host_id, sub_namespace, name, day_us, dims"""


@query("stat_rollup", ROLLUP_SQL)
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_text(stat_rollup(A.app_metrics(A.events(spark, sf_dir)), 86400))


def rollup_text(daily: DataFrame) -> DataFrame:
    return daily.select(
        "host_id",
        "sub_namespace",
        "name",
        F.unix_micros("ts").alias("us"),
        render_map(F.col("dimensions")).alias("dims"),
        "stats.sample_count",
        F.round("stats.sum", 4).alias("sum"),
        "stats.minimum",
        "stats.maximum",
        F.round("value", 6).alias("value"),
    )


# --- host captures ------------------------------------------------------------

_PART_US = f"{S.EPOCH_US} + p_partkey * 1000000"
_TIMES = "user system idle nice iowait irq softirq steal guest guest_nice".split()
HOST_CPU_SQL = S.metric_rows(
    "part",
    "p_brand",
    _PART_US,
    [
        ("CPU", "usage_percent", "p_size", "gauge", "percent", "'core=core0;scope=per_core'"),
        ("CPU", "usage_percent", "p_retailprice / 100", "gauge", "percent", "'core=core1;scope=per_core'"),
        ("CPU", "usage_percent", "p_retailprice / 200", "gauge", "percent", "'scope=total'"),
        *[
            ("CPU", f"time_{k}", f"p_partkey + {i}", "counter", "seconds", "'scope=total'")
            for i, k in enumerate(_TIMES)
        ],
        (
            "CPU", "clock_mhz", "p_retailprice", "gauge", "MHz",
            "'cache=' || (p_size * 512) || ';core=core0;family=6;model=' || p_name || ';physical='"
            " || CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END || ';stepping=' || p_size"
            " || ';vendor=' || p_type",
        ),
        ("CPU", "count_logical", "p_size", "gauge", "count", "''"),
        ("CPU", "count_physical", "p_size", "gauge", "count", "''", "p_partkey % 10 <> 0"),
        *[
            ("CPU", f"load_avg_{m}", f"CAST(p_size AS DOUBLE) / {d}", "gauge", "load", "''")
            for m, d in ((1, 10), (5, 20), (15, 40))
        ],
    ],
)


@query("host_cpu", HOST_CPU_SQL)
def host_cpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_text(host.cpu_metrics(A.host_cpu(A.table(spark, sf_dir, "part"))))


_MEM = """(SELECT *, o_orderkey * 1000 + 4096 AS total,
  CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_orderkey * 10 + 100 END AS swap FROM orders) o"""
_MEM_DIMS, _SWAP_DIMS = "'source=physical'", "'source=swap'"
HOST_MEM_SQL = S.metric_rows(
    _MEM,
    "'h' || o_custkey",
    "epoch_us(o_orderdate)",
    [
        ("Memory", "total", "total", "gauge", "bytes", _MEM_DIMS),
        ("Memory", "available", "total // 3", "gauge", "bytes", _MEM_DIMS),
        ("Memory", "used", "total - total // 3", "gauge", "bytes", _MEM_DIMS),
        ("Memory", "used_percent", "o_orderkey % 100", "gauge", "percent", _MEM_DIMS),
        ("Memory", "swap_total", "swap", "gauge", "bytes", _SWAP_DIMS, "swap > 0"),
        ("Memory", "swap_used", "swap - swap // 4", "gauge", "bytes", _SWAP_DIMS, "swap > 0"),
        ("Memory", "swap_free", "swap // 4", "gauge", "bytes", _SWAP_DIMS, "swap > 0"),
        (
            "Memory", "swap_used_percent",
            "CASE WHEN o_orderkey % 3 = 0 THEN CAST(swap - swap // 4 AS DOUBLE) / swap * 100 ELSE 12.5 END",
            "gauge", "percent", _SWAP_DIMS, "swap > 0",
        ),
    ],
)


@query("host_mem", HOST_MEM_SQL)
def host_mem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_text(host.mem_metrics(A.host_mem(A.table(spark, sf_dir, "orders"))))


def _disk_sql() -> str:
    windows = "p_partkey % 5 = 0"
    usage = {
        "total": ("p_partkey * 100", "bytes"),
        "used": ("p_partkey * 40", "bytes"),
        "free": ("p_partkey * 60", "bytes"),
        "used_percent": ("40", "percent"),
        "inodes_total": ("p_partkey * 10", "count"),
        "inodes_used": ("p_partkey", "count"),
        "inodes_free": ("p_partkey * 9", "count"),
        "inodes_used_percent": ("p_size", "percent"),
    }
    mounts = [
        ("'device=/dev/sda1;fstype=ext4;mountpoint=/data' || p_size", "p_partkey % 7 <> 0"),
        (
            "'device=dev;fstype=' || CASE WHEN p_size % 2 = 0 THEN 'tmpfs' ELSE 'xfs' END"
            " || ';mountpoint=' || CASE p_size % 3 WHEN 0 THEN '/run/x' WHEN 1 THEN '/proc/y' ELSE '/' END",
            f"{windows} OR (p_size % 3 = 2 AND p_size % 2 = 1)",
        ),
        (
            "'device=PHYS' || p_size || ';fstype=' || CASE WHEN p_size % 2 = 0 THEN '' ELSE 'ntfs' END"
            " || ';mountpoint=C:'",
            f"NOT ({windows}) OR p_size % 2 = 1",
        ),
    ]
    rows = [
        ("Disk", name, value, "gauge", unit, dim, where)
        for dim, where in mounts
        for name, (value, unit) in usage.items()
    ]
    units = {"bytes": "bytes", "count": "count", "time": "milliseconds", "io": "milliseconds"}
    rows += [
        (
            "DiskIO", name, f"p_partkey * {i + 1}", "counter", units[name.rsplit("_", 1)[-1]],
            "'device=sda;serial_number=S' || p_partkey",
        )
        for i, name in enumerate(A.DISK_IO)
    ]
    return S.metric_rows("part", "p_brand", _PART_US, rows)


HOST_DISK_SQL = _disk_sql()


@query("host_disk", HOST_DISK_SQL)
def host_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_text(host.disk_metrics(A.host_disk(A.table(spark, sf_dir, "part"))))


HOST_INFO_SQL = S.metric_rows(
    "supplier",
    "'h' || s_suppkey",
    f"{S.EPOCH_US} + s_suppkey * 1000000",
    [
        ("Host", "uptime", "s_suppkey * 3600", "gauge", "seconds", "''"),
        ("Host", "procs", "s_suppkey % 300", "gauge", "count", "''"),
        ("Host", "users_loggedin", "s_suppkey % 4", "gauge", "count", "''"),
        (
            "Host", "info", "1", "gauge", "info",
            "'host_id=h' || s_suppkey || ';hostname=' || s_name || ';kernel_arch=x86_64;kernel_version=6.1"
            ";os=linux;platform=p' || s_nationkey || ';platform_family=rhel;platform_version=9"
            ";virtualization_role=guest;virtualization_system=kvm'",
        ),
    ],
)


@query("host_info", HOST_INFO_SQL)
def host_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_text(host.host_metrics(A.host_info(A.table(spark, sf_dir, "supplier"))))


def _net_sql() -> str:
    rows = []
    for dim, k in (("'interface=eth0'", 7), ("'interface=wan' || (o_custkey % 3)", 13)):
        rows += [
            ("Network", "bytes_sent", f"o_orderkey * {k}", "counter", "bytes", dim),
            ("Network", "bytes_recv", f"o_orderkey * {k + 1}", "counter", "bytes", dim),
            ("Network", "packets_sent", f"o_orderkey + {k}", "counter", "count", dim),
            ("Network", "packets_recv", f"o_custkey + {k}", "counter", "count", dim),
            ("Network", "err_in", f"o_custkey % {k + 1}", "counter", "count", dim),
            ("Network", "err_out", f"o_orderkey % {k + 1}", "counter", "count", dim),
        ]
    return S.metric_rows("orders", "'h' || o_custkey", "epoch_us(o_orderdate)", rows)


HOST_NET_SQL = _net_sql()


@query("host_net", HOST_NET_SQL)
def host_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_text(host.net_metrics(A.host_net(A.table(spark, sf_dir, "orders"))))


@query(
    "metric_union",
    f"""WITH m AS ({HOST_CPU_SQL} UNION ALL {HOST_MEM_SQL} UNION ALL {HOST_DISK_SQL}
  UNION ALL {HOST_INFO_SQL} UNION ALL {HOST_NET_SQL})
SELECT sub_namespace, name, type, unit, count(*) AS rows_out, min(value) AS minimum, max(value) AS maximum
FROM m GROUP BY sub_namespace, name, type, unit""",
)
def metric_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All named host sources as one table, summarised per metric. Names that repeat
    count once, unknown ones are skipped."""
    t = lambda name: A.table(spark, sf_dir, name)
    tables = {
        "host_cpu": A.host_cpu(t("part")),
        "host_mem": A.host_mem(t("orders")),
        "host_disk": A.host_disk(t("part")),
        "host_info": A.host_info(t("supplier")),
        "host_net": A.host_net(t("orders")),
    }
    names = ["cpu", "mem", "disk", "host", "net", "cpu", "gpu"]
    union = metric_registry().collect(spark, names, {"tables": tables})
    return union.groupBy("sub_namespace", "name", "type", "unit").agg(
        F.count("*").alias("rows_out"),
        F.round(F.min("value"), 6).alias("minimum"),
        F.round(F.max("value"), 6).alias("maximum"),
    )


# --- container captures -------------------------------------------------------

_INTERFACE = {
    "net_rx_bytes": ("iface_rx", "lo", "bytes"),
    "net_tx_bytes": ("iface_rx // 2", "lo", "bytes"),
    "net_rx_packets": ("iface_rx // 1000", "lo", "count"),
    "net_tx_packets": ("iface_rx // 2000", "lo", "count"),
    "net_rx_errors": ("event_id % 3", "0", "count"),
    "net_tx_errors": ("event_id % 4", "0", "count"),
    "net_rx_dropped": ("event_id % 5", "0", "count"),
    "net_tx_dropped": ("event_id % 6", "0", "count"),
}


def _joined(started: str) -> str:
    return f"""WITH {S.SAMPLES}, {S.CONTAINERS},
j AS (SELECT r.*, c.* EXCLUDE (cid), {S.uptime(started)} AS uptime FROM rated r JOIN containers c USING (cid))
"""


def _container_rows(sub: str, rows: list[tuple], optional: str) -> str:
    """``UNION ALL`` of (name, value, type, unit, own dimensions)."""
    base = (
        "7 + CASE WHEN version IS NULL THEN 0 ELSE 1 END "
        f"+ CASE WHEN {optional} IS NULL THEN 0 ELSE 1 END"
    )
    out = []
    for name, value, kind, unit, own in rows:
        keys = {"container_id": "cid"} | own
        columns = ", ".join(f"{keys.get(k, 'CAST(NULL AS VARCHAR)')} AS {k}" for k in CONTAINER_KEYS)
        out.append(
            f"SELECT CAST(us AS BIGINT) AS us, '{sub}' AS sub_namespace, '{name}' AS name, '{kind}' AS type, "
            f"'{unit}' AS unit, round(CAST({value} AS DOUBLE), 6) AS value, {columns}, state AS status, "
            f"CAST({base} + {len(own)} AS INTEGER) AS n_dims FROM j"
        )
    return "\nUNION ALL\n".join(out)


def _docker_sql() -> str:
    plain: dict = {}
    more = dict
    ns, by, ct = "nanoseconds", "bytes", "count"
    rows = [
        ("uptime_seconds", "uptime", "gauge", "seconds", plain),
        ("running", "CASE WHEN running THEN 1 ELSE 0 END", "gauge", "bool", plain),
        ("cpu_total_usage", "cpu_total", "counter", ns, plain),
        ("cpu_system_usage", "cpu_system", "counter", ns, plain),
        ("cpu_online_cpus", "4", "gauge", ct, plain),
        ("cpu_throttle_periods", "event_id % 10", "counter", ct, plain),
        ("cpu_throttled_periods", "event_id % 7", "counter", ct, plain),
        ("cpu_throttled_time", "event_id % 5", "counter", ns, plain),
        ("cpu_percpu_usage", "cpu_total // 2", "counter", ns, more(cpu="'cpu0'")),
        ("cpu_percpu_usage", "cpu_total - cpu_total // 2", "counter", ns, more(cpu="'cpu1'")),
        ("mem_usage_bytes", "CAST(round(value * 1024) AS BIGINT)", "gauge", by, plain),
        ("mem_limit_bytes", "1073741824", "gauge", by, plain),
        ("mem_max_usage_bytes", "CAST(round(value * 2048) AS BIGINT)", "gauge", by, plain),
        ("mem_active_anon", "lo", "gauge", by, plain),
        ("mem_cache", "event_id % 1000", "gauge", by, plain),
        ("net_rx_bytes_total", "rx", "counter", by, plain),
        ("net_tx_bytes_total", "tx", "counter", by, plain),
        ("blkio_service_bytes", "event_id", "counter", by, more(op="'read'", device="'8:0'")),
        ("blkio_service_bytes", "event_id * 2", "counter", by, more(op="'write'", device="'8:16'")),
        ("pids_current", "1 + event_id % 50", "gauge", ct, plain),
        ("cpu_percent", "cpu_percent", "gauge", "percent", plain),
        ("net_rx_rate_bytes", "rx_rate", "gauge", "bytes/s", plain),
        ("net_tx_rate_bytes", "tx_rate", "gauge", "bytes/s", plain),
    ]
    for name, (main, loop, unit) in _INTERFACE.items():
        rows.append((name, main, "counter", unit, more(interface="event_type")))
        rows.append((name, loop, "counter", unit, more(interface="'lo'")))
    return _joined("created_us") + _container_rows("Docker", rows, "health")


@query("docker_metrics", _docker_sql())
def docker_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    return container_text(
        containers.docker_metrics(
            A.docker_list(customer),
            A.docker_stats(A.events(spark, sf_dir)),
            A.docker_inspect(customer),
        )
    )


def _podman_sql() -> str:
    plain: dict = {}
    more = dict
    ns, by, ct = "nanoseconds", "bytes", "count"
    rows = [
        ("uptime_seconds", "uptime", "gauge", "seconds", plain),
        ("running", "CASE WHEN running THEN 1 ELSE 0 END", "gauge", "bool", plain),
        ("cpu_total_usage", "cpu_total", "counter", ns, plain),
        ("cpu_kernelmode", "cpu_total // 2", "counter", ns, plain),
        ("cpu_usermode", "cpu_total - cpu_total // 2", "counter", ns, plain),
        ("cpu_online_cpus", "4", "gauge", ct, plain),
        ("cpu_system_usage", "cpu_system", "counter", ns, plain),
        ("mem_usage_bytes", "CAST(round(value * 1024) AS BIGINT)", "gauge", by, plain),
        ("mem_limit_bytes", "1073741824", "gauge", by, plain),
        ("mem_max_usage_bytes", "0", "gauge", by, plain),
        ("net_rx_bytes_total", "rx", "counter", by, plain),
        ("net_tx_bytes_total", "tx", "counter", by, plain),
        ("cpu_throttle_periods", "0", "counter", ct, plain),
        ("cpu_throttled_periods", "0", "counter", ct, plain),
        ("cpu_throttled_time", "0", "counter", ns, plain),
        ("pids_current", "0", "gauge", ct, plain),
        ("blkio_service_bytes", "0", "counter", by, plain),
        ("cpu_percent", "cpu_percent", "gauge", "percent", plain),
        ("net_rx_rate_bytes", "rx_rate", "gauge", "bytes/s", plain),
        ("net_tx_rate_bytes", "tx_rate", "gauge", "bytes/s", plain),
    ]
    for name, (main, loop, unit) in _INTERFACE.items():
        known = name in ("net_rx_bytes", "net_tx_bytes")
        rows.append((name, main if known else "0", "counter", unit, more(interface="event_type")))
        rows.append((name, loop if known else "0", "counter", unit, more(interface="'lo'")))
    started = "(CASE WHEN inspected THEN created_us + 250000 END)"
    return _joined(started) + _container_rows("Podman", rows, "ports")


@query("podman_metrics", _podman_sql())
def podman_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    return container_text(
        containers.podman_metrics(
            A.podman_list(customer),
            A.podman_stats(A.events(spark, sf_dir)),
            A.podman_inspect(customer),
        )
    )


def raw_container_text(spark: SparkSession, runtime: str, captures: dict[str, DataFrame]) -> DataFrame:
    """Captures as the runtime's API gives them, written as lines and read by the registry."""
    path = work_folder(spark, f"{runtime}-raw")
    for name, lines in captures.items():
        lines.write.text(f"{path}/{runtime}_{name}")
    return container_text(metric_registry().collect(spark, [runtime], {"path": path, "format": "raw"}))


@query("docker_raw", _docker_sql())
def docker_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    captures = {
        "list": A.api_lines(A.docker_list(customer), A.DOCKER_LIST_BODY, listed=True),
        "stats": A.api_lines(A.docker_stats(A.events(spark, sf_dir)), A.DOCKER_STATS_BODY),
        "inspect": A.api_lines(A.docker_inspect(customer), A.DOCKER_INSPECT_BODY),
    }
    return raw_container_text(spark, "docker", captures)


@query("podman_raw", _podman_sql())
def podman_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    captures = {
        "list": A.api_lines(A.podman_list(customer), A.PODMAN_LIST_BODY, listed=True),
        "stats": A.api_lines(A.podman_stats(A.events(spark, sf_dir)), A.PODMAN_STATS_BODY),
        "inspect": A.api_lines(A.podman_inspect(customer), A.PODMAN_INSPECT_BODY),
    }
    return raw_container_text(spark, "podman", captures)


def joined_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    # The series carries whole rows, so it is given the columns that are asked for.
    stats = A.docker_stats(A.events(spark, sf_dir)).select("event_id", "host_id", "ts", "id")
    listed = A.docker_list(customer).select("host_id", "id", "image", "state", "created")
    return containers.join_captures(listed, stats, A.docker_inspect(customer))


@query(
    "container_join",
    f"""WITH {S.EV}, {S.CONTAINERS}
SELECT c.cid AS container_id, e.event_id, c.image, c.state, c.health AS health_status
FROM ev e JOIN containers c ON c.c_custkey = e.user_id""",
)
def container_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_containers(spark, sf_dir).select(
        short_id(F.col("id")).alias("container_id"), "event_id", "image", "state", "health_status"
    )


@query(
    "container_dims",
    f"""WITH {S.CONTAINERS}
SELECT cid AS container_id, {S.dims('docker', health_status='health')} AS dims FROM containers""",
)
def container_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = A.table(spark, sf_dir, "customer")
    listed = A.docker_list(customer).join(A.docker_inspect(customer), ["host_id", "id"], "left")
    dims = containers.container_dims("docker", {"health_status": F.col("health_status")})
    return listed.select(short_id(F.col("id")).alias("container_id"), render_map(dims).alias("dims"))


@query(
    "podman_dims",
    f"""WITH {S.CONTAINERS}
SELECT cid AS container_id, {S.dims('podman', ports='ports')} AS dims FROM containers""",
)
def podman_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = A.podman_list(A.table(spark, sf_dir, "customer"))
    dims = containers.container_dims("podman", {"ports": null_if_empty(format_ports(F.col("ports")))})
    return listed.select(short_id(F.col("id")).alias("container_id"), render_map(dims).alias("dims"))


_SNAPSHOT_DIMS = S.dims(
    "docker",
    container_version="'1.' || (l.o_orderkey % 10)",
    image="'img' || (l.o_orderkey % 5) || ':1.' || (l.o_orderkey % 10)",
    mount_count="l.o_orderkey % 4",
    name="'c' || l.o_custkey",
    status="l.state",
    health_status="i.health",
    **{"label.tier": "'t' || (l.o_orderkey % 3)"},
)
_SNAPSHOTS = f"""WITH {S.SAMPLES},
listed AS (
  SELECT *, {S.EPOCH_US} + (epoch_us(o_orderdate) // 86400000000) % 30 * 86400000000
      + o_orderkey * 7919 % 86400000 * 1000 AS at_us,
    CASE o_orderstatus WHEN 'F' THEN 'exited' WHEN 'O' THEN 'running' ELSE 'Running' END AS state,
    o_orderstatus <> 'F' AS running, {S.EPOCH_US} + (o_orderkey % 30) * 86400000000 AS created_us
  FROM orders
),
inspected AS (
  SELECT o_custkey, at_us, CASE WHEN o_orderkey % 2 = 0 THEN 'healthy' ELSE 'unhealthy' END AS health
  FROM listed WHERE o_totalprice >= 200000
),
j AS (
  SELECT r.*, l.running, l.created_us, {_SNAPSHOT_DIMS} AS dims
  FROM rated r ASOF JOIN listed l ON r.user_id = l.o_custkey AND r.us >= l.at_us
  ASOF LEFT JOIN inspected i ON r.user_id = i.o_custkey AND r.us >= i.at_us
)"""


@query(
    "container_snapshots",
    f"""{_SNAPSHOTS}
SELECT us, name, round(CAST(value AS DOUBLE), 6) AS value, dims FROM (
  SELECT us, 'uptime_seconds' AS name, {S.uptime('created_us')} AS value, dims FROM j
  UNION ALL SELECT us, 'running', CASE WHEN running THEN 1 ELSE 0 END, dims FROM j
  UNION ALL SELECT us, 'cpu_percent', cpu_percent, dims FROM j
  UNION ALL SELECT us, 'net_rx_rate_bytes', rx_rate, dims FROM j)""",
)
def container_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sample with the list and inspect capture of its time: state, image and health change."""
    orders = A.table(spark, sf_dir, "orders")
    rows = containers.docker_metrics(
        A.list_snapshots(orders), A.docker_stats(A.events(spark, sf_dir)), A.inspect_snapshots(orders)
    )
    shown = ("uptime_seconds", "running", "cpu_percent", "net_rx_rate_bytes")
    return rows.filter(F.col("name").isin(*shown)).select(
        F.unix_micros("ts").alias("us"),
        "name",
        F.round("value", 6).alias("value"),
        render_map(F.col("dimensions")).alias("dims"),
    )


@query(
    "container_uptime",
    f"""WITH {S.EV}, {S.CONTAINERS},
j AS (SELECT * FROM ev e JOIN containers c ON c.c_custkey = e.user_id)
SELECT event_id, round({S.uptime('created_us')}, 6) AS uptime_seconds, running FROM j""",
)
def container_uptime(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = F.timestamp_seconds("created")
    return joined_containers(spark, sf_dir).select(
        "event_id",
        F.round(containers.uptime_seconds(F.col("state"), started, F.col("ts")), 6).alias(
            "uptime_seconds"
        ),
        containers.is_running(F.col("state")).alias("running"),
    )


@query(
    "format_ports",
    f"WITH {S.CONTAINERS} SELECT cid AS container_id, coalesce(ports, '') AS ports FROM containers",
)
def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.podman_list(A.table(spark, sf_dir, "customer")).select(
        short_id(F.col("id")).alias("container_id"), format_ports(F.col("ports")).alias("ports")
    )
