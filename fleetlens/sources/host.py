"""Host snapshots (CPU, memory, disk, host, network) to metric rows.

Every job is one projection and one explode: no shuffle, one read of the capture.
A column that is null stands for a probe that failed and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import literal_map
from fleetlens.functions.points import (
    explode_points,
    flat_points_of,
    no_points,
    point,
    points_if,
    points_of,
    with_dims,
)
from fleetlens.schemas import HOST_INFO_FIELDS

# Cumulative CPU times.
CPU_TIMES = "user system idle nice iowait irq softirq steal guest guest_nice".split()

# Fixed values: (metric, unit) of a mounted partition.
DISK_USAGE = [
    ("total", "bytes"),
    ("used", "bytes"),
    ("free", "bytes"),
    ("used_percent", "percent"),
    ("inodes_total", "count"),
    ("inodes_used", "count"),
    ("inodes_free", "count"),
    ("inodes_used_percent", "percent"),
]

# Fixed values: (metric, unit) of a block device.
DISK_IO = [
    ("read_count", "count"),
    ("write_count", "count"),
    ("read_bytes", "bytes"),
    ("write_bytes", "bytes"),
    ("read_time", "milliseconds"),
    ("write_time", "milliseconds"),
    ("io_time", "milliseconds"),
    ("merged_read_count", "count"),
    ("merged_write_count", "count"),
    ("weighted_io", "milliseconds"),
]

# Fixed values: (metric, unit, captured field) of a network interface.
NETWORK_IO = [
    ("bytes_sent", "bytes", "bytes_sent"),
    ("bytes_recv", "bytes", "bytes_recv"),
    ("packets_sent", "count", "packets_sent"),
    ("packets_recv", "count", "packets_recv"),
    ("err_in", "count", "errin"),
    ("err_out", "count", "errout"),
]

# Mounts and file systems that hold no data.
VIRTUAL_MOUNTS = ["/sys", "/proc", "/run"]
VIRTUAL_FILESYSTEMS = ["tmpfs", "devtmpfs", "overlay"]


def cpu_metrics(raw: DataFrame) -> DataFrame:
    core = lambda i: F.concat(F.lit("core"), i.cast("string"))
    per_core = points_of(
        F.col("percent_per_core"),
        lambda v, i: point(
            "CPU", "usage_percent", v, "gauge", "percent", {"core": core(i), "scope": "per_core"}
        ),
    )
    total = F.array(
        point("CPU", "usage_percent", F.col("percent_total"), "gauge", "percent", {"scope": "total"})
    )
    times = F.array(
        *[
            point("CPU", f"time_{k}", F.col("times")[k], "counter", "seconds", {"scope": "total"})
            for k in CPU_TIMES
        ]
    )
    clocks = points_of(
        F.col("info"),
        lambda c, i: point(
            "CPU",
            "clock_mhz",
            c["mhz"],
            "gauge",
            "MHz",
            {
                "core": core(i),
                "vendor": c["vendor"],
                "model": c["model"],
                "stepping": c["stepping"].cast("string"),
                "cache": c["cache"].cast("string"),
                "family": c["family"],
                "physical": (F.coalesce(c["physical_id"], F.lit("")) != "").cast("string"),
            },
        ),
    )
    singles = F.array(
        point("CPU", "count_logical", F.col("count_logical"), "gauge", "count"),
        point("CPU", "count_physical", F.col("count_physical"), "gauge", "count"),
        *[point("CPU", f"load_avg_{m}", F.col(f"load{m}"), "gauge", "load") for m in (1, 5, 15)],
    )
    return explode_points(raw, "System", [per_core, total, times, clocks, singles])


def swap_percent(swap: Column) -> Column:
    """Used share of the swap space: as captured, or computed when that is not positive."""
    total, free = swap["total"].cast("double"), swap["free"].cast("double")
    captured = swap["used_percent"]
    computed = F.when(total > 0, (total - free) / total * 100)
    percent = F.when(captured > 0, captured).otherwise(computed)
    bad = percent.isNull() | F.isnan(percent) | (F.abs(percent) == float("inf"))
    return F.when(bad, 0.0).otherwise(percent)


def mem_metrics(raw: DataFrame) -> DataFrame:
    def one(name: str, value: Column, unit: str, source: str) -> Column:
        return point("Memory", name, value, "gauge", unit, {"source": source})

    physical = F.array(
        *[one(n, F.col(n), "bytes", "physical") for n in ("total", "available", "used")],
        one("used_percent", F.col("used_percent"), "percent", "physical"),
    )
    swap = F.col("swap")
    swapped = points_if(
        swap["total"] > 0,
        *[one(f"swap_{n}", swap[n], "bytes", "swap") for n in ("total", "used", "free")],
        one("swap_used_percent", swap_percent(swap), "percent", "swap"),
    )
    return explode_points(raw, "System", [physical, swapped])


def keeps_partition(os: Column, mountpoint: Column, fstype: Column) -> Column:
    """Whether a mount holds data: no virtual file systems, no empty Windows drives."""
    virtual = fstype.isin(VIRTUAL_FILESYSTEMS)
    for prefix in VIRTUAL_MOUNTS:
        virtual = virtual | mountpoint.startswith(prefix)
    return F.when(os == "windows", (fstype != "") & (mountpoint != "")).otherwise(~virtual)


def disk_metrics(raw: DataFrame) -> DataFrame:
    mounts = F.filter(
        F.col("partitions"),
        lambda p: keeps_partition(
            F.col("os"), F.coalesce(p["mountpoint"], F.lit("")), F.coalesce(p["fstype"], F.lit(""))
        )
        & p["usage"].isNotNull(),
    )

    def mount_dims(p: Column) -> Column:
        return literal_map(
            {
                "mountpoint": p["mountpoint"],
                "device": F.regexp_replace(p["device"], r"^\\\\\.\\", ""),
                "fstype": p["fstype"],
            }
        )

    def device_dims(e: Column) -> Column:
        return literal_map({"device": e["key"], "serial_number": e["value"]["serial_number"]})

    def usage(p: Column) -> Column:
        values = p["item"]["usage"]
        return F.array(*[point("Disk", n, values[n], "gauge", u, p["dims"]) for n, u in DISK_USAGE])

    def io(e: Column) -> Column:
        values = e["item"]["value"]
        return F.array(*[point("DiskIO", n, values[n], "counter", u, e["dims"]) for n, u in DISK_IO])

    prepared = raw.withColumns(
        {
            "__mounts": with_dims(mounts, mount_dims),
            "__devices": with_dims(F.map_entries("io"), device_dims),
        }
    )
    groups = [flat_points_of(F.col("__mounts"), usage), flat_points_of(F.col("__devices"), io)]
    return explode_points(prepared, "System", groups)


def host_metrics(raw: DataFrame) -> DataFrame:
    users = F.when(F.col("users").isNull(), 0).otherwise(F.size("users"))
    info_dims = {f: F.col(f) for f in HOST_INFO_FIELDS} | {"host_id": F.col("host_id")}
    points = F.array(
        point("Host", "uptime", F.col("uptime"), "gauge", "seconds"),
        point("Host", "procs", F.col("procs"), "gauge", "count"),
        point("Host", "users_loggedin", users, "gauge", "count"),
        point("Host", "info", F.lit(1), "gauge", "info", info_dims),
    )
    return explode_points(raw, "System", [points, no_points()])


def net_metrics(raw: DataFrame) -> DataFrame:
    def interface(n: Column) -> Column:
        return F.array(
            *[point("Network", m, n["item"][f], "counter", u, n["dims"]) for m, u, f in NETWORK_IO]
        )

    named = with_dims(F.col("interfaces"), lambda n: literal_map({"interface": n["name"]}))
    prepared = raw.withColumn("__interfaces", named)
    return explode_points(
        prepared, "System", [flat_points_of(F.col("__interfaces"), interface), no_points()]
    )
