"""Host captures: probes that failed, mounts that are skipped, swap."""

from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.sources import host
from fleetlens.sources.registry import metric_registry

TS = "2024-01-01T00:00:00Z"


def read(spark, tmp_path, schema, *records):
    path = tmp_path / "capture.json"
    path.write_text("\n".join(json.dumps({"host_id": "h", "ts": TS, **r}) for r in records))
    return spark.read.schema(schema).json(str(path))


def values(df):
    return {(r["name"], tuple(sorted(r.dimensions.items()))): r.value for r in df.collect()}


def test_failed_probes_give_no_rows(spark, tmp_path):
    raw = read(spark, tmp_path, schemas.RAW_HOST_CPU, {"percent_total": 12.5, "load1": 0.5})
    assert values(host.cpu_metrics(raw)) == {
        ("usage_percent", (("scope", "total"),)): 12.5,
        ("load_avg_1", ()): 0.5,
    }


def test_cpu_types_and_units(spark, tmp_path):
    raw = read(
        spark,
        tmp_path,
        schemas.RAW_HOST_CPU,
        {"percent_per_core": [1, 2], "times": {"user": 9}, "info": [{"mhz": 3000, "physical_id": "0"}]},
    )
    rows = host.cpu_metrics(raw).collect()
    assert {(r["name"], r["type"], r.unit) for r in rows} == {
        ("usage_percent", "gauge", "percent"),
        ("time_user", "counter", "seconds"),
        ("clock_mhz", "gauge", "MHz"),
    }
    assert [r.dimensions["core"] for r in rows if r["name"] == "usage_percent"] == ["core0", "core1"]
    assert [r.dimensions["physical"] for r in rows if r["name"] == "clock_mhz"] == ["true"]
    assert {r.namespace for r in rows} == {"System"}


def test_swap_rows_only_with_swap(spark, tmp_path):
    base = {"total": 100, "available": 60, "used": 40, "used_percent": 40}
    none = read(spark, tmp_path, schemas.RAW_HOST_MEM, {**base, "swap": {"total": 0}}, {**base})
    assert {r["name"] for r in host.mem_metrics(none).collect()} == {
        "total", "available", "used", "used_percent",
    }
    some = read(
        spark, tmp_path, schemas.RAW_HOST_MEM,
        {**base, "swap": {"total": 80, "used": 20, "free": 60, "used_percent": 0}},
    )
    got = values(host.mem_metrics(some))
    assert got["swap_used_percent", (("source", "swap"),)] == 25.0


def test_swap_percent_that_is_no_number(spark):
    swaps = spark.sql(
        "select named_struct('total', 0, 'free', 0, 'used_percent', 0.0D) as s union all "
        "select named_struct('total', 10, 'free', 5, 'used_percent', double('NaN')) union all "
        "select named_struct('total', 10, 'free', 5, 'used_percent', double('Infinity'))"
    )
    assert [r[0] for r in swaps.select(host.swap_percent(F.col("s"))).collect()] == [0.0, 0.0, 0.0]


def test_virtual_and_empty_mounts_are_skipped(spark, tmp_path):
    usage = {"total": 2**64 - 1, "used": 1, "free": 1, "used_percent": 1.0}
    part = lambda m, f, u=usage: {"mountpoint": m, "device": "\\\\.\\D0", "fstype": f, "usage": u}
    linux = {
        "os": "linux",
        "partitions": [
            part("/", "ext4"), part("/run/x", "ext4"), part("/sys", "ext4"), part("/proc", "ext4"),
            part("/a", "tmpfs"), part("/b", "overlay"), part("/c", "devtmpfs"), part("/d", "xfs", None),
        ],
    }
    windows = {"os": "windows", "partitions": [part("C:", ""), part("", "NTFS"), part("D:", "NTFS")]}
    rows = host.disk_metrics(read(spark, tmp_path, schemas.RAW_HOST_DISK, linux, windows)).collect()
    assert {r.dimensions["mountpoint"] for r in rows} == {"/", "D:"}
    assert {r.dimensions["device"] for r in rows} == {"D0"}
    assert {r.value for r in rows if r["name"] == "total"} == {float(2**64 - 1)}


def test_disk_io_and_network(spark, tmp_path):
    io = {"serial_number": "S1", "read_count": 3, "weighted_io": 9}
    raw = read(spark, tmp_path, schemas.RAW_HOST_DISK, {"os": "linux", "io": {"sda": io}})
    rows = {r["name"]: r for r in host.disk_metrics(raw).collect()}
    assert set(rows) == {"read_count", "weighted_io"}
    assert rows["weighted_io"].unit == "milliseconds" and rows["weighted_io"].sub_namespace == "DiskIO"
    net = read(spark, tmp_path, schemas.RAW_HOST_NET, {"interfaces": [{"name": "eth0", "errin": 4}]})
    assert values(host.net_metrics(net)) == {("err_in", (("interface", "eth0"),)): 4.0}


def test_host_info(spark, tmp_path):
    raw = read(spark, tmp_path, schemas.RAW_HOST_INFO, {"uptime": 5, "users": ["a", "b"], "os": "linux"})
    rows = {r["name"]: r for r in host.host_metrics(raw).collect()}
    assert rows["users_loggedin"].value == 2 and rows["uptime"].value == 5 and rows["info"].value == 1
    assert rows["info"].dimensions["os"] == "linux" and rows["info"].dimensions["host_id"] == "h"


def test_registry_reads_folders_and_reports_a_broken_source(spark, tmp_path):
    folder = tmp_path / "host_mem"
    folder.mkdir()
    (folder / "part.json").write_text(json.dumps({"host_id": "h", "ts": TS, "total": 5}))
    registry = metric_registry()

    def broken(spark, options):
        raise RuntimeError("no capture")

    registry.register("broken", broken)
    assert list(registry.select(["mem", "x", "mem", "cpu"])) == ["mem", "cpu"]
    with pytest.raises(RuntimeError, match="no capture"):
        registry.collect(spark, ["broken", "mem"], {"path": str(tmp_path)})
    got, failed = registry.collect_available(spark, ["broken", "mem"], {"path": str(tmp_path)})
    assert list(failed) == ["broken"]
    assert got.columns == schemas.METRIC_COLUMNS
    assert [(r["name"], r.value) for r in got.collect()] == [("total", 5.0)]


def test_one_read_of_the_capture(spark, sf_dir):
    """All families of a capture come from one scan and one explode; only the adapter's dealing shuffles."""
    from fleetlens.plans import adapters as A

    df = host.cpu_metrics(A.host_cpu(A.table(spark, sf_dir, "part")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate") == 1
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 1
