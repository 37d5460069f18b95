"""Container captures: joins, dimensions, lifecycle."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions.text import format_ports, image_version
from fleetlens.sources import containers

ID = "0123456789abcdef"
TS = "2024-01-12T00:00:00Z"


def read(spark, tmp_path, name, schema, records):
    path = tmp_path / f"{name}.json"
    path.write_text("\n".join(json.dumps({"host_id": "h", **r}) for r in records))
    return spark.read.schema(schema).json(str(path))


def docker(spark, tmp_path, listed, stats, inspect=()):
    return containers.docker_metrics(
        read(spark, tmp_path, "list", schemas.RAW_DOCKER_LIST, listed),
        read(spark, tmp_path, "stats", schemas.RAW_DOCKER_STATS, stats),
        read(spark, tmp_path, "inspect", schemas.RAW_DOCKER_INSPECT, inspect),
    ).collect()


def test_docker_rows(spark, tmp_path):
    listed = [
        {"id": ID, "names": ["/web"], "image": "img:1", "state": "Running", "labels": {"a": "b"},
         "mounts": ["m"], "created": 1704931200},
        {"id": "no-stats-container", "names": ["/x"], "image": "i", "state": "exited"},
    ]
    stats = [
        {"id": ID, "ts": TS, "cpu": {"total": 5, "percpu": [2, 3]}, "networks": {"eth0": {"rx_bytes": 7}},
         "memory": {"stats": {"Active Anon": 1}}, "blkio": [{"major": 8, "minor": 1, "op": "Read", "value": 2}]},
    ]
    rows = docker(spark, tmp_path, listed, stats)
    by_name = {r["name"]: r for r in rows}
    assert {r.dimensions["container_id"] for r in rows} == {ID[:12]}
    assert by_name["uptime_seconds"].value == 86400.0 and by_name["running"].value == 1
    assert by_name["running"].dimensions == {
        "container_id": ID[:12], "name": "web", "image": "img:1", "status": "Running", "runtime": "docker",
        "mount_count": "1", "container_version": "1", "label.a": "b",
    }
    assert by_name["mem_active_anon"].value == 1
    assert by_name["blkio_service_bytes"].dimensions["device"] == "8:1"
    assert by_name["blkio_service_bytes"].dimensions["op"] == "read"
    assert by_name["net_rx_bytes"].dimensions["interface"] == "eth0"
    assert by_name["net_rx_bytes_total"].value == 7 and by_name["net_tx_bytes_total"].value == 0
    assert [r.dimensions["cpu"] for r in rows if r["name"] == "cpu_percpu_usage"] == ["cpu0", "cpu1"]
    assert by_name["pids_current"].value == 0
    assert by_name["cpu_percent"].value == 0
    assert {(r.namespace, r.sub_namespace) for r in rows} == {("Container", "Docker")}


def test_health_comes_from_inspect(spark, tmp_path):
    listed = [{"id": ID, "names": ["/web"], "image": "img", "state": "exited", "created": 1704931200}]
    rows = docker(spark, tmp_path, listed, [{"id": ID, "ts": TS}], [{"id": ID, "health_status": "healthy"}])
    assert rows[0].dimensions["health_status"] == "healthy"
    assert {r.value for r in rows if r["name"] in ("running", "uptime_seconds")} == {0.0}


@pytest.mark.parametrize(
    "state, seconds, expected",
    [("running", 1_000_000, 1e6), ("RUNNING", 1_000_001, 0), ("running", -5, 0), ("paused", 50, 0)],
)
def test_uptime_limits(spark, state, seconds, expected):
    now = F.timestamp_seconds(F.lit(1_704_067_200))
    started = F.timestamp_seconds(F.lit(1_704_067_200 - seconds))
    got = spark.range(1).select(containers.uptime_seconds(F.lit(state), started, now)).first()[0]
    assert got == expected


@pytest.mark.parametrize(
    "image, version", [("img", None), ("img:2", "2"), ("reg:5000/img", "5000/img"), ("reg:5000/img:1", None)]
)
def test_image_version(spark, image, version):
    assert spark.range(1).select(image_version(F.lit(image))).first()[0] == version


def test_ports(spark):
    ports = spark.sql(
        "select array(named_struct('private_port', 80, 'public_port', 8080, 'type', 'tcp'), "
        "named_struct('private_port', 443, 'public_port', 0, 'type', 'tcp')) as p "
        "union all select array() union all select null"
    )
    got = [r[0] for r in ports.select(format_ports(F.col("p"))).collect()]
    assert got == ["8080:80/tcp,443/tcp", "", ""]


def test_podman_zeros_and_start(spark, tmp_path):
    rows = containers.podman_metrics(
        read(spark, tmp_path, "l", schemas.RAW_PODMAN_LIST,
             [{"id": ID, "names": ["web"], "image": "img", "state": "running",
               "ports": [{"private_port": 80, "public_port": 0, "type": "tcp"}]}]),
        read(spark, tmp_path, "s", schemas.RAW_PODMAN_STATS,
             [{"id": ID, "ts": TS, "cpu": {"total": 5}, "networks": {"eth0": {"rx_bytes": 7, "tx_bytes": 1}}}]),
        read(spark, tmp_path, "i", schemas.RAW_PODMAN_INSPECT,
             [{"id": ID, "started_at": "2024-01-11T23:59:59.123456789Z"}]),
    ).collect()
    by_name = {r["name"]: r for r in rows}
    assert by_name["uptime_seconds"].value == pytest.approx(0.876544)
    assert by_name["running"].dimensions["ports"] == "80/tcp"
    assert by_name["blkio_service_bytes"].value == 0 and by_name["net_rx_packets"].value == 0
    assert by_name["net_rx_bytes"].value == 7


def test_state_follows_the_snapshots(spark, tmp_path):
    at = lambda hour: f"2024-01-12T{hour:02d}:00:00Z"
    base = {"id": ID, "names": ["/web"], "created": 1704931200}
    listed = [
        {**base, "ts": at(1), "image": "img:1", "state": "running"},
        {**base, "ts": at(5), "image": "img:2", "state": "exited"},
        {**base, "ts": at(9), "image": "img:2", "state": "running"},
    ]
    stats = [{"id": ID, "ts": at(h), "cpu": {"total": h, "system": h, "online": 1}} for h in (0, 1, 4, 5, 8, 12)]
    inspect = [{"id": ID, "ts": at(5), "health_status": "unhealthy"}]
    rows = [r for r in docker(spark, tmp_path, listed, stats, inspect) if r["name"] == "running"]
    shown = {r.ts.hour: (r.value, r.dimensions["image"], r.dimensions.get("health_status")) for r in rows}
    assert shown == {
        1: (1.0, "img:1", None),
        4: (1.0, "img:1", None),
        5: (0.0, "img:2", "unhealthy"),
        8: (0.0, "img:2", "unhealthy"),
        12: (1.0, "img:2", "unhealthy"),
    }
    assert len(rows) == 5  # stats before the first list row have no container


def test_list_is_not_hinted_for_broadcast(spark, sf_dir):
    from fleetlens.plans import q_metrics

    plan = q_metrics.joined_containers(spark, sf_dir)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()
