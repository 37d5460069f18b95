"""The three jobs from captured tables to nested exports."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.resource import meta_struct
from fleetlens.options import LogOptions, MetricOptions, ProcessOptions
from fleetlens.plans import adapters as A
from fleetlens.plans import jobs, q_processes
from fleetlens.session import work_folder
from fleetlens.sinks.files import write_export

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def meta(spark):
    record = meta_struct({"host_id": F.lit("host0"), "hostname": F.lit("box"), "agent_id": F.lit("a1")})
    return spark.range(1).select(record.alias("m")).select("m.*")


def test_metrics(spark, sf_dir, meta):
    customer = A.table(spark, sf_dir, "customer")
    tables = {
        "docker_list": A.docker_list(customer),
        "docker_stats": A.docker_stats(A.events(spark, sf_dir)),
        "docker_inspect": A.docker_inspect(customer),
        "host_net": A.host_net(A.table(spark, sf_dir, "orders")),
    }
    options = MetricOptions(sources=("docker", "net"), max_points=20)
    out = jobs.metric_export(spark, {"tables": tables}, meta, START, 3600, options)
    path = work_folder(spark, "export")
    write_export(out, path)
    rows = spark.read.parquet(path)
    points = rows.select(F.explode("resource_metrics").alias("r")).select(
        F.explode("r.scope_metrics").alias("s")
    ).select("s.scope.name", F.size("s.metrics").alias("n"))
    totals = {r["name"]: r.n for r in points.groupBy("name").agg(F.sum("n").alias("n")).collect()}
    assert totals == {
        "Container.Docker": 39 * A.events(spark, sf_dir).count(),
        "System.Network": 12 * A.table(spark, sf_dir, "orders").count(),
    }
    container = rows.filter("kind = 'container'").first().resource_metrics[0].resource
    attrs = {a.key: a.value for a in container.attributes}
    assert attrs["host.name"] == "box" and attrs["tag.job"] == "fleetlens-container"
    assert attrs["tag.status"] in ("running", "stopped")


def test_logs(spark, sf_dir, meta):
    ev = A.events(spark, sf_dir)
    tables = {"syslog": A.syslog_lines(ev), "events_xml": A.event_xml(ev)}
    linux = jobs.log_export(
        spark, {"tables": tables}, meta, 86400, LogOptions(sources=("security", "eventviewer"), batch_size=3)
    )
    sizes = linux.select(F.explode("resource_logs").alias("r")).select(
        F.explode("r.scope_logs").alias("s")
    ).select(F.size("s.log_records").alias("n"))
    assert sizes.agg(F.sum("n"), F.max("n")).first()[:] == (ev.count(), 3)
    windows = jobs.log_export(
        spark,
        {"tables": tables},
        meta,
        86400,
        LogOptions(sources=("security", "eventviewer"), channels=("system",)),
        os="windows",
    )
    channels = windows.select(F.explode("resource_logs").alias("r")).select(
        F.explode(F.flatten("r.scope_logs.log_records")).alias("l")
    ).select(F.explode("l.attributes").alias("a")).filter("a.key = 'log.service'")
    assert {r[0] for r in channels.select("a.string_value").distinct().collect()} == {"System"}


def test_metric_export_reads_each_capture_once(spark, sf_dir, meta, tmp_path):
    for name in ("customer", "events", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    t = lambda name: A.table(spark, str(tmp_path), name)
    tables = {
        "docker_list": A.list_snapshots(t("orders")),
        "docker_stats": A.docker_stats(A.with_instant(t("events"))),
        "docker_inspect": A.docker_inspect(t("customer")),
        "host_net": A.host_net(t("orders")),
    }
    out = jobs.metric_export(spark, {"tables": tables}, meta, START, 3600, MetricOptions(sources=("docker", "net")))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # orders are read as list and as interfaces; the plan cuts long paths
    read = sorted(x.rsplit("/", 1)[-1][:3] for x in plan.splitlines() if "FileScan" in x)
    assert read == ["cus", "eve", "ord", "ord"]
    # The one sort aggregate picks a host's metadata row; metrics are folded in the numbering pass.
    sorts = [x for x in plan.splitlines() if "SortAggregate" in x]
    assert len(sorts) <= 2 and not any("container_image" in x for x in sorts)


def test_payloads_of_a_host_without_or_with_repeated_metadata(spark, sf_dir, meta):
    rows = q_processes.processes(spark, sf_dir)
    out = jobs.process_export(rows, meta, ProcessOptions(top_n=2)).collect()
    assert {(r.agent_id, r.hostname) for r in out} == {(None, None)} and all(r.endpoint_id and r.meta.kind == "host" for r in out)
    own = meta.withColumn("host_id", F.lit("h1"))
    twice = own.unionByName(own.withColumn("hostname", F.lit("zz")))
    for order in ("hostname", F.desc("hostname")):
        found = jobs.process_export(rows, twice.orderBy(order), ProcessOptions(top_n=2)).filter("host_id = 'h1'").collect()
        assert [r.hostname for r in found] == ["zz"]


def test_processes(spark, sf_dir, meta):
    out = jobs.process_export(q_processes.processes(spark, sf_dir), meta, ProcessOptions(top_n=2))
    assert out.agg(F.max(F.size("processes"))).first()[0] <= 4


def test_account_named_twice_does_not_multiply_rows(spark):
    from fleetlens.operators.lookups import resolve_user

    rows = spark.createDataFrame([("h", "0"), ("h", "4294967294"), ("h", "x")], "host_id string, uid string")
    users = spark.createDataFrame(
        [("h", 0, "toor"), ("h", 0, "root"), ("h", 4294967294, "nobody")], "host_id string, uid bigint, username string"
    )
    got = resolve_user(rows, [F.lit(None).cast("string")], F.col("uid"), users)
    assert sorted((r.uid, r.user) for r in got.collect()) == [("0", "root"), ("4294967294", "nobody"), ("x", "")]


def test_a_source_that_fails_is_not_left_out_silently(spark):
    from fleetlens import schemas
    from fleetlens.sources.registry import metric_registry

    registry, options = metric_registry(), {"path": "/nowhere", "tables": {"host_cpu": spark.createDataFrame([], schemas.RAW_HOST_CPU)}}
    with pytest.raises(Exception, match="nowhere"):
        registry.collect(spark, ["cpu", "mem"], options)
    found, failed = registry.collect_available(spark, ["cpu", "mem"], options)
    assert found.count() == 0 and list(failed) == ["mem"]
