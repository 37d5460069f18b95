"""Payloads, tags and nested exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions.maps import merge_maps
from fleetlens.functions.resource import META_FIELDS, meta_struct, payload_resource, resource_attributes
from fleetlens.operators.otlp import otlp_logs, otlp_metrics
from fleetlens.operators.payloads import (
    assemble_payloads,
    attach_meta,
    container_identity,
    payload_meta,
    route_endpoints,
)
from fleetlens.operators.rollup import stat_rollup
from fleetlens.operators.payloads import log_payloads
from fleetlens.sinks.files import log_meta_or_empty

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
LOGS = (
    "agent_id string, host_id string, hostname string, endpoint_id string, "
    f"logs array<struct<ts: timestamp, level: string, message: string, source: string, category: string, "
    f"pid: int, fields: map<string,string>, labels: map<string,string>, meta: {schemas.LOG_META}>>"
)


def test_log_payload_keeps_its_identity(spark):
    meta = dict.fromkeys(schemas.LOG_META_FIELDS) | {"platform": "linux", "extra": {"k": "v", "e": ""}}
    entry = {
        "ts": T0, "level": "info", "message": "disk almost full", "source": "smartd", "category": "test",
        "pid": 1234, "fields": {"f": "1", "": "2"}, "labels": {"l": "2"}, "meta": meta,
    }
    df = spark.createDataFrame(
        [("agent-7", "box-21", "box21.lan", "ep-21", [entry])], LOGS
    )
    record = meta_struct({"host_id": F.lit("wrong"), "agent_id": F.lit("wrong"), "os": F.lit("linux")})
    row = otlp_logs(df.withColumn("meta", record)).first()
    (resource_logs,) = row.resource_logs
    attrs = {a.key: a.value for a in resource_logs.resource.attributes}
    assert attrs["host.id"] == "box-21" and attrs["agent.id"] == "agent-7"
    assert attrs["os.type"] == "linux"
    (scope,) = resource_logs.scope_logs
    assert scope.scope.name == "smartd"
    (log,) = scope.log_records
    assert (log.severity_text, log.severity_number, log.body) == ("info", 9, "disk almost full")
    typed = {a.key: a.string_value if a.int_value is None else a.int_value for a in log.attributes}
    assert typed == {
        "log.source": "smartd", "log.category": "test", "process.pid": 1234, "field.f": "1",
        "field.": "2", "tag.l": "2", "log.platform": "linux", "log.extra.k": "v",
    }


METRICS = (
    "metrics array<struct<namespace: string, sub_namespace: string, name: string, ts: timestamp, value: double, "
    f"unit: string, dimensions: map<string,string>, stats: {schemas.STATS}>>"
)


def metric(sub="cpu", stats=None, dims=None, value=41.25):
    return {
        "namespace": "system", "sub_namespace": sub, "name": "usage_percent", "ts": T0, "value": value,
        "unit": "percent", "dimensions": dims or {"cpu": "cpu0", "host": "box-21"}, "stats": stats,
    }


def export(spark, *metrics):
    df = spark.createDataFrame([(list(metrics),)], METRICS)
    return otlp_metrics(df.withColumn("meta", meta_struct({"host_id": F.lit("h")})))


def test_metric_payload(spark):
    (resource,) = export(spark, metric()).first().resource_metrics
    (scope,) = resource.scope_metrics
    assert scope.scope.name == "system.cpu"
    (m,) = scope.metrics
    assert (m.name, m.unit, m.gauge.as_double, m.histogram) == ("usage_percent", "percent", 41.25, None)
    assert [(a.key, a.value) for a in m.gauge.attributes] == [("cpu", "cpu0"), ("host", "box-21")]
    assert m.gauge.time_unix_nano == int(T0.timestamp()) * 10**9


def test_scopes_and_points(spark):
    full = {"minimum": 1.0, "maximum": 5.0, "sum": 9.0, "sample_count": 3}
    (resource,) = export(
        spark,
        metric("mem", dims={"": "x", "k": "", "ok": "1"}),
        metric("cpu", full),
        metric("", {**full, "sample_count": 0}),
    ).first().resource_metrics
    scopes = {s.scope.name: s.metrics for s in resource.scope_metrics}
    assert list(scopes) == ["system", "system.cpu", "system.mem"]
    assert [(a.key, a.value) for a in scopes["system.mem"][0].gauge.attributes] == [("ok", "1")]
    hist = scopes["system.cpu"][0].histogram
    assert (hist["count"], hist.sum, hist.min, hist.max) == (3, 9.0, 1.0, 5.0)
    assert hist.aggregation_temporality == "DELTA"
    assert scopes["system"][0].gauge is not None and scopes["system"][0].histogram is None


def test_empty_payload_gives_nothing(spark):
    assert export(spark).count() == 0


def test_resource_attributes(spark):
    meta = meta_struct({"host_id": F.lit("h"), "os": F.lit("")}, F.expr("map('a', '1', 'b', '')"))
    df = spark.range(1).select(meta.alias("m"))
    both = df.select(
        resource_attributes(F.col("m")), resource_attributes(F.col("m"), compat=True),
        resource_attributes(F.lit(None).cast(df.schema["m"].dataType)),
    ).first()
    assert list(both) == [{"host.id": "h", "tag.a": "1"}, {"host.id": "h"}, {}]
    assert len(META_FIELDS) == 47


def test_empty_own_identity_is_left_out(spark):
    identity = {f: F.lit("") for f in ("host_id", "agent_id", "hostname", "endpoint_id")}
    meta = meta_struct({"host_id": F.lit("h"), "os": F.lit("linux")})
    assert spark.range(1).select(payload_resource(identity, meta)).first()[0] == {"os.type": "linux"}


def test_merge_right_side_wins(spark):
    a, b = F.expr("map('x', '1', 'y', '2')"), F.expr("map('y', '3')")
    none = F.lit(None).cast("map<string,string>")
    got = spark.range(1).select(merge_maps(a, b), merge_maps(none, b), merge_maps(a, none)).first()
    assert list(got) == [{"x": "1", "y": "3"}, {"y": "3"}, {"x": "1", "y": "2"}]


def rows(spark, *records):
    base = {"host_id": "h", "namespace": "N", "sub_namespace": "S", "name": "m", "ts": T0, "value": 1.0,
            "type": "gauge", "unit": "u", "dimensions": {}, "stats": None, "storage_resolution": 0, "seq": 0}
    return spark.createDataFrame([{**base, "seq": i, **r} for i, r in enumerate(records)],
                                 schemas.METRIC + ", seq int")


def test_routing_splits_all_rows(spark):
    routed = route_endpoints(
        rows(spark, {"dimensions": {"container_id": "c"}}, {"dimensions": {"container_id": ""}}, {})
    )
    assert sorted(r.kind for r in routed.collect()) == ["container", "host", "host"]
    assert routed.select("endpoint_id").distinct().count() == 2


def test_container_identity_last_row_wins(spark):
    dims = lambda **k: {"dimensions": {"container_id": "c", **k}}
    routed = route_endpoints(
        rows(
            spark,
            dims(name="old", image="i1"),
            {**dims(container_name="new"), "name": "running", "value": 0.0},
            dims(image_id="sha"),
        )
    )
    row = container_identity(routed, ["container_id"], ["seq"]).first()
    assert (row.container_name, row.container_image_name, row.container_image_id, row.status) == (
        "new", "i1", "sha", "stopped",
    )


def test_payload_parts_keep_all_rows_in_order(spark):
    routed = route_endpoints(rows(spark, *[{"value": float(i)} for i in range(7)]))
    parts = assemble_payloads(routed, ["endpoint_id"], ["seq"], 3, F.expr("seq div 2")).collect()
    assert [[m.value for m in p.metrics] for p in sorted(parts, key=lambda p: p.part)] == [
        [0, 1, 2], [3, 4, 5], [6],
    ]
    (whole,) = assemble_payloads(routed, ["endpoint_id"], ["seq"], None).collect()
    assert [m.value for m in whole.metrics] == list(range(7))


def test_payload_meta(spark):
    meta = spark.range(1).select(
        F.lit("h").alias("host_id"),
        meta_struct({"hostname": F.lit("n"), "kind": F.lit("x")}, F.expr("map('a', '1')")).alias("m"),
    )
    column = payload_meta(
        F.col("m"), {"kind": F.lit("container"), "hostname": F.lit(None).cast("string")}, F.expr("map('b', '2')")
    )
    got = meta.select(column.alias("m")).first().m
    assert (got.kind, got.hostname, got.tags) == ("container", "n", {"a": "1", "b": "2"})


def test_meta_join_keeps_rows_without_meta(spark):
    left = spark.createDataFrame([("h",), ("x",)], "host_id string")
    meta = spark.range(1).select(meta_struct({"host_id": F.lit("h"), "os": F.lit("linux")}).alias("m")).select("m.*")
    got = {r.host_id: r.meta and r.meta.os for r in attach_meta(left, meta).collect()}
    assert got == {"h": "linux", "x": None}


def test_rollup(spark):
    later = T0 + dt.timedelta(minutes=61)
    df = rows(spark, {"value": 1.0}, {"value": 5.0}, {"value": 7.0, "ts": later}, {"dimensions": {"k": "v"}})
    got = {(r.ts.minute, r.ts.hour, str(r.dimensions)): r.stats for r in stat_rollup(df, 3600).collect()}
    assert len(got) == 3
    both = [s for s in got.values() if s.sample_count == 2]
    assert [(s.minimum, s.maximum, s.sum) for s in both] == [(1.0, 5.0, 6.0)]


def test_null_log_meta_becomes_an_empty_record(spark):
    df = spark.range(1).select(F.lit(None).cast(schemas.LOG_META).alias("m"))
    assert df.select(log_meta_or_empty(F.col("m")).alias("m")).first().m is not None


def test_log_payloads_have_empty_metadata_for_null(spark):
    ts = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    given = (*["p"] * len(schemas.LOG_META_FIELDS), {"k": "v"})
    rows = [("h", ts, "info", m, "s", "c", i, {}, {}, meta) for i, (m, meta) in enumerate([("null", None), ("given", given)])]
    meta = spark.createDataFrame([("h", "agent", "host", {})], "host_id string, agent_id string, hostname string, tags map<string,string>")
    meta = meta.select("*", *[F.lit(None).cast("string").alias(f) for f in META_FIELDS if f not in meta.columns])
    (row,) = log_payloads(spark.createDataFrame(rows, schemas.LOG_ENTRY), meta, ["host_id", "source"], ["pid"], 10, None).collect()
    metas = {e.message: e.meta for e in row.logs}
    assert metas["null"] is not None and set(metas["null"]) == {None}
    assert tuple(metas["given"]) == given
