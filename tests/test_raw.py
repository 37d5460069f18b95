"""Captures in the forms that the journal, the runtimes and the auth log write."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fleetlens.sources import raw
from fleetlens.sources.registry import log_registry, metric_registry


def lines_of(spark, *records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_forms_of_journal_fields(spark):
    entry = {"__REALTIME_TIMESTAMP": "1704067200000001", "_HOSTNAME": "h", "PRIORITY": "3"}
    forms = {
        "plain": "text",
        "bracket": "[not, an array]",
        "number": 42,
        "null": None,
        "bytes": list("é [x]".encode()),
        "bad bytes": [72, 255, 105],
        "signed bytes": [-61, -87],
        "list": ["old", "new"],
        "numbers in a list": ["1", "2"],
        "list of bytes": [[72, 105]],
        "empty": "",
        "no bytes": [],
    }
    records = raw.journal_records(lines_of(spark, *({**entry, "MESSAGE": m, "_COMM": k} for k, m in forms.items())))
    got = {r["_COMM"]: r["MESSAGE"] for r in records.collect()}
    assert got == {
        "plain": "text", "bracket": "[not, an array]", "number": "42", "null": None, "bytes": "é [x]",
        "bad bytes": "H�i", "signed bytes": "é", "list": "new", "numbers in a list": "2",
        "list of bytes": "[72,105]", "empty": "", "no bytes": got["no bytes"],
    }
    row = records.first()
    assert (row.host_id, row.realtime_us, row.PRIORITY) == ("h", 1704067200000001, "3")


def test_lines_that_are_no_journal_entries(spark):
    got = raw.journal_records(lines_of(spark, "", "not json", "{", "[1]", "{}", '{"_HOSTNAME": "h"}')).collect()
    assert sorted((r.host_id or "", r.realtime_us) for r in got) == [("", None), ("", None), ("h", None)]


def test_runtime_bodies(spark, tmp_path):
    listed = {
        "host_id": "h", "ts": "2024-01-12T00:00:00Z",
        "body": [
            {"Id": "c1", "Names": ["/web"], "Image": "img:1", "State": "running", "Labels": {"a": "b"},
             "Mounts": [{"Source": "/x", "RW": True}, {}], "Created": 1704931200, "More": {"x": []}},
            {"Id": "c2", "Names": None, "State": "exited"},
        ],
    }
    stats = [
        {"host_id": "h", "body": {"id": "c1", "read": "2024-01-12T00:00:01.5Z", "cpu_stats": {"cpu_usage": {"total_usage": 2**64 - 1}}}},
        {"host_id": "h", "ts": "2024-01-12T00:00:02Z", "body": {"id": "c2", "memory_stats": {"stats": {"Cache": 7}}}},
        "broken {",
        {"host_id": "h", "ts": "2024-01-12T00:00:02Z"},
    ]
    inspect = {"host_id": "h", "body": {"Id": "c1", "State": {"Health": {"Status": "healthy"}}}}
    for name, records in {"list": [listed], "stats": stats, "inspect": [inspect]}.items():
        lines_of(spark, *records).write.text(f"{tmp_path}/docker_{name}")
    rows = metric_registry().collect(spark, ["docker"], {"path": str(tmp_path), "format": "raw"}).collect()
    by_name = {(r.dimensions["container_id"], r["name"]): r for r in rows}
    assert by_name["c1", "cpu_total_usage"].value == float(2**64 - 1)
    assert by_name["c1", "running"].dimensions["mount_count"] == "2"
    assert by_name["c1", "running"].dimensions["health_status"] == "healthy"
    assert by_name["c1", "running"].ts.microsecond == 500_000
    assert by_name["c2", "mem_cache"].value == 7 and by_name["c2", "running"].value == 0
    assert {k for k, _ in by_name} == {"c1", "c2"}


def test_first_auth_log_of_a_host_counts(spark, tmp_path):
    files = {
        "a/auth.log": "Apr 26 07:15:01 box sshd[1]: not this one\n",
        "a/secure": "Apr 26 07:15:01 box sshd[1]: this one\n",
        "b/auth.log": "Apr 26 07:15:01 box sshd[1]: and this\nshort\n",
        "b/kern.log": "Apr 26 07:15:01 box kernel: no auth log\n",
    }
    for name, text in files.items():
        path = tmp_path / "syslog" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    options = {"path": str(tmp_path), "format": "raw", "ref_ts": "2024-05-01"}
    logs = log_registry().collect(spark, ["security"], options)
    got = sorted((r.host_id, r.message, r.labels["log_path"]) for r in logs.collect())
    assert got == [("a", "this one", "/var/log/secure"), ("b", "and this", "/var/log/auth.log")]
    assert logs.agg(F.max("ts")).first()[0].year == 2024
