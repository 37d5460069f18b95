"""Streams: the same results as batch, over several files and restarts."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators.rates import sample_rates
from fleetlens.operators.rollup import stat_rollup
from fleetlens.options import LogOptions, MetricOptions, ProcessOptions, StreamOptions
from fleetlens.sources.syslog import auth_logs
from fleetlens.streaming import jobs

SAMPLE = (
    "id string, ts timestamp, cpu_total decimal(20,0), cpu_system decimal(20,0), online int, "
    "rx decimal(20,0), tx decimal(20,0)"
)
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
COLUMNS = ["cpu_percent", "rx_rate", "tx_rate", "reset"]


def sample(i, second, cpu, rx=0):
    return (i, T0 + dt.timedelta(seconds=second), Decimal(cpu), Decimal(second * 100), 2, Decimal(rx), Decimal(5))


def put(spark, rows, schema, folder, stamp):
    """Write one file with a fixed change time, as rotation does."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    for name in os.listdir(folder):
        path = os.path.join(folder, name)
        if name.endswith(".parquet") and os.path.getmtime(path) > 1_600_000_000:
            os.utime(path, (stamp, stamp))


def options(tmp_path, **more):
    return StreamOptions(output=str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), **more)


def test_rates_equal_batch_across_files_and_restarts(spark, tmp_path):
    folder = str(tmp_path / "in")
    first = [sample("a", 0, 10), sample("b", 1, 2**64 - 9), sample("a", 4, 30, 100), sample("a", 2, 20)]
    second = [sample("a", 6, 5), sample("b", 9, 2**64 - 1, 2**63 + 5)]
    put(spark, first, SAMPLE, folder, 1000)
    opts = options(tmp_path, max_files_per_trigger=1)

    def run():
        stream = jobs.read_files(spark, folder, SAMPLE, "parquet", 1)
        jobs.rate_stream(stream, "id", opts).awaitTermination()

    run()
    put(spark, second, SAMPLE, folder, 2000)
    run()  # a new query on the same checkpoint: state and position are kept
    run()  # nothing new: nothing is written twice
    streamed = spark.read.parquet(opts.output).select(F.col("series").alias("id"), "ts", *COLUMNS)
    batch = sample_rates(spark.createDataFrame(first + second, SAMPLE), ["id"], ["ts"], 60)
    assert sorted(streamed.collect()) == sorted(batch.select("id", "ts", *COLUMNS).collect())


def test_null_counters_stay_null_as_in_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    null = lambda second: ("a", T0 + dt.timedelta(seconds=second), None, Decimal(second * 100), 2, None, Decimal(5))
    first, second = [sample("a", 0, 500, 700), null(2)], [null(4), sample("a", 6, 600, 900), sample("a", 8, 800, 1000)]
    put(spark, first, SAMPLE, folder, 1000)
    put(spark, second, SAMPLE, folder, 2000)
    opts = options(tmp_path)
    jobs.rate_stream(jobs.read_files(spark, folder, SAMPLE, "parquet", 1), "id", opts).awaitTermination()
    streamed = spark.read.parquet(opts.output).select("ts", "cpu_total", "rx", *COLUMNS)
    batch = sample_rates(spark.createDataFrame(first + second, SAMPLE), ["id"], ["ts"], 60)
    assert sorted(streamed.collect()) == sorted(batch.select("ts", "cpu_total", "rx", *COLUMNS).collect())
    assert streamed.filter("reset").count() == 0 and streamed.filter("cpu_total IS NULL").count() == 2


def test_rollup_of_files_that_cut_intervals(spark, tmp_path):
    folder = str(tmp_path / "m")
    first = [metric(s, float(s)) for s in (0, 5, 61)] + [metric(3, 9.0, "other"), metric(4, None, "empty")]
    second = [metric(s, float(s)) for s in (7, 59, 62)]
    put(spark, first, schemas.METRIC, folder, 1000)
    put(spark, second, schemas.METRIC, folder, 2000)
    put(spark, [metric(400, 1.0)], schemas.METRIC, folder, 3000)
    put(spark, [metric(30, 30.0), metric(31, 32.0)], schemas.METRIC, folder, 4000)
    put(spark, [metric((END - T0).total_seconds(), 0.0)], schemas.METRIC, folder, 5000)
    opts = options(tmp_path, delay="2 minutes", end=str(END.replace(tzinfo=None)))
    jobs.rollup_stream(jobs.read_files(spark, folder, schemas.METRIC, "parquet", 1), 60, opts).awaitTermination()
    columns = ["name", "ts", "value", "dimensions", "stats", "storage_resolution"]
    shown = lambda df: sorted((str(r) for r in df.select(*columns).collect()))
    batch = stat_rollup(spark.createDataFrame([*first, *second, metric(400, 1.0)], schemas.METRIC), 60)
    assert shown(spark.read.parquet(opts.output)) == shown(batch)
    (late,) = spark.read.parquet(jobs.late_folder(opts)).collect()
    assert (late.stats.sample_count, late.stats.sum, late.value) == (2, 62.0, 31.0)


def state_rows(query):
    query.awaitTermination()
    return max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])


def test_rollup_of_many_series_keeps_few_state_rows(spark, tmp_path):
    folder = str(tmp_path / "m")
    pieces = [[metric(s, float(i % 7) if i % 11 else None, f"m{i}") for i in range(1500) for s in at] for at in ((0, 5, 70), (6, 75, 130), (7,))]
    for k, piece in enumerate(pieces):
        put(spark, piece, schemas.METRIC, folder, 1000 + k)
    put(spark, [metric((END - T0).total_seconds(), 0.0)], schemas.METRIC, folder, 5000)
    opts = options(tmp_path, delay="5 minutes", end=str(END.replace(tzinfo=None)))
    assert state_rows(jobs.rollup_stream(jobs.read_files(spark, folder, schemas.METRIC, "parquet", 1), 60, opts)) < 1500
    columns = ["name", "ts", "value", "dimensions", "stats", "storage_resolution"]
    shown = lambda df: sorted((str(r) for r in df.select(*columns).collect()))
    batch = stat_rollup(spark.createDataFrame([r for piece in pieces for r in piece], schemas.METRIC), 60)
    assert shown(spark.read.parquet(opts.output)) == shown(batch)


def test_ticks_of_many_endpoints_keep_few_state_rows(spark, tmp_path):
    folder = str(tmp_path / "m")
    put(spark, [metric(s, float(i), "a\n\\n\"b", f"h{i}") for i in range(1200) for s in (0, 70)], schemas.METRIC, folder, 1000)
    put(spark, [metric(9, float(i), "c", f"h{i}") for i in range(1200)], schemas.METRIC, folder, 2000)
    put(spark, [metric((END - T0).total_seconds(), 0.0)], schemas.METRIC, folder, 3000)
    opts = options(tmp_path, delay="5 minutes", end=str(END.replace(tzinfo=None)))
    stream = jobs.read_files(spark, folder, schemas.METRIC, "parquet", 1)
    assert state_rows(jobs.metric_stream(stream, 60, opts, MetricOptions(max_points=10))) < 1200
    got = sorted((r.host_id, int(r.tick.timestamp() - T0.timestamp()), [(m.name, m.value) for m in r.metrics]) for r in spark.read.parquet(opts.output).collect())
    name = "a\n\\n\"b"
    whole = lambda i: [(f"h{i}", 0, [(name, float(i)), ("c", float(i))]), (f"h{i}", 60, [(name, float(i))])]
    assert got == sorted(x for i in range(1200) for x in whole(i))


def test_three_exports_from_one_entry(spark, tmp_path):
    import json

    from fleetlens.functions.resource import meta_struct

    files = {
        "host_net": [{"host_id": "h", "ts": f"2024-01-01T00:00:{s:02d}Z", "interfaces": [{"name": "e", "bytes_sent": s}]} for s in (1, 2)]
        + [{"host_id": "h", "ts": "2030-01-01T00:00:00Z", "interfaces": [{"name": "e", "bytes_sent": 9}]}],
        "syslog": [{"host_id": "h", "value": f"Jan {d} 07:15:01 h sshd[1]: Failed password", "path": "p", "ref_ts": "2024-01-20T00:00:00Z"} for d in (1, 1, 9)],
        "processes": [{"host_id": "h", "snapshot_ts": t, "pid": p, "cpu_percent": float(p)} for t in ("2024-01-01T00:00:00Z", "2030-01-01T00:00:00Z") for p in range(50)],
    }
    for name, rows in files.items():
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "1.json").write_text("\n".join(json.dumps(r) for r in rows))
    record = meta_struct({"host_id": F.lit("h"), "hostname": F.lit("box"), "agent_id": F.lit("a1")})
    meta = spark.range(1).select(record.alias("m")).select("m.*")
    runs = jobs.start_exports(
        spark, {"path": str(tmp_path / "in")}, meta, T0, str(tmp_path / "out"),
        MetricOptions(sources=("net",)), LogOptions(sources=("security",), batch_size=1), ProcessOptions(top_n=2), once=True,
    )
    for run in runs.values():
        run.awaitTermination()
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    (points,) = read("metrics").collect()
    assert len(points.resource_metrics[0].scope_metrics[0].metrics) == 2 and points.hostname == "box"
    assert sorted(r["batch"] for r in read("logs").collect()) == [0, 1]
    (top,) = read("processes").collect()
    assert [p.pid for p in top.processes] == [49, 48, 1, 0] and (top.agent_id, top.hostname) == ("a1", "box")


def test_late_and_repeated_samples_are_passed_on(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, [sample("a", 0, 10), sample("a", 10, 20), sample("a", 10, 20)], SAMPLE, folder, 1000)
    put(spark, [sample("a", 5, 15), sample("a", 10, 20), sample("a", 12, 30)], SAMPLE, folder, 2000)
    opts = options(tmp_path)
    jobs.rate_stream(jobs.read_files(spark, folder, SAMPLE, "parquet", 1), "id", opts).awaitTermination()
    got = spark.read.parquet(opts.output)
    second = (F.unix_seconds("ts") - int(T0.timestamp())).alias("second")
    rows = sorted(tuple(r) for r in got.select(second, "late", "cpu_percent").collect())
    assert [r[:2] for r in rows] == [(0, False), (5, True), (10, False), (10, False), (10, True), (12, False)]
    assert all(r[2] == 0 for r in rows if r[1]) and rows[-1][2] == 10 / 200 * 2 * 100


def test_log_stream_from_text_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "auth.log").write_text(
        "Apr 26 07:15:01 box sshd[1]: Failed password\nshort\nApr 26 07:15:02 box sshd[1]: Accepted key\n"
    )
    raw = spark.readStream.text(str(tmp_path / "in")).select(
        F.lit("box").alias("host_id"),
        "value",
        F.lit("/var/log/auth.log").alias("path"),
        F.lit("2024-05-01").cast("timestamp").alias("ref_ts"),
    )
    opts = options(tmp_path)
    jobs.log_stream(auth_logs(raw), opts).awaitTermination()
    assert sorted(r.level for r in spark.read.parquet(opts.output).collect()) == ["info", "warn"]


END = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)


def metric(second, value, name="m", host="h"):
    return (host, "N", "S", name, T0 + dt.timedelta(seconds=second), value, "gauge", "u", {"k": "v"}, None, 0)


def test_ticks_cut_by_files_give_one_set_of_payloads(spark, tmp_path):
    folder = str(tmp_path / "m")
    put(spark, [metric(s, float(s)) for s in (0, 5, 61)], schemas.METRIC, folder, 1000)
    put(spark, [metric(s, float(s)) for s in (7, 59, 62)], schemas.METRIC, folder, 2000)
    put(spark, [metric(400, float("nan"))], schemas.METRIC, folder, 3000)
    opts = options(tmp_path, delay="2 minutes", end=str(END.replace(tzinfo=None)), max_files_per_trigger=1)

    def run():
        stream = jobs.read_files(spark, folder, schemas.METRIC, "parquet", 1)
        jobs.metric_stream(stream, 60, opts, MetricOptions(max_points=3)).awaitTermination()

    run()
    shown = lambda: sorted(
        (int(r.tick.timestamp() - T0.timestamp()), r.part, r.parts, [m.value for m in r.metrics])
        for r in spark.read.parquet(opts.output).collect()
    )
    assert shown() == [(0, 0, 2, [0.0, 5.0, 7.0]), (0, 1, 2, [59.0]), (60, 0, 1, [61.0, 62.0])]
    # The last tick is open; a row of the first one is late, after a restart.
    put(spark, [metric(30, 30.0), metric((END - T0).total_seconds(), 0.0)], schemas.METRIC, folder, 4000)
    run()
    assert [x[:3] for x in shown()] == [(0, 0, 2), (0, 1, 2), (60, 0, 1), (360, 0, 1)]
    (late,) = spark.read.parquet(jobs.late_folder(opts)).collect()
    assert late.value == 30.0 and late.dimensions == {"k": "v"} and late.ts.timestamp() - T0.timestamp() == 30
    run()
    assert len(shown()) == 4


def process(pid, cpu, mem=0.0, at=T0):
    return ("h", at, pid, 0, "", "", "", cpu, mem, 1, None, {})


def test_snapshot_cut_by_files_gives_one_top_list(spark, tmp_path):
    folder = str(tmp_path / "p")
    procs = [process(p, float(p)) for p in range(60)]
    for k in range(3):
        put(spark, procs[k::3], schemas.PROCESS, folder, 1000 + k)
    put(spark, [process(1, 0.0, at=T0 + dt.timedelta(hours=1))], schemas.PROCESS, folder, 2000)
    put(spark, [process(99, 99.0)], schemas.PROCESS, folder, 3000)
    opts = options(tmp_path)
    jobs.process_stream(jobs.read_files(spark, folder, schemas.PROCESS, "parquet", 1), opts).awaitTermination()
    (row,) = spark.read.parquet(opts.output).collect()
    # top 20 by CPU are 59..40; all memory loads tie, so the lowest pids follow
    assert [p.pid for p in row.processes] == [*range(59, 39, -1), *range(19, -1, -1)]
    assert [r.pid for r in spark.read.parquet(jobs.late_folder(opts)).collect()] == [99]


def test_held_candidates_are_bounded():
    from fleetlens.streaming.closing import HeldTop

    class Rows:
        def __init__(self):
            self.own = []

        def get(self):
            return iter(self.own)

        def put(self, rows):
            self.own = rows

    import json
    import pandas as pd

    top = HeldTop(("cpu", "mem"), "pid", 3)
    top.rows = Rows()
    for start in range(0, 1000, 100):
        rows = [json.dumps({"pid": p, "cpu": p % 17, "mem": -p}) for p in range(start, start + 100)]
        top.keep(pd.DataFrame({"row": rows}))
        assert len(top.rows.own) <= 6
    pids = sorted(json.loads(r[0])["pid"] for r in top.rows.own)
    assert pids == sorted({16, 33, 50, 0, 1, 2})


def test_another_checkpoint_leaves_earlier_output_alone(spark, tmp_path):
    for k in (1, 2):
        folder = str(tmp_path / f"in{k}")
        put(spark, [process(k, 1.0), process(1, 0.0, at=END)], schemas.PROCESS, folder, 1000)
        opts = StreamOptions(str(tmp_path / "out"), str(tmp_path / f"cp{k}"), end=str(END.replace(tzinfo=None)))
        jobs.process_stream(jobs.read_files(spark, folder, schemas.PROCESS, "parquet"), opts).awaitTermination()
    assert sorted(r.processes[0].pid for r in spark.read.parquet(opts.output).collect()) == [1, 2]


def test_batch_that_runs_again_overwrites_its_folder(spark, tmp_path):
    handled = []

    class Recorder:
        def foreachBatch(self, fn):
            handled.append(fn)
            return self

        def start(self):
            return self

    original, jobs._start = jobs._start, lambda *a: Recorder()
    try:
        jobs.write_batches(None, lambda b: b, options(tmp_path), "x")
    finally:
        jobs._start = original
    for _ in range(2):
        handled[0](spark.range(3), 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_start_policy(spark):
    rows = spark.createDataFrame(
        [(T0 - dt.timedelta(minutes=m),) for m in (0, 5, 6)], "ts timestamp"
    )
    assert jobs.recent_only(rows, T0).count() == 2


def test_rollup_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [
        ("h", "N", "S", "m", T0 + dt.timedelta(minutes=m), float(m), "gauge", "u", {"k": "v"}, None, 0)
        for m in (1, 2, 61, 200)
    ]
    put(spark, rows, schemas.METRIC, folder, 1000)
    stream = jobs.read_files(spark, folder, schemas.METRIC, "parquet").withWatermark("ts", "1 minute")
    opts = options(tmp_path)
    jobs.write_rows(stat_rollup(stream, 3600), opts, "rollup").awaitTermination()
    got = sorted((r.stats.sample_count, r.stats.sum) for r in spark.read.parquet(opts.output).collect())
    assert got == [(1, 61.0), (2, 3.0)]
