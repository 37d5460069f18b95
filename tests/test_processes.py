"""Process snapshots and their heaviest processes."""

from __future__ import annotations

import datetime as dt

import pytest

from fleetlens import schemas
from fleetlens.operators.topn import top_processes
from fleetlens.sources.processes import process_payloads, process_rows

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def snapshot(spark, loads, host="h"):
    """Processes with pids 1.. and the given (cpu, mem) loads."""
    rows = [
        (host, T0, i + 1, None, None, "cmd", None, cpu, mem, None, 1500)
        for i, (cpu, mem) in enumerate(loads)
    ]
    return process_rows(spark.createDataFrame(rows, schemas.RAW_PROCESS))


def brute(loads, n, compat):
    pids = range(1, len(loads) + 1)
    by_cpu = sorted(pids, key=lambda p: (-(loads[p - 1][0] or 0), p))
    by_mem = sorted(pids, key=lambda p: (-(loads[p - 1][1] or 0), p))
    return set(by_cpu[: 2 * n]) if compat else set(by_cpu[:n]) | set(by_mem[:n])


@pytest.mark.parametrize("size", [3, 25, 60])
@pytest.mark.parametrize("compat", [False, True])
def test_top_processes(spark, size, compat):
    loads = [(float((i * 37) % 11), float((i * 53) % 17)) for i in range(size)]
    got = top_processes(snapshot(spark, loads), 20, compat).collect()
    assert {r.pid for r in got} == brute(loads, 20, compat)
    assert len(got) == len({r.pid for r in got})


def test_unreadable_attributes_are_zero(spark):
    row = snapshot(spark, [(None, None)]).first()
    assert (row.ppid, row.executable, row.user, row.cpu_percent, row.mem_percent, row.threads) == (0, "", "", 0, 0, 0)
    assert row.labels == {} and row.start_time.microsecond == 500_000


def test_payload_is_one_row_per_snapshot(spark):
    both = snapshot(spark, [(1.0, 0.0), (9.0, 0.0)]).unionByName(snapshot(spark, [(2.0, 0.0)], "g"))
    got = {r.host_id: [p.pid for p in r.processes] for r in process_payloads(both).collect()}
    assert got == {"h": [2, 1], "g": [1]}


def test_only_group_tops_are_shuffled(spark, sf_dir):
    from fleetlens.plans import q_processes

    df = top_processes(q_processes.processes(spark, sf_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # before and after the shuffle, twice
