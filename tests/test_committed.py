"""Committed output: jobs that run twice, die half-way or go on where the last one ended."""

from __future__ import annotations

import pytest

from fleetlens.sinks.committed import Committed, resume
from fleetlens.sinks.files import append_ndjson, read_ndjson

ROWS = "host string, source string, at long, tie long, value double"


def rows_of(spark, times, host="h"):
    return spark.createDataFrame([(host, "s", at, tie, at / 2) for at, tie in times], ROWS)


def shown(frame):
    return sorted((r.host or "", r.at, r.tie) for r in frame.collect())


def test_a_job_counts_once(spark, tmp_path):
    path, rows = str(tmp_path / "out"), rows_of(spark, [(1, 1), (2, 1)])
    assert read_ndjson(spark, path, rows.schema).count() == 0
    assert append_ndjson(rows, path, job_id="day=1/a b") is True
    assert append_ndjson(rows, path, job_id="day=1/a b") is False
    assert append_ndjson(rows, path, job_id="12e5") is True
    assert append_ndjson(rows, path) is True and append_ndjson(rows, path) is True
    assert read_ndjson(spark, path, rows.schema).count() == 8
    empty = str(tmp_path / "empty")
    append_ndjson(rows.limit(0), empty, job_id="none")
    assert read_ndjson(spark, empty, rows.schema).count() == 0


def test_staged_rows_do_not_count_and_the_least_attempt_does(spark, tmp_path):
    store, rows = Committed(spark, str(tmp_path / "out")), rows_of(spark, [(1, 1)])
    store.stage(rows, "data", "job", "a-dead")
    assert store.read("data", rows.schema).count() == 0
    for attempt in ("c", "b"):  # two runs of one job that did not see each other
        store.stage(rows, "data", "job", attempt)
        store.commit("job", attempt)
    assert store.read("data", rows.schema).count() == 1
    assert [r["__attempt"] for r in store.attempts().collect()] == ["b"]


def test_growing_capture_is_taken_once(spark, tmp_path):
    path, keys = str(tmp_path / "out"), ["host", "source"]
    first = rows_of(spark, [(1, 1), (2, 1), (2, 2)]).unionByName(rows_of(spark, [(9, 1)], None))
    later = first.unionByName(rows_of(spark, [(2, 3), (5, 0)])).unionByName(rows_of(spark, [(1, 1)], "new"))
    resume(first.limit(0), path, "zero", keys, "at", "tie")
    assert resume(first, path, "one", keys, "at", "tie")
    assert resume(later, path, "two", keys, "at", "tie")
    assert not resume(later, path, "two", keys, "at", "tie")
    assert resume(later, path, "three", keys, "at", "tie")
    assert shown(Committed(spark, path).read("data", later.schema, "parquet")) == shown(later)


@pytest.mark.parametrize("dies_in", ["stage", "commit"])
def test_killed_between_write_and_commit(spark, tmp_path, monkeypatch, dies_in):
    path, keys = str(tmp_path / "out"), ["host", "source"]
    rows = rows_of(spark, [(1, 1), (2, 1), (3, 1)])
    resume(rows.filter("at < 2"), path, "one", keys, "at", "tie")
    calls, real = [], getattr(Committed, dies_in)

    def die(self, *args, **more):
        calls.append(args)
        if dies_in == "stage" and len(calls) == 1:  # rows are written, the cursor is not
            return real(self, *args, **more)
        raise KeyboardInterrupt

    monkeypatch.setattr(Committed, dies_in, die)
    with pytest.raises(KeyboardInterrupt):
        resume(rows, path, "two", keys, "at", "tie")
    monkeypatch.undo()
    store = Committed(spark, path)
    assert shown(store.read("data", rows.schema, "parquet")) == [("h", 1, 1)]
    assert resume(rows, path, "two", keys, "at", "tie")
    assert shown(store.read("data", rows.schema, "parquet")) == shown(rows)
