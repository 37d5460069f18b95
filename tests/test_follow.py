"""Following log files: growth, rotation, restarts, stretches."""

from __future__ import annotations

import os
import random
import shutil

import pytest

from fleetlens.options import StreamOptions
from fleetlens.streaming import jobs
from fleetlens.streaming.follow import FollowReader, follow


def look(reader: FollowReader, start: dict) -> tuple[list[str], dict]:
    """What one batch from ``start`` reads, and its end."""
    end = reader.latestOffset()
    rows = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            rows += list(zip(batch.column("position").to_pylist(), batch.column("value").to_pylist()))
    return [v for _, v in rows], end


def reader_of(root, **more) -> FollowReader:
    return FollowReader({"path": str(root), "names": "secure,auth.log", **more})


def put(path, text, mode="a"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode, newline="") as out:
        out.write(text)


def test_growth_and_rename(tmp_path):
    log = tmp_path / "h1" / "auth.log"
    assert look(reader_of(tmp_path), {}) == ([], {})
    put(log, "one\ntwo\nhalf")
    got, at = look(reader_of(tmp_path), {})
    assert got == ["one", "two"] and list(at.values()) == [8]
    put(log, " line\r\n")
    got, at = look(reader_of(tmp_path), at)
    assert got == ["half line"]
    put(log, "last of the old\n")
    os.rename(log, tmp_path / "h1" / "auth.log.1")
    put(log, "new\n")
    got, at = look(reader_of(tmp_path), at)
    assert sorted(got) == ["last of the old", "new"]
    os.rename(tmp_path / "h1" / "auth.log.1", tmp_path / "h1" / "auth.log.2")
    os.rename(log, tmp_path / "h1" / "auth.log.1")
    assert look(reader_of(tmp_path), at) == ([], at)


def test_copied_and_truncated(tmp_path):
    log = tmp_path / "h1" / "auth.log"
    put(log, "one\ntwo\n")
    same = reader_of(tmp_path)
    _, at = look(same, {})
    put(log, "three\n")
    shutil.copy(log, tmp_path / "h1" / "auth.log.1")
    put(log, "other beginning\nfour\n", "w")
    got, at = look(same, at)
    assert sorted(got) == ["four", "other beginning", "three"]
    assert look(same, at)[0] == []


def test_rotated_between_plan_and_read(tmp_path):
    log = tmp_path / "h1" / "auth.log"
    put(log, "one\ntwo\n")
    reader = reader_of(tmp_path)
    parts = reader.partitions({}, reader.latestOffset())
    os.rename(log, tmp_path / "h1" / "auth.log.1")
    put(log, "new\n")
    assert [v for b in reader.read(parts[0]) for v in b.column("value").to_pylist()] == ["one", "two"]


def test_first_name_and_other_files(tmp_path):
    put(tmp_path / "h1" / "auth.log", "not this\n")
    put(tmp_path / "h1" / "secure", "this\n")
    put(tmp_path / "h1" / "secure.1.gz", "packed\n")
    put(tmp_path / "h2" / "auth.log", "and this\n")
    put(tmp_path / "h2" / "auth.logger", "nor this\n")
    assert sorted(look(reader_of(tmp_path), {})[0]) == ["and this", "this"]


def test_lost_and_alike_files_are_errors(tmp_path):
    put(tmp_path / "h1" / "auth.log", "same\nx\n")
    reader = reader_of(tmp_path)
    end = reader.latestOffset()
    os.remove(tmp_path / "h1" / "auth.log")
    with pytest.raises(ValueError, match="gone"):
        reader.partitions({}, end)
    put(tmp_path / "h1" / "auth.log", "same\n")
    put(tmp_path / "h1" / "auth.log.1", "same\nx\n")
    with pytest.raises(ValueError, match="same line"):
        reader.latestOffset()


@pytest.mark.parametrize("split", [1, 3, 10, 1000])
def test_stretches_share_out_the_lines(tmp_path, split):
    rng = random.Random(split)
    lines = ["x" * rng.choice([0, 1, 2, 9, 200]) + str(i) for i in range(60)]
    put(tmp_path / "h" / "auth.log", "".join(f"{line}\n" for line in lines))
    got, end = look(reader_of(tmp_path, split_bytes=str(split)), {})
    assert got == lines
    half = {f: n for f, n in end.items()}
    put(tmp_path / "h" / "auth.log", "é\n\nlast\n")
    assert look(reader_of(tmp_path, split_bytes=str(split)), half)[0] == ["é", "", "last"]


def test_stream_resumes_at_the_byte(spark, tmp_path):
    log, opts = tmp_path / "logs" / "h1" / "auth.log", StreamOptions(str(tmp_path / "out"), str(tmp_path / "cp"))

    def run():
        jobs.write_rows(follow(spark, str(tmp_path / "logs"), ["auth.log"]), opts, "followed").awaitTermination()
        return sorted(r.value for r in spark.read.parquet(opts.output).collect())

    put(log, "a\nb\nc")
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    put(log, "c\nd\n")
    os.rename(log, tmp_path / "logs" / "h1" / "auth.log.1")
    put(log, "e\n")
    assert run() == ["a", "b", "cc", "d", "e"]
