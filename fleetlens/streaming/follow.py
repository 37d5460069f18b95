"""Follow log files that grow and are rotated, as a stream source.

``spark.readStream.format("followed_lines")`` reads ``<path>/<host>/<name>`` of every host. The
offset holds a byte position for each file identity, and an identity is the host and
the file's first line: a file keeps it when rotation renames it or copies it before truncating,
and what takes its name afterwards has another. So the rest of a rotated file is read first
to its end, then the new one from its beginning, and a restart goes on at the byte.
Only complete lines count; a line without an end waits for the next batch.

Options: ``path``, ``names`` (comma-separated; the first one that a host has is followed), and
``split_bytes``, above which what is new in a file is read by several tasks. A file that begins
with the same line as another one of its host is refused, because lines would be lost.
Compressed rotated files are not looked at.
"""

from __future__ import annotations

import hashlib
import posixpath
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source is sent to the workers as code, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINES = "host_id string, value string, path string, file string, position long"
_BLOCK = 1 << 16
_BATCH = 8192


@dataclass
class Stretch(InputPartition):
    """Bytes of one file; lines that begin in them belong to it."""

    host: str
    path: str
    file: str
    begin: int
    end: int
    inside: bool

    def __post_init__(self) -> None:
        super().__init__(None)


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


def _first_line(file) -> bytes | None:
    file.seek(0)
    held = b""
    while b"\n" not in held:
        got = file.read(_BLOCK)
        if not got:
            return None
        held += got
    return held[: held.index(b"\n")]


def _last_end(file, size: int, floor: int) -> int:
    """Where the last complete line ends, at ``floor`` or after it."""
    at = size
    while at > floor:
        begin = max(floor, at - _BLOCK)
        file.seek(begin)
        found = file.read(at - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        at = begin
    return floor


def _identity(host: str, line: bytes) -> str:
    return hashlib.sha256(host.encode() + b"\0" + line).hexdigest()[:32]


class FollowReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.root = options["path"].rstrip("/")
        self.names = [n.strip() for n in options.get("names", "secure,auth.log").split(",")]
        self.split = int(options.get("split_bytes", 64 << 20))
        self.seen: dict[str, tuple] = {}  # path to (size, change time, identity, end of the last line)

    def files(self) -> dict[str, tuple[str, str, int]]:
        """Identity to (host, path, end of the last complete line)."""
        store, root = _store(self.root)
        by_host: dict[str, dict[str, list]] = {}
        for info in store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            folder, base = posixpath.split(info.path)
            host = posixpath.relpath(folder, root)
            for name in self.names:
                rotated = base.startswith(f"{name}.") and not base.endswith((".gz", ".xz", ".zst", ".bz2"))
                if info.is_file and (base == name or rotated):
                    by_host.setdefault(host, {}).setdefault(name, []).append(info)
        found: dict[str, tuple[str, str, int]] = {}
        for host, named in by_host.items():
            for info in named[next(n for n in self.names if n in named)]:
                known = self.seen.get(info.path)
                if not known or known[:2] != (info.size, info.mtime_ns):
                    with store.open_input_file(info.path) as file:
                        line = _first_line(file)
                        own = None if line is None else _identity(host, line)
                        floor = known[3] if known and known[2] == own and info.size >= known[3] else 0
                        known = (info.size, info.mtime_ns, own, _last_end(file, info.size, floor) if own else 0)
                    self.seen[info.path] = known
                if known[2] is None:
                    continue
                if known[2] in found:
                    raise ValueError(f"{info.path} and {found[known[2]][1]} begin with the same line")
                found[known[2]] = (host, info.path, known[3])
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {file: end for file, (_, _, end) in self.files().items()}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        places, out = self.files(), []
        for file, stop in end.items():
            begin = start.get(file, 0)
            if stop > begin and file not in places:
                raise ValueError(f"a followed file is gone before it was read: {file}, bytes {begin} to {stop}")
            for at in range(begin, stop, self.split):
                host, path, _ = places[file]
                out.append(Stretch(host, path, file, at, min(at + self.split, stop), at > begin))
        return out

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        store, path = _store(self.root)[0], part.path
        with store.open_input_file(path) as file:
            line = _first_line(file)
        if line is None or _identity(part.host, line) != part.file:
            # Rotated since the batch was planned.
            path = self.files()[part.file][1]
        with store.open_input_file(path) as file:
            yield from self._lines(file, part)

    def _lines(self, file, part: Stretch) -> Iterator[pa.RecordBatch]:
        at, held = part.begin, b""
        if part.inside:
            # A line that began before belongs to the stretch before.
            at -= 1
            file.seek(at)
            while b"\n" not in held:
                got = file.read(_BLOCK)
                if not got:
                    return
                held += got
            cut = held.index(b"\n") + 1
            at, held = at + cut, held[cut:]
        file.seek(at + len(held))
        rows: list[tuple[bytes, int]] = []
        while at < part.end:
            cut = held.find(b"\n")
            if cut < 0:
                got = file.read(_BLOCK)
                if not got:
                    break
                held += got
                continue
            done = held.rfind(b"\n") + 1
            for line in held[: done - 1].split(b"\n"):
                if at >= part.end:
                    break
                rows.append((line, at))
                at += len(line) + 1
            held = held[done:]
            if len(rows) >= _BATCH:
                yield self._batch(rows, part)
                rows = []
        if rows:
            yield self._batch(rows, part)

    def _batch(self, rows: list[tuple[bytes, int]], part: Stretch) -> pa.RecordBatch:
        n = len(rows)
        return pa.record_batch(
            [
                pa.array([part.host] * n),
                pa.array([line.decode("utf-8", "replace").removesuffix("\r") for line, _ in rows]),
                pa.array([part.path] * n),
                pa.array([part.file] * n),
                pa.array([at for _, at in rows], pa.int64()),
            ],
            names=["host_id", "value", "path", "file", "position"],
        )


class FollowedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "followed_lines"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> FollowReader:
        return FollowReader(dict(self.options))


def follow(spark: SparkSession, path: str, names: list[str], split_bytes: int = 64 << 20):
    """Lines of the hosts' log files as a stream."""
    spark.dataSource.register(FollowedLines)
    reader = spark.readStream.format("followed_lines").option("path", path).option("names", ",".join(names))
    return reader.option("split_bytes", split_bytes).load()
