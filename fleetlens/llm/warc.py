"""WARC archives: write pages, read archives back and salvage what damage leaves.

Writing: one gzip member for each record. Of pages with equal payloads of ``least_bytes`` or
more, the one with the smallest id is a response and the others are revisits without a body,
which keep the HTTP head (so the length) and the digest of the full payload. Every attempt
of a task writes files of its own names; a table of the files that finished attempts wrote
is the archive's list, so an executor's loss leaves no half file in it.

Reading: a record counts only if its gzip member is whole, its version line, header and
length hold, and its block has the stated digest. Whether a record is a gzip member or plain
is decided at its own place. After a failed check the reader looks for the next member that
begins with a version line and the next plain version line, goes on from the nearer, and
returns the bytes in between as a gap.

A null payload is empty, a null URL leaves the target out, a page without an id is written
with the id ``null`` and never referred to. Repeated rows are records of their own; those
that share the smallest id are all responses. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import written
from fleetlens.session import work_folder

LEAST_BYTES = 100
ROLL_BYTES = 128 << 20
SALTS = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
END = b"\r\n\r\n"
# What a record may begin with, and the most bytes of that.
PLACE = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
PLACE_BYTES = 10
CHUNK = 1 << 20
# No header goes on behind this.
NEXT = re.compile(rb"\nWARC/1\.[01]\r?\n")


def with_record_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html) to rows with payload, digest, record type and the page referred to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    large = F.octet_length("payload") >= least_bytes
    shared = (
        rows.where(large)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    repeats = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (
        salted.join(shared, ["digest", "salt"], "left")
        .withColumn("refers_to", F.when(repeats, F.col("first_id")))
        .select("page_id", "url", "payload", "digest", "refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as bytes."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + END


def write(pages: DataFrame, folder: str | None = None, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the archive below ``folder``; returns its files (path, bytes, records), already written."""
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "warc")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, size, n = None, "", 0, 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in batch.itertuples(index=False, name=None):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    path, out = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None)
                ids = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                own, other = ids
                size += out.write(gzip.compress(record(own, url, payload, digest, other, date), 6, mtime=0))
                n += 1
                if size >= ROLL_BYTES:
                    out.close()
                    out = None
                    yield pd.DataFrame([(path, size, n)], columns=["path", "bytes", "records"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(path, size, n)], columns=["path", "bytes", "records"])

    typed = with_record_types(pages).select("page_id", "url", "payload", "digest", "refers_to")
    typed = typed.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return written(typed.mapInPandas(run, "path string, bytes long, records long"), "warc-files")


class Damaged(Exception):
    """A check failed; the text says which."""


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes


class Window:
    """Bytes of a file from a place on, read in chunks."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def move(self, at: int) -> None:
        inside = at - self.at
        self.held = self.held[inside:] if 0 <= inside <= len(self.held) else b""
        self.at = at

    def more(self) -> bool:
        """Hold another chunk; False at the end of the file."""
        place = self.at + len(self.held)
        if place >= self.size:
            return False
        self.file.seek(place)
        got = self.file.read(min(max(CHUNK, len(self.held)), self.size - place))
        self.held += got
        return bool(got)

    def fill(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        return self.held[:n]


def parse(data: bytes) -> tuple[Record, int]:
    """A record at the beginning of ``data`` and its length; IndexError if ``data`` is too short."""
    if not VERSION.match(data):
        if len(data) < 10:
            raise IndexError
        raise Damaged("no version line")
    stop = data.find(END)
    if stop < 0:
        if not NEXT.search(data):
            raise IndexError
        raise Damaged("header without end")
    fields = {}
    for line in data[:stop].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("bad header line")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("bad length")
    first = stop + len(END)
    last = first + int(length)
    if len(data) < last + len(END):
        raise IndexError
    if data[last : last + len(END)] != END:
        raise Damaged("record without end")
    block = data[first:last]
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise Damaged("block digest differs")
    return Record(fields, block), last + len(END)


def member(window: Window) -> tuple[Record, int]:
    """The record of the gzip member here, and the member's length."""
    inflate, data, used = zlib.decompressobj(wbits=31), [], 0
    while not inflate.eof:
        if used == len(window.held) and not window.more():
            raise Damaged("member cut short")
        piece = window.held[used : used + CHUNK]
        used += len(piece)
        try:
            data.append(inflate.decompress(piece))
        except zlib.error as error:
            raise Damaged("bad gzip member") from error
    whole = b"".join(data)
    try:
        found, length = parse(whole)
    except IndexError:
        raise Damaged("record cut short") from None
    if length != len(whole):
        raise Damaged("more than a record in a member")
    return found, used - len(inflate.unused_data)


def plain(window: Window) -> tuple[Record, int]:
    while True:
        try:
            return parse(window.held)
        except IndexError:
            if not window.more():
                raise Damaged("record cut short") from None


def begins_member(data: bytes) -> bool:
    try:
        return zlib.decompressobj(wbits=31).decompress(data, 16).startswith(b"WARC/1.")
    except zlib.error:
        return False


def own_line(data: bytes) -> int:
    """Where a member that stores its bytes as they are has its own version line; 0 for all others."""
    at = max(0, data.find(b"WARC/1."))
    try:
        inside = [zlib.decompressobj(wbits=31).decompress(data[:n]) for n in (at, at + 7)] if begins_member(data) else []
    except zlib.error:
        return 0
    return at if inside == [b"", b"WARC/1."] else 0


def next_place(window: Window) -> int:
    """The next place behind this one where a record may begin; the file's end if there is none."""
    window.move(window.at + own_line(window.fill(512)) + 1)
    while True:
        found = PLACE.search(window.held)
        while not found:
            window.move(window.at + max(0, len(window.held) - PLACE_BYTES + 1))
            if not window.more():
                return window.size
            found = PLACE.search(window.held)
        window.move(window.at + found.start())
        if found[0][:1] == b"W" or begins_member(window.fill(512)):
            return window.at
        window.move(window.at + 1)


def records(file, size: int) -> Iterator[tuple[int, int, Record | None, str | None]]:
    """(place, length, record, None) or, for a gap, (place, length, None, reason)."""
    window = Window(file, size)
    while window.at < size:
        at, start = window.at, window.fill(7)
        try:
            if start[:2] == b"\x1f\x8b":
                found, length = member(window)
            elif start == b"WARC/1.":
                found, length = plain(window)
            else:
                raise Damaged("no gzip member and no version line")
        except Damaged as reason:
            to = next_place(window)
            yield at, to - at, None, str(reason)
            window.move(to)
        else:
            yield at, length, found, None
            window.move(at + length)


COLUMNS = (
    "path string, place long, bytes long, gap string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)
MOST_TASKS = 100_000
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def read(spark: SparkSession, files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archive files in ``files.path``.

    A gap has a reason in ``gap``. The digest and length of a payload are computed from it
    (revisits: those of the header). ``payloads=False`` leaves the payloads out of the rows.
    """

    def row(path: str, place: int, length: int, found: Record | None, reason: str | None) -> tuple:
        if found is None:
            return path, place, length, reason, *[None] * 7
        get = found.fields.get
        head, _, body = found.block.partition(END)
        kind, digest, size = get("warc-type"), hashlib.sha256(body).hexdigest(), len(body)
        if kind == "revisit":
            digest = get("warc-payload-digest", "").removeprefix("sha256:")
            stated = re.search(rb"(?i)\ncontent-length:\s*(\d+)", head)
            size = int(stated[1]) if stated else None
        names = ("warc-record-id", "warc-target-uri", "warc-refers-to")
        return path, place, length, None, kind, *map(get, names), digest, size, body if payloads else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                store, inner = fs.FileSystem.from_uri(path)
                size, rows, held = store.get_file_info(inner).size, [], 0
                with store.open_input_file(inner) as file:
                    for place, length, found, reason in records(file, size):
                        rows.append(row(path, place, length, found, reason))
                        held += length
                        if held > CHUNK:
                            yield pd.DataFrame(rows, columns=NAMES).astype({"payload_bytes": "Int64"})
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=NAMES).astype({"payload_bytes": "Int64"})

    # A number that is stated is kept: a task for each file, however small the list of paths is.
    spread = files.select("path").repartitionByRange(max(1, min(files.count(), MOST_TASKS)), "path")
    return spread.mapInPandas(run, COLUMNS)


def page_number(record_id):
    """The page id in a record id; null where there is none."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def report(archive: DataFrame) -> DataFrame:
    """Per record of a written archive: page, payload length and digest, type, page referred to."""
    return archive.where(F.col("gap").isNull()).select(
        page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
    )
