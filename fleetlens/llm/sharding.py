"""Deal documents to shards by balanced label propagation: equal texts move together.

The law is ``rows``: the numbers of documents in any two shards differ by at most one.

Documents are linked to those with the same text. Every document begins in a shard by its
place in a hashed order, which makes the shards exactly even. Linked documents then move in
rounds. A group joins the numbers of its documents in each shard (votes) and aims at the
shard that has most of them among those with room; documents elsewhere ask to move there.
Quotas limit how many may go from one shard to another: as many as come the other way, and
the target's room beyond that. Larger votes go first. Rounds end when nothing moves, or
after ``ROUNDS``. Groups that are in several shards even then give up their places and take
what is left end to end, largest first, so that only groups at a border between two shards
are cut. Documents without links have no wish; they take the last places, so the law holds
whatever has moved.

Documents of one group in one shard have the same neighbours and the same wish. They are
moved as one counted bundle, which quotas can split: a group is at most as many rows as there
are shards, however many copies it has, and no join has a hot key.

Places are numbered in two levels, by hash bucket and within the bucket, with about the square
root of the number of rows as buckets. Only tables of shards by shards numbers reach the driver.

A null text has size 1, checksum 0 and no links; empty texts are linked. Repeated rows are
rows of their own; with equal ids and texts it does not matter which takes which place. Long
texts count as one document. Other columns are kept; helper columns begin with two
underscores, and input columns named like an output are replaced. An empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import written

SHARDS = 16
ROUNDS = 12
# Hash parts within which running sums are taken.
PARTS = 1024
GROUP = ["__g1", "__g2"]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``, ``text_crc32`` and the hidden key of equal texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {
            "__g1": F.xxhash64(F.col(text)),
            "__g2": F.when(F.col(text).isNotNull(), F.hash(F.col(text))),
            "size": F.octet_length(body).cast("long") + 1,
            "text_crc32": F.crc32(body.cast("binary")),
        }
    )


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def at(values: list[int], index: Column) -> Column:
    """The element of a short list of numbers."""
    return F.element_at(F.array(*(F.lit(int(v)) for v in values)), index.cast("int") + 1)


def numbered(rows: DataFrame, keys: list[str], name: str, of: Column | None = None) -> DataFrame:
    """Number the rows of each value of ``keys`` from 0, buckets in order; ``of`` tells which rows count.

    ``__bucket`` and the total order ``__order`` must be there. Sums of buckets are joined, not
    collected: there are at most rows of ``keys`` times buckets of them.
    """
    of = F.lit(1) if of is None else of.cast("int")
    inside = Window.partitionBy(*keys, "__bucket").orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "__bucket").agg(F.sum(of).alias("__rows"))
    offsets = sums.select(*keys, "__bucket", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    local = rows.withColumn(name, F.coalesce(F.sum(of).over(inside), F.lit(0)))
    return local.join(offsets, [*keys, "__bucket"]).withColumn(name, F.col(name) + F.col("__before")).drop("__before")


def asked(cells: DataFrame, room: list[int]) -> DataFrame:
    """Bundles that wish to move: where to (``__to``) and their rank by votes (``__class``, 0 last)."""
    here = F.struct("__n", F.xxhash64(*GROUP, "__shard").alias("tie"), F.col("__shard").alias("to"))
    votes = cells.groupBy(*GROUP).agg(
        F.max(F.when(at(room, F.col("__shard")) > 0, here)).alias("roomy"),
        F.max(here).alias("any"),
        F.sum("__n").alias("all"),
    )
    freest = room.index(max(room))
    # No shard of the group has room: it may meet anew where most is left, if it fits there.
    meets = F.col("roomy").isNull() & (F.col("all") <= room[freest])
    wish = F.coalesce("roomy", "any")
    to = F.when(meets, F.lit(freest)).otherwise(wish["to"])
    fits = meets | (F.col("all") - wish["__n"] <= at(room, wish["to"]))
    asking = cells.join(votes.select(*GROUP, wish.alias("wish"), to.alias("__to"), fits.alias("fits")), GROUP)
    return asking.where((F.col("__to") != F.col("__shard")) & (F.col("fits") | (F.col("wish") > here))).select(
        *GROUP, "__shard", "__to", F.floor(F.log2(F.col("wish.__n").cast("double"))).cast("int").alias("__class"), "__n"
    )


def quotas(requests: DataFrame, room: list[int], shards: int) -> list[int]:
    """How many documents may go from shard to shard, as one list; at most shards x shards sums are collected."""
    want = [[0] * shards for _ in range(shards)]
    for row in requests.groupBy("__shard", "__to").agg(F.sum("__n").alias("n")).collect():
        want[row["__shard"]][row["__to"]] = row["n"]
    quota = [[min(want[a][b], want[b][a]) for b in range(shards)] for a in range(shards)]
    for b in range(shards):
        rest = [want[a][b] - quota[a][b] for a in range(shards)]
        left = max(0, room[b])
        for a in sorted(range(shards), key=lambda a: -rest[a]):
            extra = min(rest[a], left)
            quota[a][b] += extra
            left -= extra
    return [n for row in quota for n in row]


def moved(cells: DataFrame, requests: DataFrame, quota: list[int], shards: int) -> DataFrame:
    """Cells after the moves that the quotas admit, larger votes first."""
    lane = ["__shard", "__to"]
    fine = Window.partitionBy(*lane, "__class", "__part").orderBy(*GROUP).rowsBetween(Window.unboundedPreceding, -1)
    coarse = Window.partitionBy(*lane).orderBy(F.desc("__class"), "__part").rowsBetween(Window.unboundedPreceding, -1)
    parted = requests.withColumn("__part", F.pmod(F.xxhash64(*GROUP, F.lit("part")), F.lit(PARTS)))
    sums = parted.groupBy(*lane, "__class", "__part").agg(F.sum("__n").alias("__rows"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__rows").over(coarse), F.lit(0))).drop("__rows")
    granted = (
        parted.withColumn("__own", F.coalesce(F.sum("__n").over(fine), F.lit(0)))
        .join(before, [*lane, "__class", "__part"])
        .withColumn("__left", at(quota, F.col("__shard") * shards + F.col("__to")) - F.col("__own") - F.col("__before"))
        .withColumn("__go", F.greatest(F.lit(0), F.least("__left", "__n")))
        .where("__go > 0")
    )
    changes = granted.select(
        *GROUP,
        F.explode(
            F.array(
                F.struct(F.col("__shard").alias("s"), (-F.col("__go")).alias("n")),
                F.struct(F.col("__to").alias("s"), F.col("__go").alias("n")),
            )
        ).alias("c"),
    ).select(*GROUP, F.col("c.s").alias("__shard"), F.col("c.n").alias("__n"))
    return (
        cells.select(*GROUP, "__shard", "__n")
        .unionByName(changes)
        .groupBy(*GROUP, "__shard")
        .agg(F.sum("__n").alias("__n"))
        .where("__n > 0")
    )


def by_shard(cells: DataFrame, shards: int) -> list[int]:
    sums = [0] * shards
    for row in cells.groupBy("__shard").agg(F.sum("__n").alias("n")).collect():
        sums[row["__shard"]] = row["n"]
    return sums


def end_to_end(cells: DataFrame, room: list[int]) -> DataFrame:
    """Place whole groups one after the other into the room, largest first, the roomiest shard first."""
    fine = Window.partitionBy("__class", "__part").orderBy(*GROUP).rowsBetween(Window.unboundedPreceding, -1)
    coarse = Window.orderBy(F.desc("__class"), "__part").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        cells.groupBy(*GROUP)
        .agg(F.sum("__n").alias("__n"))
        .withColumn("__class", F.floor(F.log2(F.col("__n").cast("double"))).cast("int"))
        .withColumn("__part", F.pmod(F.xxhash64(*GROUP, F.lit("part")), F.lit(PARTS)))
    )
    sums = groups.groupBy("__class", "__part").agg(F.sum("__n").alias("__rows"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__rows").over(coarse), F.lit(0))).drop("__rows")
    ranges, low = [], 0
    for shard in sorted(range(len(room)), key=lambda s: -room[s]):
        ranges.append((low, low + room[shard], shard))
        low += room[shard]
    start = F.coalesce(F.sum("__n").over(fine), F.lit(0)) + F.col("__before")
    placed = groups.join(before, ["__class", "__part"]).withColumn("__start", start)

    def overlap(low: int, high: int) -> Column:
        return F.least(F.col("__start") + F.col("__n"), F.lit(high)) - F.greatest("__start", F.lit(low))

    spans = F.array(*(F.struct(F.lit(s).alias("s"), overlap(low, high).alias("n")) for low, high, s in ranges))
    return placed.select(*GROUP, F.explode(F.filter(spans, lambda x: x["n"] > 0)).alias("c")).select(
        *GROUP, F.col("c.s").alias("__shard"), F.col("c.n").alias("__n")
    )


def propagated(cells: DataFrame, most: list[int]) -> DataFrame:
    """Cells after all moves; ``cells`` has the number of linked documents by group and shard."""
    alone, shards = Window.partitionBy(*GROUP), len(most)

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Groups that are in one shard are done; the others go on."""
        state = written(rows.withColumn("__open", F.count("*").over(alone) > 1), "shard-cells")
        return state.where("NOT __open").drop("__open"), state.where("__open").drop("__open")

    whole, still = split(cells)
    done, filled, held = [whole], by_shard(cells, shards), by_shard(still, shards)
    for _ in range(ROUNDS):
        room = [m - f for m, f in zip(most, filled)]
        requests = written(asked(still, room), "shard-requests")
        quota = quotas(requests, room, shards)
        if not any(quota):
            break
        whole, still = split(moved(still, requests, quota, shards))
        done.append(whole)
        now = by_shard(still, shards)
        filled = [f - h + n + w for f, h, n, w in zip(filled, held, now, by_shard(whole, shards))]
        held = now
    if any(held):
        done.append(end_to_end(still, [m - f + h for m, f, h in zip(most, filled, held)]))
    return reduce(DataFrame.unionByName, done)


def from_cells(spot: Column, cells: Column) -> Column:
    """The shard of place ``spot`` within a group whose cells have running ends."""
    return F.filter(cells, lambda c: spot < c["end"])[0]["shard"]


def assign(docs: DataFrame, shards: int = SHARDS, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Every row of :func:`measured` documents with ``law``, ``shard``, ``slot`` and ``grown_shard``.

    Texts are not needed any more and best dropped before.
    """
    kept = [c for c in docs.columns if not c.startswith("__") and c not in ("law", "shard", "slot", "grown_shard")]
    total = docs.count()
    buckets = max(1, round(total**0.5))
    order = F.struct(F.xxhash64(F.col(id), "__g1", "size").alias("h"), F.col(id).cast("string"), F.col("__g1"), F.col("__g2"))
    linked = docs.where("__g2 IS NOT NULL").groupBy(*GROUP).agg(F.count("*").alias("__copies")).where("__copies > 1")
    # Written first, both sides of the join are plain shuffles, of which a hot group's is split.
    rows = (
        docs.select(*kept, *GROUP)
        .join(written(linked, "shard-linked"), GROUP, "left")
        .withColumn("__linked", F.col("__copies").isNotNull())
        .withColumn("__order", order)
        .withColumn("__bucket", F.pmod(F.xxhash64("__order", F.lit("bucket")), F.lit(buckets)))
        .drop("__copies")
    )
    rows = written(numbered(rows, [], "__row"), "shard-rows")
    most = capacities(total, shards)
    groups = rows.where("__linked")
    cells = groups.groupBy(*GROUP, F.pmod("__row", F.lit(shards)).cast("int").alias("__shard")).agg(F.count("*").alias("__n"))
    cells = written(cells, "shard-start")
    cells = written(propagated(cells, most), "shard-groups")

    filled = by_shard(cells, shards)
    ends, end = [], 0
    for m, f in zip(most, filled):
        end += m - f
        ends.append(end)
    ranges = F.array(*(F.struct(F.lit(e).cast("long").alias("end"), F.lit(s).alias("shard")) for s, e in enumerate(ends)))
    free = numbered(rows.where("NOT __linked"), [], "__spot").withColumn("shard", from_cells(F.col("__spot"), ranges))

    upto = Window.partitionBy(*GROUP).orderBy("__shard")
    spans = (
        cells.withColumn("end", F.sum("__n").over(upto))
        .groupBy(*GROUP)
        .agg(F.sort_array(F.collect_list(F.struct("end", F.col("__shard").alias("shard")))).alias("__cells"))
    )
    together = numbered(groups, GROUP, "__spot").join(written(spans, "shard-spans"), GROUP)
    together = together.withColumn("shard", from_cells(F.col("__spot"), F.col("__cells"))).drop("__cells")
    placed = written(free.unionByName(together).drop("__spot", "__row", "__linked"), "shard-places")
    return numbered(placed, ["shard"], "slot").select(
        *kept,
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text", id: str = "doc_id") -> None:
    """Write the documents, all columns of them, as one folder for each shard."""
    placed = assign(measured(docs, text), shards, text, id)
    placed.write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per document its size, checksum and place."""
    facts = measured(docs.select("doc_id", "text")).drop("text")
    return assign(facts, shards).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
