"""Previous-row, latest-row and position operators that survive a hot key.

A plain window over a series puts the whole series into one task. Here every series
is cut into slices (a column that never decreases along the order). Rows are shuffled
once, by series *and* slice, and a window runs within each slice. The same sorted
partitions give one border row per slice - the last value, or the row count - which is
carried forward over a second, tiny window and joined back. Results equal those of the
plain window, and the input is read once: both uses share one exchange. For that the
payload of a row travels as one struct, so callers select the columns they need first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_SLICE = "__slice"
_KEY = "__key"
_ROW = "__row"

Over = Callable[[WindowSpec], Column]


def _key_of(keys: list[str], slice_by: Column) -> Column:
    """Keys and slice as one struct.

    A struct is never null and equals another one with nulls in the same places, so
    rows with null keys are kept, and no null checks on the keys are pushed down into
    (and evaluated once more in) the parse below.
    """
    return F.struct(*keys, slice_by.alias(_SLICE)).alias(_KEY)


def _payload(key: Column, columns: list[str]) -> Column:
    """All columns as one struct that is read whole.

    The condition always holds, but the optimizer cannot know it: the struct counts as
    nullable, so that the null test in the sort order of :func:`_two_level` keeps it whole in
    every use of the exchange, whichever columns are asked for above.
    """
    return F.when(F.length(F.concat(F.lit("k"), F.coalesce(key.cast("string"), F.lit("")))) > 0, F.struct(*columns))


def _two_level(rows: DataFrame, keys: list[str], order: list[Column], local: dict[str, Over], carry: dict[str, Over]) -> DataFrame:
    """Add ``local`` columns, computed within slices, and ``carry`` columns, from earlier slices.

    ``rows`` has a key struct and a payload. A carried column is computed over the
    slices' border rows from one of the local columns; null where there is no earlier slice.
    """
    within = W.partitionBy(_KEY).orderBy(*order, F.col(_ROW).isNull())
    # Said here, the shuffle lies below everything that the two uses project differently.
    seen = rows.repartition(F.col(_KEY)).withColumns(
        {name: over(within) for name, over in local.items()} | {"__end": F.lead(F.lit(1)).over(within).isNull()}
    )
    slices = W.partitionBy(*[F.col(_KEY)[k] for k in keys]).orderBy(F.col(_KEY)[_SLICE])
    before = slices.rowsBetween(W.unboundedPreceding, -1)
    borders = seen.filter("__end").select(_KEY, *[over(before).alias(name) for name, over in carry.items()])
    return seen.drop("__end").join(borders, _KEY)


def _latest(value: Column) -> Over:
    return lambda window: F.last(value, ignorenulls=True).over(window)


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    slice_by: Column | None,
    into: str = "prev",
) -> DataFrame:
    """Add ``into``: the ``values`` of the previous row of the series as a struct.

    ``order`` must be total within a series. ``slice_by=None`` uses one plain window,
    for series that are known to be short.
    """
    if slice_by is None:
        row = F.struct(*[F.col(v) for v in values])
        return df.withColumn(into, F.lag(row).over(W.partitionBy(*keys).orderBy(*[F.col(o) for o in order])))

    key = _key_of(keys, slice_by)
    rows = df.select(key, _payload(F.struct(*keys), df.columns).alias(_ROW))
    row = F.struct(*[F.col(_ROW)[v].alias(v) for v in values])
    paired = _two_level(
        rows,
        keys,
        [F.col(_ROW)[o] for o in order],
        {"__own": lambda w: row, "__local": lambda w: F.lag(row).over(w)},
        {"__carried": _latest(F.col("__own"))},
    )
    return paired.select(f"{_ROW}.*", F.coalesce("__local", "__carried").alias(into))


def with_position(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_by: Column | None,
    into: str = "position",
    last: dict[str, Column] | None = None,
    least: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ``into``: the 0-based place of each row within its keys.

    The same pass can tell every row about its whole series: the ``last`` non-null value
    of an expression in the order, and the ``least`` value. What slices know of them is
    merged in the order of the slices.
    """
    folds = [(name, value, F.last) for name, value in (last or {}).items()]
    folds += [(name, value, F.min) for name, value in (least or {}).items()]

    def fold(how, value: Column, window: WindowSpec) -> Column:
        return (how(value, ignorenulls=True) if how is F.last else how(value)).over(window)

    if slice_by is None:
        by_order = W.partitionBy(*keys).orderBy(*[F.col(o) for o in order])
        whole = by_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        return df.select(
            "*",
            (F.row_number().over(by_order).cast("long") - 1).alias(into),
            *[fold(how, value, whole).alias(name) for name, value, how in folds],
        )

    key = _key_of(keys, slice_by)
    inputs = [value.alias(f"__in_{name}") for name, value, _ in folds]
    rows = df.select(key, _payload(F.struct(*keys), [*df.columns, *inputs]).alias(_ROW))
    local: dict[str, Over] = {"__local": lambda w: F.row_number().over(w).cast("long")}
    carry: dict[str, Over] = {"__offset": lambda w: F.sum("__local").over(w)}
    for name, _, how in folds:
        local[f"__part_{name}"] = lambda w, n=name, h=how: fold(h, F.col(_ROW)[f"__in_{n}"], w)
        carry[name] = lambda w, n=name, h=how: fold(
            h, F.col(f"__part_{n}"), w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        )
    placed = _two_level(rows, keys, [F.col(_ROW)[o] for o in order], local, carry)
    place = F.coalesce("__offset", F.lit(0).cast("long")) + F.col("__local") - 1
    return placed.select(*[F.col(_ROW)[c].alias(c) for c in df.columns], place.alias(into), *[f[0] for f in folds])


def with_latest(
    df: DataFrame,
    others: dict[str, DataFrame],
    keys: list[str],
    at: str,
    slices: Callable[[Column], Column] | None,
    tie: str | None = None,
    previous: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """As-of join: add, for each of ``others``, its last row at or before the row's time.

    All tables have ``keys`` and the time ``at``; the columns of another table arrive as a
    struct of its name, null where it has no such row. Rows of one series and time are
    taken in the order of ``tie``. All tables are merged into one ordered series per
    key, so each is read once and shuffled once, and a hot key is split by slice.
    ``previous`` names a struct of ``values`` of the row before, in the same pass.
    """
    slice_of = slices or (lambda ts: F.lit(0))
    rank = F.lit(0).cast("long") if tie is None else F.col(tie).cast("long")
    fields = {name: [c for c in other.columns if c not in keys] for name, other in others.items()}

    def empty(name: str) -> Column:
        return F.lit(None).cast(
            "struct<" + ", ".join(f"`{c}`: {others[name].schema[c].dataType.simpleString()}" for c in fields[name]) + ">"
        )

    rows = df.select(
        _key_of(keys, slice_of(F.col(at))),
        F.col(at).alias("__at"),
        F.lit(1).alias("__kind"),
        rank.alias("__tie"),
        _payload(F.struct(*keys), df.columns).alias(_ROW),
        *[empty(name).alias(name) for name in others],
    )
    for name, other in others.items():
        own_rank = F.col(tie).cast("long") if tie in other.columns else F.lit(0).cast("long")
        rows = rows.unionByName(
            other.select(
                _key_of(keys, slice_of(F.col(at))),
                F.col(at).alias("__at"),
                F.lit(0).alias("__kind"),
                own_rank.alias("__tie"),
                F.struct(*fields[name]).alias(name),
            ),
            allowMissingColumns=True,
        )
    tracked = {name: F.col(name) for name in others}
    local = {f"__now_{name}": _latest(value) for name, value in tracked.items()}
    carry = {f"__past_{name}": _latest(F.col(f"__now_{name}")) for name in tracked}
    if previous is not None:
        own = F.when(F.col("__kind") == 1, F.struct(*[F.col(_ROW)[v].alias(v) for v in previous[1]]))
        local["__now_row"] = lambda w: F.last(own, ignorenulls=True).over(w)
        local["__before"] = lambda w: F.last(own, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
        carry["__past_row"] = _latest(F.col("__now_row"))
    merged = _two_level(rows, keys, [F.col("__at"), F.col("__kind"), F.col("__tie")], local, carry)
    out = [F.coalesce(f"__now_{name}", f"__past_{name}").alias(name) for name in others]
    if previous is not None:
        out.append(F.coalesce("__before", "__past_row").alias(previous[0]))
    return merged.filter("__kind = 1").select(f"{_ROW}.*", *out)


def fit_slice_seconds(
    df: DataFrame, keys: list[str], ts: str, target_rows: int = 1_000_000, probe_seconds: int = 3600
) -> int:
    """Slice width that keeps the densest slice near ``target_rows``.

    Runs one aggregation over the key and time columns and brings a single number to
    the driver. Use it once per job when the sampling rate is unknown.
    """
    from fleetlens.functions.timestamps import slice_of

    densest = (
        df.groupBy(*keys, slice_of(F.col(ts), probe_seconds).alias(_SLICE))
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    return max(1, min(probe_seconds, probe_seconds * target_rows // max(densest or 1, 1)))
