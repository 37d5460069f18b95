"""Metric points: many samples of one capture, exploded in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import empty_map, literal_map

POINT = (
    "struct<sub_namespace: string, name: string, value: double, type: string, "
    "unit: string, dimensions: map<string,string>>"
)
_NO_POINTS = f"array<{POINT}>"


def to_double(value: Column) -> Column:
    """Numeric coercion: anything that is no number becomes 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def point(
    sub: str | Column,
    name: str | Column,
    value: Column,
    kind: str,
    unit: str,
    dims: Column | dict | None = None,
) -> Column:
    """One sample. ``value`` stays null when the capture does not carry it."""
    if dims is None:
        dims = empty_map()
    elif isinstance(dims, dict):
        dims = literal_map(dims)
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        as_col(sub).alias("sub_namespace"),
        as_col(name).alias("name"),
        value.cast("double").alias("value"),
        F.lit(kind).alias("type"),
        F.lit(unit).alias("unit"),
        dims.alias("dimensions"),
    )


def no_points() -> Column:
    return F.array().cast(_NO_POINTS)


def points_if(condition: Column, *points: Column) -> Column:
    return F.when(condition, F.array(*points)).otherwise(no_points())


def points_of(array: Column, make) -> Column:
    """Points of every element; a null array has none."""
    return F.coalesce(F.transform(array, make), no_points())


def flat_points_of(array: Column, make) -> Column:
    """As :func:`points_of` where each element makes an array of points."""
    return F.coalesce(F.flatten(F.transform(array, make)), no_points())


def with_dims(items: Column, dims_of) -> Column:
    """Pair each item with its dimensions, so all its points share one map."""
    return F.transform(
        items, lambda i: F.struct(i.alias("item"), dims_of(i).alias("dims"))
    )


def explode_points(
    df: DataFrame, namespace: str, groups: list[Column], keep: tuple[str, ...] = ("host_id", "ts")
) -> DataFrame:
    """Metric rows from the point arrays of one capture row.

    All families of a capture are concatenated and exploded together, so the capture
    is read once however many metric names it yields. Points without a value (a probe
    that failed) are dropped.
    """
    exploded = df.select(*keep, F.inline(F.concat(*groups)))
    return as_metric_rows(exploded.filter(F.col("value").isNotNull()), namespace, keep)


def as_metric_rows(df: DataFrame, namespace: str, keep: tuple[str, ...] = ("host_id", "ts")) -> DataFrame:
    """Canonical metric columns, in the order of the metric table."""
    extra = [c for c in keep if c not in ("host_id", "ts")]
    return df.select(
        "host_id",
        F.lit(namespace).alias("namespace"),
        "sub_namespace",
        "name",
        "ts",
        to_double(F.col("value")).alias("value"),
        "type",
        "unit",
        "dimensions",
        F.lit(None).cast("struct<minimum: double, maximum: double, sum: double, sample_count: int>").alias("stats"),
        F.lit(0).alias("storage_resolution"),
        *extra,
    )
