"""The shape all log sources share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.maps import empty_map
from fleetlens.schemas import LOG_META_FIELDS


def log_meta(extra: Column | None = None, **fields: Column) -> Column:
    """Origin of a log record; fields that are not given are empty."""
    unknown = set(fields) - set(LOG_META_FIELDS)
    if unknown:
        raise ValueError(f"unknown log metadata: {sorted(unknown)}")
    columns = [fields.get(f, F.lit("")).alias(f) for f in LOG_META_FIELDS]
    return F.struct(*columns, (empty_map() if extra is None else extra).alias("extra"))


def log_rows(
    df: DataFrame,
    ts: Column,
    level: Column,
    message: Column,
    source: Column,
    category: Column,
    pid: Column,
    fields: Column,
    labels: Column,
    meta: Column,
) -> DataFrame:
    return df.select(
        "host_id",
        ts.alias("ts"),
        level.alias("level"),
        message.alias("message"),
        source.alias("source"),
        category.alias("category"),
        pid.alias("pid"),
        fields.alias("fields"),
        labels.alias("labels"),
        meta.alias("meta"),
    )
