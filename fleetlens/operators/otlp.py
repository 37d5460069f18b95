"""OTLP-shaped nesting of metric and log payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.levels import severity_number
from fleetlens.functions.maps import drop_empty, empty_map, literal_map, prefix_keys, sorted_entries
from fleetlens.functions.resource import payload_resource, resource_attributes
from fleetlens.functions.timestamps import unix_nanos
from fleetlens.operators.rollup import is_histogram
from fleetlens.schemas import LOG_META_FIELDS


def attributes(dims: Column) -> Column:
    """Attributes in key order, without empty keys or values."""
    return sorted_entries(drop_empty(dims))


def scope_name(namespace: Column, sub_namespace: Column) -> Column:
    sub = F.when(sub_namespace != "", sub_namespace)
    return F.concat_ws(".", namespace, sub)


def otlp_metric(m: Column) -> Column:
    """One metric: a delta histogram point if it has a statistic set, else a gauge."""
    hist = is_histogram(m["stats"])
    return F.struct(
        m["name"].alias("name"),
        m["unit"].alias("unit"),
        F.when(
            ~hist,
            F.struct(
                unix_nanos(m["ts"]).alias("time_unix_nano"),
                attributes(m["dimensions"]).alias("attributes"),
                m["value"].alias("as_double"),
            ),
        ).alias("gauge"),
        F.when(
            hist,
            F.struct(
                unix_nanos(m["ts"]).alias("time_unix_nano"),
                attributes(m["dimensions"]).alias("attributes"),
                m["stats"]["sample_count"].cast("long").alias("count"),
                m["stats"]["sum"].alias("sum"),
                m["stats"]["minimum"].alias("min"),
                m["stats"]["maximum"].alias("max"),
                F.lit("DELTA").alias("aggregation_temporality"),
            ),
        ).alias("histogram"),
    )


def _by_scope(items: Column, scope_of, body_of, body_name: str) -> Column:
    """Array of scopes in name order, each with its items. Works within one payload
    row, whose array is bounded, so nesting needs no further shuffle."""
    scopes = F.array_sort(F.array_distinct(F.transform(items, scope_of)))
    return F.transform(
        scopes,
        lambda s: F.struct(
            F.struct(s.alias("name")).alias("scope"),
            F.transform(F.filter(items, lambda i: scope_of(i) == s), body_of).alias(body_name),
        ),
    )


def otlp_metrics(payloads: DataFrame, compat: bool = False) -> DataFrame:
    """Replace ``metrics`` and ``meta`` of each payload by ``resource_metrics``.

    Empty payloads give nothing.
    """
    scoped = _by_scope(
        F.col("metrics"),
        lambda m: scope_name(m["namespace"], m["sub_namespace"]),
        otlp_metric,
        "metrics",
    )
    resource = F.struct(
        sorted_entries(resource_attributes(F.col("meta"), compat)).alias("attributes")
    )
    return (
        payloads.filter(F.size("metrics") > 0)
        .withColumn(
            "resource_metrics",
            F.array(F.struct(resource.alias("resource"), scoped.alias("scope_metrics"))),
        )
        .drop("metrics", "meta")
    )


def log_attributes(entry: Column) -> Column:
    """Attributes of a log record, in key order, typed string or integer."""
    def text(m: Column) -> Column:
        return F.map_filter(F.coalesce(m, empty_map()), lambda k, v: v != "")

    meta = entry["meta"]
    fixed = literal_map(
        {"log.source": entry["source"], "log.category": entry["category"]}
        | {f"log.{f}": meta[f] for f in LOG_META_FIELDS}
    )
    strings = F.map_concat(
        drop_empty(fixed),
        prefix_keys(text(entry["fields"]), "field."),
        prefix_keys(text(entry["labels"]), "tag."),
        prefix_keys(text(meta["extra"]), "log.extra."),
    )
    no_int = F.lit(None).cast("long")
    typed = F.transform(
        F.map_entries(strings),
        lambda e: F.struct(
            e["key"].alias("key"), e["value"].alias("string_value"), no_int.alias("int_value")
        ),
    )
    pid = F.when(
        entry["pid"] > 0,
        F.array(
            F.struct(
                F.lit("process.pid").alias("key"),
                F.lit(None).cast("string").alias("string_value"),
                entry["pid"].cast("long").alias("int_value"),
            )
        ),
    ).otherwise(F.array().cast("array<struct<key: string, string_value: string, int_value: bigint>>"))
    return F.array_sort(F.concat(typed, pid))


def log_record(entry: Column) -> Column:
    return F.struct(
        unix_nanos(entry["ts"]).alias("time_unix_nano"),
        severity_number(entry["level"]).alias("severity_number"),
        entry["level"].alias("severity_text"),
        entry["message"].alias("body"),
        log_attributes(entry).alias("attributes"),
    )


def log_scope(source: Column) -> Column:
    return F.when(source != "", source).otherwise("unknown")


def otlp_logs(payloads: DataFrame, compat: bool = False) -> DataFrame:
    """Replace ``logs`` and ``meta`` of each payload by ``resource_logs``."""
    identity = {f: F.col(f) for f in ("host_id", "agent_id", "hostname", "endpoint_id")}
    resource = F.struct(
        sorted_entries(payload_resource(identity, F.col("meta"), compat)).alias("attributes")
    )
    scoped = _by_scope(
        F.col("logs"), lambda e: log_scope(e["source"]), log_record, "log_records"
    )
    return (
        payloads.filter(F.size("logs") > 0)
        .withColumn(
            "resource_logs",
            F.array(F.struct(resource.alias("resource"), scoped.alias("scope_logs"))),
        )
        .drop("logs", "meta")
    )
