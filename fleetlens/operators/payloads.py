"""Endpoints, tags and payloads of metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from fleetlens.functions.maps import drop_null, empty_map, literal_map, merge_maps, sorted_entries
from fleetlens.functions.resource import META_FIELDS, endpoint_id
from fleetlens.operators.batching import collect_batches, number_batches
from fleetlens.operators.ordered import with_position
from fleetlens.schemas import LOG_COLUMNS
from fleetlens.sinks.files import log_meta_or_empty

ENDPOINT = ["host_id", "kind", "container_id"]


def route_endpoints(metrics: DataFrame) -> DataFrame:
    """Mark each row as host or container row and give it its endpoint id.

    A row belongs to a container when its ``container_id`` dimension is non-empty.
    """
    container = F.coalesce(F.col("dimensions")["container_id"], F.lit(""))
    kind = F.when(container != "", "container").otherwise("host")
    return metrics.withColumns(
        {
            "container_id": container,
            "kind": kind,
            "endpoint_id": endpoint_id(kind, F.col("host_id"), container),
        }
    )


def host_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("kind") == "host")


def container_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("kind") == "container")


def profile_columns() -> tuple[dict[str, Column], dict[str, Column]]:
    """What rows say about their endpoint: values of which the last one counts, and the least one.

    Container name, image and status come from the last row that carries them; the
    namespaces that tag the endpoint from its first row in name order.
    """
    dims = F.col("dimensions")
    status = F.when(
        F.col("name") == "running", F.when(F.col("value") == 1, "running").otherwise("stopped")
    )
    last = {
        "container_name": F.coalesce(dims["name"], dims["container_name"]),
        "container_image_id": dims["image_id"],
        "container_image_name": dims["image"],
        "status": status,
    }
    own = {name: F.when(F.col("kind") == "container", value) for name, value in last.items()}
    return own, {"first": F.struct("namespace", "sub_namespace", "name")}


def profile_aggregates(order: Column) -> list[Column]:
    """The profile as plain aggregates, which are combined before the shuffle."""
    last, least = profile_columns()
    return [
        *[F.max_by(v, F.when(v.isNotNull(), order)).alias(name) for name, v in last.items()],
        *[F.min(v).alias(name) for name, v in least.items()],
    ]


def endpoint_profile(routed: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """What the rows of an endpoint say about it, one row per key."""
    profile = routed.groupBy(*keys).agg(*profile_aggregates(F.struct(*[F.col(s) for s in seq])))
    return profile.select("*", "first.namespace", "first.sub_namespace").drop("first")


def container_identity(routed: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Name, image and status of the containers alone."""
    profile = endpoint_profile(container_rows(routed), keys, seq)
    return profile.drop("namespace", "sub_namespace")


def standard_tags(
    namespace: Column,
    sub_namespace: Column,
    kind: Column,
    hostname: Column,
    container_id: Column,
    container_name: Column,
    start_ts: Column,
    product: str = "fleetlens",
) -> Column:
    """Tags every payload carries: start time, namespaces, job and instance.

    A container without a name is tagged with its ``container_id`` instead of an
    instance; one without either becomes ``unknown-container``. ``product`` is the
    prefix of the job names.
    """
    is_container = kind == "container"
    named = F.coalesce(container_name, F.lit("")) != ""
    has_id = F.coalesce(container_id, F.lit("")) != ""
    instance = (
        F.when(~is_container, hostname)
        .when(named, container_name)
        .when(~has_id, F.lit("unknown-container"))
    )
    tags = literal_map(
        {
            "agent_start_time": F.floor(F.unix_micros(start_ts) / F.lit(1_000_000)).cast("string"),
            "namespace": F.lower(namespace),
            "subnamespace": F.lower(sub_namespace),
            "job": F.when(is_container, f"{product}-container").otherwise(f"{product}-agent"),
            "instance": instance,
            "container_id": F.when(is_container & ~named & has_id, container_id),
        }
    )
    return F.map_filter(tags, lambda k, v: v.isNotNull())


def log_tags(base: Column, hostname: Column, product: str = "fleetlens") -> Column:
    """Tags of a log payload."""
    return merge_maps(
        base, literal_map({"job": F.lit(f"{product}-logs"), "instance": hostname})
    )


def attach_meta(df: DataFrame, meta: DataFrame, on: tuple[str, ...] = ("host_id",)) -> DataFrame:
    """Left join of the metadata table as a ``meta`` struct; of several rows of a host the
    one that is greatest, column by column, counts (maps by their sorted entries).

    No broadcast hint: the table grows with the fleet, and AQE broadcasts it once it
    has measured it to be small, or splits skewed hosts of a sort-merge join otherwise.
    """
    record = F.struct(*[F.col(c) for c in meta.columns])
    rank = F.struct(
        *[sorted_entries(F.col(f.name)) if isinstance(f.dataType, MapType) else F.col(f.name) for f in meta.schema]
    )
    packed = meta.groupBy(*on).agg(F.max_by(record, rank).alias("meta"))
    return df.join(packed, list(on), "left")


METRIC_FIELDS = [
    "namespace",
    "sub_namespace",
    "name",
    "ts",
    "value",
    "type",
    "unit",
    "dimensions",
    "stats",
    "storage_resolution",
]


# Order of the metrics within a payload; the tie column makes it total.
METRIC_ORDER = ["ts", "namespace", "sub_namespace", "name", "tie"]


def with_tie(metrics: DataFrame) -> DataFrame:
    """Add a tie breaker for rows of one metric and time that differ in dimensions, so
    that a retried task numbers its rows as before."""
    return metrics.withColumn("tie", F.xxhash64(sorted_entries(F.col("dimensions")), F.col("value")))


def assemble_payloads(
    routed: DataFrame,
    keys: list[str],
    order: list[str],
    max_points: int | None = 1000,
    slice_by: Column | None = None,
    fields: list[str] | None = None,
    place_by: list[str] | None = None,
    profile: bool = False,
) -> DataFrame:
    """One payload per key (endpoint and tick) with its metrics as an array.

    ``order`` must be total within a key. A key with more than ``max_points`` rows is cut into numbered parts, so no array and
    no task grows with a hot endpoint; ``max_points=None`` is for captures whose ticks
    are known to be small and saves a shuffle. ``place_by`` names those of the keys that
    determine the others, which keeps the numbering narrow. ``profile`` adds what the
    rows of the whole key say about the endpoint, from the pass that numbers them.
    """
    fields = fields or METRIC_FIELDS
    rank = F.struct(*[F.col(o) for o in order])
    last, least = profile_columns() if profile else ({}, {})
    if max_points is None:
        parts = routed.withColumn("part", F.lit(0).cast("long"))
        about = profile_aggregates(rank) if profile else []
    else:
        placed = with_position(routed, place_by or keys, order, slice_by, "__position", last, least)
        parts = placed.withColumn("part", F.floor(F.col("__position") / F.lit(max_points)))
        about = [F.first(name).alias(name) for name in (*last, *least)]
    packed = parts.groupBy(*keys, "part").agg(
        F.collect_list(
            F.struct(rank.alias("rank"), F.struct(*fields).alias("metric"))
        ).alias("packed"),
        *about,
    )
    in_order = F.array_sort(
        "packed",
        lambda a, b: F.when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0),
    )
    return packed.select(
        *keys, "part", F.transform(in_order, lambda p: p["metric"]).alias("metrics"), *last, *least
    )


def payload_meta(meta: Column, overrides: dict[str, Column], tags: Column) -> Column:
    """Host metadata with the endpoint's own fields and tags on top.

    An override that is null keeps the host's value; a null ``meta`` gives an empty
    record that still has the overrides.
    """
    fields = [
        F.coalesce(overrides[f], meta[f]).alias(f) if f in overrides else meta[f].alias(f)
        for f in META_FIELDS
    ]
    return F.struct(*fields, merge_maps(meta["tags"], tags).alias("tags"))


def metric_payloads(
    routed: DataFrame,
    meta: DataFrame,
    order: list[str],
    start_ts: Column,
    max_points: int | None = 1000,
    slice_by: Column | None = None,
    product: str = "fleetlens",
) -> DataFrame:
    """Payloads per endpoint and ``tick`` with identity and metadata.

    ``routed`` carries a ``tick`` column. The host's record is extended by what the rows
    say about a container and by the standard tags.
    """
    keys = ["host_id", "kind", "container_id", "endpoint_id", "tick"]
    endpoint = ["endpoint_id", "tick"]
    parts = assemble_payloads(routed, keys, order, max_points, slice_by, place_by=endpoint, profile=True)
    enriched = attach_meta(parts, meta)
    tags = standard_tags(
        F.col("first.namespace"),
        F.col("first.sub_namespace"),
        F.col("kind"),
        F.col("meta.hostname"),
        F.col("container_id"),
        F.col("container_name"),
        start_ts,
        product,
    )
    status = drop_null(literal_map({"status": F.col("status")}))
    overrides = {
        "kind": F.col("kind"),
        "endpoint_id": F.col("endpoint_id"),
        "container_id": F.when(F.col("kind") == "container", F.col("container_id")),
        "container_name": F.col("container_name"),
        "container_image_id": F.col("container_image_id"),
        "container_image_name": F.col("container_image_name"),
    }
    return enriched.select(
        "host_id",
        "kind",
        "endpoint_id",
        "tick",
        "part",
        "metrics",
        F.col("meta.agent_id").alias("agent_id"),
        F.col("meta.hostname").alias("hostname"),
        payload_meta(F.col("meta"), overrides, merge_maps(tags, status)).alias("meta"),
    )


def identified(payloads: DataFrame) -> DataFrame:
    """Add agent, host name and endpoint to payloads that carry the host's ``meta``.

    A host without metadata keeps its payload; the agent and the name are then null.
    """
    endpoint = endpoint_id(F.lit("host"), F.col("host_id"))
    overrides = {"kind": F.lit("host"), "endpoint_id": F.col("endpoint_id")}
    return payloads.withColumn("endpoint_id", endpoint).select(
        "host_id",
        "snapshot_ts",
        F.col("meta.agent_id").alias("agent_id"),
        F.col("meta.hostname").alias("hostname"),
        "endpoint_id",
        "processes",
        payload_meta(F.col("meta"), overrides, empty_map()).alias("meta"),
    )


def log_payloads(
    logs: DataFrame,
    meta: DataFrame,
    keys: list[str],
    order: list[str],
    size: int,
    slice_by: Column | None,
    product: str = "fleetlens",
) -> DataFrame:
    """Batches of log entries per key (host, source and, in a running job, tick) with
    identity and metadata; an entry without metadata has an empty record."""
    numbered = number_batches(logs, keys, order, size, slice_by)
    entry = F.struct(*[log_meta_or_empty(F.col(c)).alias(c) if c == "meta" else c for c in LOG_COLUMNS])
    batches = collect_batches(numbered, keys, entry)
    enriched = attach_meta(batches, meta).withColumn(
        "endpoint_id", endpoint_id(F.lit("host"), F.col("host_id"))
    )
    tags = log_tags(F.col("meta.tags"), F.col("meta.hostname"), product)
    overrides = {"kind": F.lit("host"), "endpoint_id": F.col("endpoint_id")}
    return enriched.select(
        *keys,
        "batch",
        "logs",
        F.col("meta.agent_id").alias("agent_id"),
        F.col("meta.hostname").alias("hostname"),
        "endpoint_id",
        payload_meta(F.col("meta"), overrides, tags).alias("meta"),
    )
