"""Queries over endpoints, tags, payloads and nested exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.maps import merge_maps, render_map
from fleetlens.functions.resource import endpoint_id, payload_resource, resource_attributes
from fleetlens.functions.timestamps import from_micros
from fleetlens.operators.otlp import log_attributes, otlp_logs, otlp_metrics
from fleetlens.operators.payloads import (
    assemble_payloads,
    attach_meta,
    container_identity,
    log_payloads,
    metric_payloads,
    route_endpoints,
    standard_tags,
)
from fleetlens.plans import adapters as A
from fleetlens.plans import sqltext as S
from fleetlens.plans.catalog import query
from fleetlens.schemas import LOG_COLUMNS
from fleetlens.session import work_folder
from fleetlens.sinks.committed import Committed, resume
from fleetlens.sinks.files import append_ndjson, legacy_payload, read_ndjson

DAY_US = 86_400_000_000
KEYS = ["host_id", "kind", "container_id", "endpoint_id", "tick"]


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App metrics with their endpoint; a tick is a day."""
    rows = route_endpoints(A.app_metrics(A.events(spark, sf_dir)))
    return rows.withColumn("tick", from_micros(F.expr(f"us div {DAY_US} * {DAY_US}")))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of at most 10 metrics, in slices of six hours."""
    return assemble_payloads(
        routed(spark, sf_dir), KEYS, ["ts", "event_id"], 10, F.expr(f"us div {DAY_US // 4}")
    )


def meta_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.host_meta(A.table(spark, sf_dir, "nation"))


def full_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payloads with identity, metadata and tags."""
    return metric_payloads(
        routed(spark, sf_dir),
        meta_table(spark, sf_dir),
        ["ts", "event_id"],
        from_micros(F.lit(S.EPOCH_US)),
        10,
        F.expr(f"us div {DAY_US // 4}"),
    )


# --- routing ------------------------------------------------------------------


@query(
    "route_endpoints",
    f"WITH {S.APP} SELECT event_id, host_id, kind, container_id, endpoint_id FROM routed",
)
def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir).select("event_id", "host_id", "kind", "container_id", "endpoint_id")


@query(
    "endpoint_id",
    """SELECT c_custkey, sha256('host|h' || c_nationkey || '|') AS host_endpoint,
  sha256('container|h' || c_nationkey || '|c' || c_custkey) AS container_endpoint FROM customer""",
)
def endpoint_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.expr("concat('h', c_nationkey)")
    return A.table(spark, sf_dir, "customer").select(
        "c_custkey",
        endpoint_id(F.lit("host"), host).alias("host_endpoint"),
        endpoint_id(F.lit("container"), host, F.expr("concat('c', c_custkey)")).alias(
            "container_endpoint"
        ),
    )


_PARTS = S.APP + """,
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY endpoint_id, day_us ORDER BY us, event_id) - 1) // 10 AS part
  FROM routed
)"""
PAYLOAD_SQL = f"""WITH {_PARTS}
SELECT host_id, kind, endpoint_id, day_us AS tick_us, part, count(*) AS n,
  string_agg(CAST(us AS VARCHAR), ',' ORDER BY us, event_id) AS times
FROM placed GROUP BY host_id, kind, endpoint_id, day_us, part"""


def payload_text(df: DataFrame) -> DataFrame:
    times = F.transform("metrics", lambda m: F.unix_micros(m["ts"]).cast("string"))
    return df.select(
        "host_id",
        "kind",
        "endpoint_id",
        F.unix_micros("tick").alias("tick_us"),
        "part",
        F.size("metrics").cast("bigint").alias("n"),
        F.array_join(times, ",").alias("times"),
    )


@query("payload_assembly", PAYLOAD_SQL)
def payload_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_text(payloads(spark, sf_dir))


_IDENTITY = """identity AS (
  SELECT endpoint_id, day_us, any_value(host_id) AS host_id, any_value(kind) AS kind,
    any_value(container_id) AS container_id, max_by(container_name, us) AS container_name,
    max_by(image, us) AS image,
    max_by(CASE WHEN value = 1 THEN 'running' ELSE 'stopped' END, us) FILTER (WHERE name = 'running') AS status,
    min(sub_namespace) AS sub_namespace
  FROM routed GROUP BY endpoint_id, day_us
)"""


@query(
    "container_meta",
    f"""WITH {S.APP}, {_IDENTITY}
SELECT endpoint_id, day_us AS tick_us, container_name, image AS container_image_name, status
FROM identity WHERE kind = 'container'""",
)
def container_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = container_identity(routed(spark, sf_dir), ["endpoint_id", "tick"], ["ts", "event_id"])
    return found.select(
        "endpoint_id",
        F.unix_micros("tick").alias("tick_us"),
        "container_name",
        "container_image_name",
        "status",
    )


# --- tags and metadata --------------------------------------------------------


@query(
    "meta_enrich",
    f"""WITH {S.APP}, {S.META}
SELECT r.event_id, r.host_id, m.hostname, m.agent_id, m.os, 'team=' || m.team || ';void=' AS tags
FROM routed r LEFT JOIN meta m USING (host_id)""",
)
def meta_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = attach_meta(routed(spark, sf_dir), meta_table(spark, sf_dir))
    return enriched.select(
        "event_id",
        "host_id",
        "meta.hostname",
        "meta.agent_id",
        "meta.os",
        render_map(F.col("meta.tags")).alias("tags"),
    )


@query(
    "tag_merge",
    """SELECT event_id, 'env=prod;team=' || event_type
  || CASE WHEN event_id % 2 = 0 THEN ';user=' || user_id ELSE '' END AS tags FROM events""",
)
def tag_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.expr("map('env', 'prod', 'team', concat('t', user_id % 5))")
    extra = F.expr("map('team', event_type)")
    user = F.expr("case when event_id % 2 = 0 then map('user', cast(user_id as string)) end")
    merged = merge_maps(merge_maps(base, extra), user)
    return A.table(spark, sf_dir, "events").select("event_id", render_map(merged).alias("tags"))


_TAGS = """CASE WHEN kind = 'container'
    THEN 'agent_start_time=1704067200'
      || CASE WHEN event_id % 5 = 1 AND event_id % 7 <> 1 THEN ';container_id=' || cid ELSE '' END
      || CASE WHEN event_id % 5 <> 1 THEN ';instance=' || container_name
           WHEN event_id % 7 = 1 THEN ';instance=unknown-container' ELSE '' END
      || ';job=fleetlens-container;namespace=app;subnamespace=' || sub_namespace
    ELSE 'agent_start_time=1704067200;instance=host-' || host_id
      || ';job=fleetlens-agent;namespace=app;subnamespace=' || sub_namespace END"""


@query(
    "standard_tags",
    f"""WITH {S.APP}, t AS (SELECT *, container_id AS cid FROM routed)
SELECT event_id, {_TAGS} AS tags FROM t""",
)
def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every row as if it came first; some containers lack a name or an id."""
    rows = routed(spark, sf_dir)
    name = F.when(F.expr("event_id % 5 <> 1"), F.col("dimensions")["name"])
    cid = F.when(F.expr("event_id % 5 <> 1 or event_id % 7 <> 1"), F.col("container_id"))
    built = standard_tags(
        F.col("namespace"),
        F.col("sub_namespace"),
        F.col("kind"),
        F.concat(F.lit("host-"), F.col("host_id")),
        cid,
        name,
        from_micros(F.lit(S.EPOCH_US)),
    )
    return rows.select("event_id", render_map(built).alias("tags"))


_RESOURCE = """concat_ws(';', 'agent.id=' || agent_id, 'agent.version=1.0', 'cloud.region=' || region,
    'environment=' || environment, 'host.id=' || host_id, 'host.ip=' || ip, 'host.name=' || hostname,
    'os.type=' || os, 'tag.team=' || team)"""


@query(
    "resource_attrs",
    f"""WITH {S.META} SELECT host_id, {_RESOURCE} AS attrs,
  replace({_RESOURCE}, ';tag.team=' || team, '') AS compat_attrs FROM meta""",
)
def resource_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = meta_table(spark, sf_dir)
    record = F.struct(*[F.col(c) for c in meta.columns])
    with_record = meta.select("host_id", record.alias("meta"))
    return with_record.select(
        "host_id",
        render_map(resource_attributes(F.col("meta"))).alias("attrs"),
        render_map(resource_attributes(F.col("meta"), compat=True)).alias("compat_attrs"),
    )


@query(
    "log_resource",
    f"""WITH {S.META}
SELECT c.c_custkey, concat_ws(';', 'agent.id=A' || c.c_custkey,
  CASE WHEN m.host_id IS NOT NULL THEN 'agent.version=1.0' END, 'cloud.region=' || m.region,
  'endpoint.id=e' || c.c_custkey, 'environment=' || m.environment,
  'host.id=' || CASE WHEN c.c_custkey % 2 = 0 THEN 'own' || c.c_custkey END, 'host.ip=' || m.ip,
  'host.name=' || c.c_name, 'os.type=' || m.os, 'tag.team=' || m.team) AS attrs
FROM customer c LEFT JOIN meta m ON m.host_id = 'h' || c.c_nationkey""",
)
def log_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity of the payload against that of its metadata. An empty own value does not
    bring the one of the metadata back."""
    customers = A.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "concat('h', c_nationkey) as host_id"
    )
    enriched = attach_meta(customers, meta_table(spark, sf_dir))
    identity = {
        "host_id": F.expr("case when c_custkey % 2 = 0 then concat('own', c_custkey) else '' end"),
        "agent_id": F.expr("concat('A', c_custkey)"),
        "hostname": F.col("c_name"),
        "endpoint_id": F.expr("concat('e', c_custkey)"),
    }
    attrs = payload_resource(identity, F.col("meta"))
    return enriched.select("c_custkey", render_map(attrs).alias("attrs"))


# --- logs ---------------------------------------------------------------------


def chat_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.conversation_logs(A.table(spark, sf_dir, "conversations"))


def render_attributes(attrs: Column) -> Column:
    value = lambda a: F.coalesce(
        a["string_value"], F.concat(F.lit("int:"), a["int_value"].cast("string"))
    )
    return F.array_join(F.transform(attrs, lambda a: F.concat(a["key"], F.lit("="), value(a))), ";")


_LOG_ATTRS = """'field.conv=' || conv_id || ';log.app_name=app' || (conv_id % 3)
  || ';log.category=chat;log.extra.turn=' || turn || ';log.platform=chat'
  || CASE WHEN source <> '' THEN ';log.source=' || source ELSE '' END || ';log.user=' || role
  || CASE WHEN turn % 3 > 0 THEN ';process.pid=int:' || (turn % 3) ELSE '' END || ';tag.role=' || role"""


@query("log_attrs", f"WITH {S.CHAT} SELECT conv_id, turn, {_LOG_ATTRS} AS attrs FROM chat")
def log_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = chat_logs(spark, sf_dir)
    packed = logs.select("conv_id", "turn", F.struct(*LOG_COLUMNS).alias("entry"))
    return packed.select(
        "conv_id", "turn", render_attributes(log_attributes(F.col("entry"))).alias("attrs")
    )


def chat_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta_table(spark, sf_dir).withColumn("host_id", F.expr("concat('host', substr(host_id, 2))"))


def chat_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 50 log entries per host and source."""
    return log_payloads(
        chat_logs(spark, sf_dir), chat_hosts(spark, sf_dir), ["host_id", "source"], ["conv_id", "turn"], 50,
        F.expr("conv_id div 16"),
    )


@query(
    "log_payload",
    f"""WITH {S.CHAT}, {S.META}
SELECT n.host_id, n.source, n.batch, count(*) AS n, any_value(m.agent_id) AS agent_id,
  sha256('host|' || n.host_id || '|') AS endpoint_id,
  'instance=' || any_value(m.hostname) || ';job=fleetlens-logs;team=' || any_value(m.team) || ';void=' AS tags,
  string_agg(n.conv_id || '.' || n.turn, ',' ORDER BY n.conv_id, n.turn) AS entries
FROM numbered n LEFT JOIN meta m ON 'host' || substr(m.host_id, 2) = n.host_id
GROUP BY n.host_id, n.source, n.batch""",
)
def log_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = lambda e: F.concat(e["fields"]["conv"], F.lit("."), e["meta"]["extra"]["turn"])
    return chat_payloads(spark, sf_dir).select(
        "host_id",
        "source",
        "batch",
        F.size("logs").cast("bigint").alias("n"),
        "agent_id",
        "endpoint_id",
        render_map(F.col("meta.tags")).alias("tags"),
        F.array_join(F.transform("logs", place), ",").alias("entries"),
    )


_BARE_ATTRS = """'field.conv=' || conv_id || ';log.category=chat'
  || CASE WHEN source <> '' THEN ';log.source=' || source ELSE '' END
  || CASE WHEN turn % 3 > 0 THEN ';process.pid=int:' || (turn % 3) ELSE '' END || ';tag.role=' || role"""


@query(
    "log_meta_default",
    f"""WITH {S.CHAT}
SELECT host_id, source, batch, seq,
  CASE WHEN turn % 2 = 0 THEN {_BARE_ATTRS} ELSE {_LOG_ATTRS} END AS attrs,
  CASE WHEN turn % 2 = 0 THEN 'none' ELSE role END AS "user" FROM numbered""",
)
def log_meta_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of logs half of which have no metadata: their record is there, and empty."""
    logs = chat_logs(spark, sf_dir)
    bare = logs.withColumn("meta", F.when(F.col("turn") % 2 != 0, F.col("meta")))
    packed = log_payloads(
        bare, meta_table(spark, sf_dir), ["host_id", "source"], ["conv_id", "turn"], 50, F.expr("conv_id div 16")
    )
    return packed.select("host_id", "source", "batch", F.posexplode("logs").alias("seq", "entry")).select(
        "host_id",
        "source",
        "batch",
        F.col("seq").cast("bigint").alias("seq"),
        render_attributes(log_attributes(F.col("entry"))).alias("attrs"),
        F.when(F.col("entry.meta").isNull(), "null").otherwise(F.coalesce("entry.meta.user", F.lit("none"))).alias("user"),
    )


OTLP_LOGS_SQL = f"""WITH {S.CHAT}, {S.META}
SELECT n.host_id, n.batch, CASE WHEN n.source = '' THEN 'unknown' ELSE n.source END AS scope,
  'agent.id=' || m.agent_id || ';agent.version=1.0;cloud.region=' || m.region || ';endpoint.id='
  || sha256('host|' || n.host_id || '|') || CASE WHEN m.environment IS NULL THEN '' ELSE ';environment=prod' END
  || ';host.id=' || n.host_id || ';host.ip=' || m.ip || ';host.name=' || m.hostname || ';os.type=' || m.os
  || ';resource.kind=host;tag.instance=' || m.hostname || ';tag.job=fleetlens-logs;tag.team=' || m.team AS resource,
  n.seq, n.us * 1000 AS time_unix_nano, CAST(n.severity AS INTEGER) AS severity_number,
  n.level AS severity_text, md5(n.text) AS body, {_LOG_ATTRS} AS attrs
FROM numbered n JOIN meta m ON 'host' || substr(m.host_id, 2) = n.host_id"""


@query("otlp_logs", OTLP_LOGS_SQL)
def nested_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_log_text(otlp_logs(chat_payloads(spark, sf_dir)))


def nested_log_text(nested: DataFrame) -> DataFrame:
    """The nested log export, flattened again for comparison."""
    scopes = nested.select(
        "host_id",
        "batch",
        F.explode("resource_logs").alias("r"),
    ).select(
        "host_id",
        "batch",
        F.map_from_entries("r.resource.attributes").alias("resource"),
        F.explode("r.scope_logs").alias("s"),
    )
    return scopes.select(
        "host_id",
        "batch",
        F.col("s.scope.name").alias("scope"),
        render_map(F.col("resource")).alias("resource"),
        F.posexplode("s.log_records").alias("seq", "l"),
    ).select(
        "host_id",
        "batch",
        "scope",
        "resource",
        F.col("seq").cast("bigint").alias("seq"),
        "l.time_unix_nano",
        "l.severity_number",
        "l.severity_text",
        F.md5("l.body").alias("body"),
        render_attributes(F.col("l.attributes")).alias("attrs"),
    )


# --- metrics ------------------------------------------------------------------

_META_ATTRS = """'agent.id=' || m.agent_id || ';agent.version=1.0;cloud.region=' || m.region
  || CASE WHEN i.kind = 'container' THEN ';container.id=' || i.container_id || ';container.image.name=' || i.image
       || ';container.name=' || i.container_name ELSE '' END
  || ';endpoint.id=' || i.endpoint_id || CASE WHEN m.environment IS NULL THEN '' ELSE ';environment=prod' END
  || ';host.id=' || i.host_id || ';host.ip=' || m.ip || ';host.name=' || m.hostname || ';os.type=' || m.os
  || ';resource.kind=' || i.kind || ';tag.agent_start_time=1704067200;tag.instance='
  || CASE WHEN i.kind = 'container' THEN i.container_name ELSE m.hostname END
  || ';tag.job=fleetlens-' || CASE WHEN i.kind = 'container' THEN 'container' ELSE 'agent' END
  || ';tag.namespace=app' || CASE WHEN i.status IS NULL THEN '' ELSE ';tag.status=' || i.status END
  || ';tag.subnamespace=' || i.sub_namespace || ';tag.team=' || m.team"""


@query(
    "metric_payload",
    f"""WITH {_PARTS}, {_IDENTITY}, {S.META},
parts AS (SELECT endpoint_id, day_us, part, count(*) AS n, count(*) FILTER (WHERE sample_count IS NOT NULL) AS with_stats,
  sum(coalesce(sample_count, 0)) AS samples FROM placed GROUP BY endpoint_id, day_us, part)
SELECT i.endpoint_id, i.day_us AS tick_us, p.part, p.n, p.with_stats, CAST(p.samples AS BIGINT) AS samples,
  CAST(60 * p.n AS BIGINT) AS resolution, m.agent_id, m.hostname, i.kind, i.image AS image_name,
  CASE WHEN i.status IS NOT NULL AND i.kind = 'container' THEN i.status END AS status
FROM parts p JOIN identity i USING (endpoint_id, day_us) LEFT JOIN meta m ON m.host_id = i.host_id""",
)
def metric_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain nested payload with statistic sets and metadata."""
    built = legacy_payload(full_payloads(spark, sf_dir))
    stats = F.filter("metrics", lambda m: m["stats"].isNotNull())
    zero = F.lit(0).cast("bigint")
    return built.select(
        "endpoint_id",
        F.unix_micros("tick").alias("tick_us"),
        "part",
        F.size("metrics").cast("bigint").alias("n"),
        F.size(stats).cast("bigint").alias("with_stats"),
        F.aggregate(stats, zero, lambda a, m: a + m["stats"]["sample_count"]).alias("samples"),
        F.aggregate("metrics", zero, lambda a, m: a + m["storage_resolution"]).alias("resolution"),
        "agent_id",
        "hostname",
        "meta.kind",
        F.col("meta.container_image_name").alias("image_name"),
        F.col("meta.tags")["status"].alias("status"),
    )


@query(
    "otlp_metrics",
    f"""WITH {_PARTS}, {_IDENTITY}, {S.META}
SELECT p.endpoint_id, p.day_us AS tick_us, p.part, 'App.' || p.sub_namespace AS scope,
  {_META_ATTRS.replace("i.status IS NULL", "i.status IS NULL OR i.kind = 'host'")} AS resource,
  row_number() OVER (PARTITION BY p.endpoint_id, p.day_us, p.part, p.sub_namespace ORDER BY p.us, p.event_id) - 1 AS seq,
  p.name, 'count' AS unit, p.us * 1000 AS time_unix_nano, p.attrs,
  CASE WHEN coalesce(p.sample_count, 0) > 0 THEN 'histogram' ELSE 'gauge' END AS point,
  CASE WHEN coalesce(p.sample_count, 0) > 0 THEN NULL ELSE p.value END AS value,
  CASE WHEN p.sample_count > 0 THEN p.sample_count END AS count,
  CASE WHEN p.sample_count > 0 THEN round(p.raw_value * 3, 6) END AS sum,
  CASE WHEN p.sample_count > 0 THEN p.raw_value END AS minimum
FROM placed p JOIN identity i USING (endpoint_id, day_us) LEFT JOIN meta m ON m.host_id = i.host_id""",
)
def nested_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested metric export, flattened again for comparison."""
    nested = otlp_metrics(full_payloads(spark, sf_dir))
    scopes = nested.select(
        "endpoint_id", "tick", "part", F.explode("resource_metrics").alias("r")
    ).select(
        "endpoint_id",
        "tick",
        "part",
        F.map_from_entries("r.resource.attributes").alias("resource"),
        F.explode("r.scope_metrics").alias("s"),
    )
    flat = scopes.select(
        "endpoint_id",
        F.unix_micros("tick").alias("tick_us"),
        "part",
        F.col("s.scope.name").alias("scope"),
        render_map(F.col("resource")).alias("resource"),
        F.posexplode("s.metrics").alias("seq", "m"),
    )
    either = lambda f: F.coalesce(F.col(f"m.gauge.{f}"), F.col(f"m.histogram.{f}"))
    return flat.select(
        "endpoint_id",
        "tick_us",
        "part",
        "scope",
        "resource",
        F.col("seq").cast("bigint").alias("seq"),
        "m.name",
        "m.unit",
        either("time_unix_nano").alias("time_unix_nano"),
        render_map(F.map_from_entries(either("attributes"))).alias("attrs"),
        F.when(F.col("m.gauge").isNotNull(), "gauge").otherwise("histogram").alias("point"),
        F.col("m.gauge.as_double").alias("value"),
        "m.histogram.count",
        F.round("m.histogram.sum", 6).alias("sum"),
        F.col("m.histogram.min").alias("minimum"),
    )


@query("sink_ndjson", PAYLOAD_SQL)
def sink_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads written as lines of JSON, by a job that is run twice, and read back."""
    path = work_folder(spark, "ndjson")
    built = payloads(spark, sf_dir)
    for _ in range(2):
        append_ndjson(built, path, job_id="2024/01")
    return payload_text(read_ndjson(spark, path, built.schema))


@query(
    "resumed_rows",
    f"WITH {S.APP} SELECT event_id, us, host_id, sub_namespace, value FROM app",
)
def resumed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a capture that grows in between, the second started twice."""
    path = work_folder(spark, "resumed")
    rows = A.app_metrics(A.events(spark, sf_dir)).select("event_id", "us", "host_id", "sub_namespace", "value", "ts")
    keys = ["host_id", "sub_namespace"]
    resume(rows.filter(F.col("us") < S.EPOCH_US + 10 * DAY_US), path, "first", keys, "ts", "event_id")
    for _ in range(2):
        resume(rows, path, "second", keys, "ts", "event_id")
    resume(rows, path, "third", keys, "ts", "event_id")
    return Committed(spark, path).read("data", rows.schema, "parquet").drop("ts")
