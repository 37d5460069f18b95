"""Pieces of SQL text that several counterparts share."""

from __future__ import annotations

EPOCH_US = 1704067200000000
REF_US = 1735603200000000

EV = "ev AS (SELECT *, epoch_us(ts) AS us FROM events)"

# Container samples straight from the events.
SAMPLES = EV + f""",
s0 AS (
  SELECT event_id, user_id, us, event_type, value, us - {EPOCH_US} AS rel,
    lpad(lower(hex(user_id)), 12, '0') AS cid,
    CAST(round(value * 10) AS BIGINT) AS lo
  FROM ev
),
samples AS (
  SELECT *,
    ((rel * (1 + user_id % 7)) // 2 + CAST(round(value * 1000) AS BIGINT)) % 4000000000000 AS cpu_total,
    rel * 4 AS cpu_system,
    ((rel // 1000) * (1 + user_id % 5) + CAST(round(value * 100) AS BIGINT)) % 3000000000 AS iface_rx
  FROM s0
),
counters AS (
  SELECT *, iface_rx + lo AS rx, iface_rx // 2 + lo AS tx FROM samples
),
lagged AS (
  SELECT *, lag(us) OVER w AS p_us, lag(cpu_total) OVER w AS p_cpu, lag(cpu_system) OVER w AS p_sys,
    lag(rx) OVER w AS p_rx, lag(tx) OVER w AS p_tx
  FROM counters WINDOW w AS (PARTITION BY cid ORDER BY us, event_id)
),
rated AS (
  SELECT *,
    CASE WHEN cpu_total > p_cpu AND cpu_system > p_sys
      THEN CAST(cpu_total - p_cpu AS DOUBLE) / CAST(cpu_system - p_sys AS DOUBLE) * 4 * 100
      ELSE 0 END AS cpu_percent,
    CASE WHEN us > p_us
      THEN CAST(greatest(rx - p_rx, 0) AS DOUBLE) / (CAST(us - p_us AS DOUBLE) / 1000000) ELSE 0 END AS rx_rate,
    CASE WHEN us > p_us
      THEN CAST(greatest(tx - p_tx, 0) AS DOUBLE) / (CAST(us - p_us AS DOUBLE) / 1000000) ELSE 0 END AS tx_rate,
    coalesce(cpu_total < p_cpu OR rx < p_rx OR tx < p_tx, false) AS reset
  FROM lagged
)"""

# Listed containers from the customers.
CONTAINERS = f"""containers AS (
  SELECT c_custkey, lpad(lower(hex(c_custkey)), 12, '0') AS cid, c_name AS cname,
    CASE WHEN c_custkey % 3 = 2 THEN 'reg:5000/' ELSE '' END || lower(c_mktsegment)
      || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ':1.' || (c_custkey % 10) END AS image,
    CASE c_custkey % 3 WHEN 1 THEN '1.' || (c_custkey % 10) END AS version,
    CASE c_custkey % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'exited' ELSE 'Running' END AS state,
    c_custkey % 3 <> 1 AS running,
    lower(c_mktsegment) AS tier,
    c_custkey % 4 AS mounts,
    {EPOCH_US} + (c_custkey % 30) * 86400000000 AS created_us,
    CASE WHEN c_acctbal >= 0
      THEN CASE WHEN c_nationkey % 2 = 0 THEN 'healthy' ELSE 'unhealthy' END END AS health,
    c_acctbal >= 0 AS inspected,
    CASE WHEN c_custkey % 4 <> 0
      THEN (8000 + c_custkey % 1000) || ':80/tcp,443/udp' END AS ports
  FROM customer
)"""


def uptime(started: str) -> str:
    seconds = f"(CAST(us - {started} AS DOUBLE) / 1000000)"
    return f"CASE WHEN running AND {started} IS NOT NULL AND {seconds} BETWEEN 0 AND 1000000 THEN {seconds} ELSE 0 END"


def dims(runtime: str, **more: str) -> str:
    """Dimension text of a container row: ``k=v`` in key order, null parts left out."""
    parts = {
        "container_id": "cid",
        "container_version": "version",
        "image": "image",
        "label.tier": "tier",
        "mount_count": "mounts",
        "name": "cname",
        "runtime": f"'{runtime}'",
        "status": "state",
    } | more
    return "concat_ws(';', " + ", ".join(f"'{k}=' || ({parts[k]})" for k in sorted(parts)) + ")"


def metric_rows(source: str, host: str, us: str, rows: list[tuple]) -> str:
    """``UNION ALL`` of metric rows; each is (sub, name, value, type, unit, dims[, where])."""
    out = []
    for sub, name, value, kind, unit, dim, *where in rows:
        name_sql = name[1:] if name.startswith("=") else f"'{name}'"
        out.append(
            f"SELECT {host} AS host_id, CAST({us} AS BIGINT) AS us, '{sub}' AS sub_namespace, "
            f"{name_sql} AS name, '{kind}' AS type, '{unit}' AS unit, "
            f"round(CAST({value} AS DOUBLE), 6) AS value, {dim} AS dims FROM {source}"
            + (f" WHERE {where[0]}" if where else "")
        )
    return "\nUNION ALL\n".join(out)


# App metrics, as rows of the events.
APP = EV + """,
app AS (
  SELECT event_id, us, 'h' || (user_id % 10) AS host_id, event_type AS sub_namespace,
    CASE WHEN event_id % 5 = 0 THEN 'running' ELSE 'value' END AS name,
    CASE WHEN event_id % 10 = 0 THEN 1.0::DOUBLE ELSE value END AS value,
    CASE WHEN user_id % 3 = 0 THEN 'host' ELSE 'container' END AS kind,
    CASE WHEN user_id % 3 = 0 THEN '' ELSE 'c' || user_id END AS container_id,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'web' || (user_id % 10) END AS container_name,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'img' || (event_id % 4) END AS image,
    CASE WHEN user_id % 3 = 0 THEN 'host=h' || user_id
      ELSE 'container_id=c' || user_id || ';empty=;image=img' || (event_id % 4)
        || ';name=web' || (user_id % 10) END AS dims,
    CASE WHEN user_id % 3 = 0 THEN 'host=h' || user_id
      ELSE 'container_id=c' || user_id || ';image=img' || (event_id % 4)
        || ';name=web' || (user_id % 10) END AS attrs,
    CASE WHEN event_id % 4 = 0 THEN event_id % 3 END AS sample_count,
    value AS raw_value,
    us // 86400000000 * 86400000000 AS day_us
  FROM ev
),
routed AS (
  SELECT *, sha256(kind || '|' || host_id || '|' || container_id) AS endpoint_id FROM app
)"""

# Host metadata of the nations: text of the attributes that are not empty.
META = """meta AS (
  SELECT 'h' || n_nationkey AS host_id, lower(n_name) AS hostname, 'agent' || n_nationkey AS agent_id,
    CASE WHEN n_nationkey % 2 = 0 THEN 'linux' ELSE 'windows' END AS os,
    '10.0.0.' || n_nationkey AS ip, 'region' || n_regionkey AS region,
    CASE WHEN n_nationkey % 4 <> 0 THEN 'prod' END AS environment,
    't' || n_regionkey AS team
  FROM nation
)"""

# Log rows of the conversations with their batch numbers.
CHAT = f"""chat AS (
  SELECT conv_id, turn, role, text, 'host' || (conv_id % 4) AS host_id,
    CASE WHEN role = 'system' THEN '' ELSE role END AS source,
    {EPOCH_US} + conv_id * 60000000 + turn * 1000000 AS us,
    CASE role WHEN 'user' THEN 'info' WHEN 'system' THEN 'Warn' ELSE 'error' END AS level,
    CASE role WHEN 'user' THEN 9 WHEN 'system' THEN 0 ELSE 17 END AS severity
  FROM conversations
),
numbered AS (
  SELECT *, (row_number() OVER w - 1) // 50 AS batch, (row_number() OVER w - 1) % 50 AS seq
  FROM chat WINDOW w AS (PARTITION BY host_id, source ORDER BY conv_id, turn)
)"""
