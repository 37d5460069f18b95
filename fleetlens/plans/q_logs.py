"""Queries over logs and over the text functions they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import levels as L
from fleetlens.functions.maps import render_map
from fleetlens.functions.points import to_double
from fleetlens.functions.text import parse_tags, sanitize_utf8, split_csv, truncate_bytes
from fleetlens.functions.timestamps import (
    from_micros,
    from_millis,
    from_seconds,
    syslog_timestamp,
    unix_nanos,
    wall_clock_us,
    within_lookback,
)
from fleetlens.operators.batching import admit, number_batches
from fleetlens.operators.channels import select_channels
from fleetlens.operators.lookups import resolve_user
from fleetlens.plans import adapters as A
from fleetlens.plans import sqltext as S
from fleetlens.plans.catalog import query
from fleetlens.session import work_folder
from fleetlens.sources.eventlog import (
    event_data,
    event_logs,
    event_message,
    full_data,
    parse_event,
    rendered_message,
)
from fleetlens.sources.journal import journal_logs
from fleetlens.sources.registry import log_registry
from fleetlens.sources.syslog import auth_logs

# --- auth log -----------------------------------------------------------------

AUTH_CTE = S.EV + """,
auth AS (
  SELECT event_id, us, 'host' || (user_id % 10) AS host_id,
    ['sshd', 'CRON', 'sudo', 'su', 'login'][event_id % 5 + 1] AS source,
    CASE event_type WHEN 'view' THEN 'session opened for user u' || user_id
      WHEN 'signup' THEN 'Accepted publickey for u' || user_id
      WHEN 'error' THEN 'error: Access DENIED for u' || user_id
      WHEN 'click' THEN 'Failed password for invalid user u' || user_id
      ELSE 'Error: failed login of u' || user_id END AS message,
    CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'info' WHEN 'signup' THEN 'info'
      ELSE 'warn' END AS level
  FROM ev
)"""
AUTH_SQL = f"""WITH {AUTH_CTE}
SELECT host_id, us // 1000000 * 1000000 AS us, level, message, source, 'auth' AS category,
  'hostname_log=' || host_id || ';log_path=/var/log/auth.log' AS labels
FROM auth"""


def auth_text(logs: DataFrame) -> DataFrame:
    return logs.select(
        "host_id",
        F.unix_micros("ts").alias("us"),
        "level",
        "message",
        "source",
        "category",
        render_map(F.col("labels")).alias("labels"),
    )


@query("auth_logs", AUTH_SQL)
def auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auth_text(auth_logs(A.syslog_lines(A.events(spark, sf_dir))))


@query(
    "syslog_ts",
    """WITH o AS (
  SELECT o_orderkey, o_orderdate AS d, o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) AS ref FROM orders
),
y AS (
  SELECT *, year(ref) - CASE WHEN month(d) > month(ref) THEN 1 ELSE 0 END AS yy FROM o
)
SELECT o_orderkey, epoch_us(CAST(make_date(yy, month(d), 1) AS TIMESTAMP)
  + to_days(CAST(day(d) - 1 AS INTEGER)) + to_seconds(o_orderkey % 86400)) AS us
FROM y""",
)
def syslog_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-less times of the order dates, read some days later."""
    orders = A.table(spark, sf_dir, "orders")
    clock = (
        "concat_ws(':', lpad((o_orderkey % 86400) div 3600, 2, '0'), "
        "lpad((o_orderkey % 3600) div 60, 2, '0'), lpad(o_orderkey % 60, 2, '0'))"
    )
    ref = from_micros(wall_clock_us(F.col("o_orderdate")) + F.expr("o_orderkey % 400 * 86400000000"))
    parts = orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "MMM").alias("month"),
        F.date_format("o_orderdate", "d").alias("day"),
        F.expr(clock).alias("clock"),
        ref.alias("ref_ts"),
    )
    ts = syslog_timestamp(F.col("month"), F.col("day"), F.col("clock"), F.col("ref_ts"))
    return parts.select("o_orderkey", F.unix_micros(ts).alias("us"))


@query(
    "detect_severity",
    """SELECT page_id, CASE
    WHEN contains(lower(html), 'failed') OR contains(lower(html), 'invalid') THEN 'warn'
    WHEN contains(lower(html), 'error') OR contains(lower(html), 'denied') THEN 'error'
    ELSE 'info' END AS level
FROM (SELECT page_id, html || CASE page_id % 4 WHEN 0 THEN ' Access DENIED' WHEN 1 THEN ' Error, then FAILED'
  ELSE '' END AS html FROM pages)""",
)
def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword severity of whole pages, to which some get a keyword at the end."""
    tail = F.expr(
        "concat(html, case page_id % 4 when 0 then ' Access DENIED' when 1 then ' Error, then FAILED' else '' end)"
    )
    pages = A.table(spark, sf_dir, "pages").withColumn("lower_html", F.lower(tail))
    return pages.select("page_id", L.detect_severity(F.col("lower_html"), lowered=True).alias("level"))


# --- journal ------------------------------------------------------------------

_JOURNAL = S.EV + """,
journal AS (
  SELECT *, 'host' || (user_id % 10) AS host_id,
    ['sshd', 'kernel', 'Docker', 'app', 'NetworkManager', ''][event_id % 6 + 1] AS identifier,
    CASE WHEN event_id % 7 < 3 THEN 'nginx.service' WHEN event_id % 7 < 5 THEN 'other.unit' END AS unit
  FROM ev
),
by_unit AS (
  SELECT *, CASE WHEN unit = 'nginx.service' THEN 'application' ELSE 'systemd' END AS unit_category
  FROM journal
),
categorised AS (
  SELECT *, CASE identifier WHEN 'sshd' THEN 'auth' WHEN 'kernel' THEN 'system'
    WHEN 'Docker' THEN 'container' WHEN 'NetworkManager' THEN 'network' ELSE unit_category END AS category
  FROM by_unit
),
named AS (
  SELECT j.*, CASE WHEN event_id % 13 = 0 THEN 'named' WHEN event_id % 17 = 0 THEN 'sudoer'
    ELSE coalesce(c.c_name, '') END AS user_name
  FROM categorised j
  LEFT JOIN customer c ON c.c_custkey = j.user_id AND c.c_custkey % 2 = 0
)"""


def _fields(prefix: str) -> str:
    """Text of the kept journal fields, with or without their leading underscore."""
    u = prefix
    parts = {
        f"{u}CMDLINE": "'p' || (event_id % 9) || ' --run'",
        "CONTAINER_ID": "CASE WHEN event_id % 3 = 0 THEN 'c' || user_id END",
        f"{u}EXE": "'/usr/bin/p' || (event_id % 9)",
        "MESSAGE_ID": "CASE WHEN event_id % 2 = 0 THEN 'm' || event_id END",
        f"{u}PID": "CASE WHEN event_id % 11 = 0 THEN 'x1' ELSE CAST(event_id AS VARCHAR) END",
        "SYSLOG_IDENTIFIER": "nullif(identifier, '')",
        f"{u}SYSTEMD_SLICE": "CASE WHEN event_id % 7 < 3 THEN 'system.slice' END",
        f"{u}SYSTEMD_UNIT": "unit",
        f"{u}UID": "CAST(user_id AS VARCHAR)",
    }
    if not prefix:
        parts["HOSTNAME"] = "host_id"
    return "concat_ws(';', " + ", ".join(f"'{k}=' || ({parts[k]})" for k in sorted(parts)) + ")"


JOURNAL_SQL = f"""WITH {_JOURNAL}
SELECT host_id, us, CASE event_id % 8 WHEN 3 THEN 'error' WHEN 4 THEN 'warning' ELSE 'critical' END AS level,
  event_type || ' by ' || user_id AS message, category,
  CAST(CASE WHEN event_id % 11 = 0 THEN 0 ELSE event_id END AS INTEGER) AS pid,
  {_fields('')} AS fields, {_fields('_')} AS extra,
  CASE WHEN event_id % 3 = 0 THEN 'container_id=c' || user_id ELSE '' END AS labels,
  user_name AS "user", '/usr/bin/p' || (event_id % 9) AS executable, coalesce(unit, '') AS unit
FROM named WHERE event_id % 8 <= 4 AND identifier <> 'kernel'"""


@query("journal_logs", JOURNAL_SQL)
def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = A.journal_records(A.events(spark, sf_dir))
    return journal_text(journal_logs(records, A.journal_users(A.table(spark, sf_dir, "customer"))))


@query("journal_raw", JOURNAL_SQL)
def journal_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal's own JSON, written as lines and read by the registry."""
    path = work_folder(spark, "journal-raw")
    A.journal_lines(A.events(spark, sf_dir)).write.text(f"{path}/journal")
    users = A.journal_users(A.table(spark, sf_dir, "customer"))
    return journal_text(log_registry().collect(spark, ["journald"], {"path": path, "format": "raw", "users": users}))


def journal_text(logs: DataFrame) -> DataFrame:
    return logs.select(
        "host_id",
        F.unix_micros("ts").alias("us"),
        "level",
        "message",
        "category",
        "pid",
        render_map(F.col("fields")).alias("fields"),
        render_map(F.col("meta.extra")).alias("extra"),
        render_map(F.col("labels")).alias("labels"),
        "meta.user",
        "meta.executable",
        "meta.unit",
    )


@query("classify_journal", f"WITH {_JOURNAL} SELECT event_id, category FROM categorised")
def classify_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = A.journal_records(A.events(spark, sf_dir))
    category = L.journal_category(F.col("SYSLOG_IDENTIFIER"), F.col("_SYSTEMD_UNIT"))
    return records.select("event_id", category.alias("category"))


@query("user_lookup", f'WITH {_JOURNAL} SELECT event_id, user_name AS "user" FROM named')
def user_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [F.col("USERNAME"), F.col("SUDO_USER"), F.col("SSH_USER")]
    return resolve_user(
        A.journal_records(A.events(spark, sf_dir)),
        named,
        F.col("_UID"),
        A.journal_users(A.table(spark, sf_dir, "customer")),
    ).select("event_id", "user")


_EVENT_TEXTS = ["critical", "Error", "WARNING", "Information", "verbose", "strange"]
_LEVELS = ["trace", "DEBUG", "info", "warn", "Warn", "WARNING", "error", "FATAL", "critical", "unknown"]


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query(
    "level_map",
    f"""SELECT event_id,
  ['critical', 'critical', 'critical', 'error', 'warning', 'info', 'info', 'debug', 'unknown'][event_id % 9 + 1]
    AS journal_level,
  ['error', 'error', 'warning', 'info', 'debug', 'info'][event_id % 6 + 1] AS text_level,
  ['info', 'error', 'error', 'warning', 'info', 'debug', 'info'][event_id % 7 + 1] AS number_level,
  'info' AS compat_level
FROM events""",
)
def level_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr("cast(event_id % 7 as int)")
    text = F.expr(A._pick(_EVENT_TEXTS, "event_id"))
    return A.table(spark, sf_dir, "events").select(
        "event_id",
        L.journal_level(F.expr("cast(event_id % 9 as string)")).alias("journal_level"),
        L.event_level(text).alias("text_level"),
        L.event_level_from_number(number).alias("number_level"),
        L.event_level_from_number(number, compat=True).alias("compat_level"),
    )


@query(
    "severity_number",
    f"""SELECT event_id, {_listed(_LEVELS)}[event_id % 10 + 1] AS level,
  CAST([1, 5, 9, 13, 0, 13, 17, 21, 21, 0][event_id % 10 + 1] AS INTEGER) AS severity_number
FROM events""",
)
def severity_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events").withColumn("level", F.expr(A._pick(_LEVELS, "event_id")))
    return events.select(
        "event_id", "level", L.severity_number(F.col("level")).alias("severity_number")
    )


# --- Windows events -----------------------------------------------------------

_WIN = S.EV + f""",
win0 AS (
  SELECT *, {_listed(A.CHANNELS)}[event_id % 7 + 1] AS channel,
    {_listed(A.PROVIDERS)}[event_id // 7 % 3 + 1] AS provider,
    event_id % 97 = 0 AS bad, event_id % 4 * 100 AS process_id,
    CASE WHEN event_id % 3 = 0 THEN 'S-1-5-' || user_id END AS sid
  FROM ev
),
win AS (
  SELECT *,
    '<Event><System><Provider Name="' || provider || '" Guid="'
      || CASE WHEN event_id % 2 = 0 THEN '{{g}}' ELSE '' END || '"/><EventID>' || (event_id % 5000)
      || '</EventID><Level>' || (event_id % 6) || '</Level><TimeCreated SystemTime="'
      || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '7Z"/><Channel>' || channel || '</Channel><Computer>pc'
      || (user_id % 20) || '</Computer><Security UserID="' || coalesce(sid, '') || '"/><Execution ProcessID="'
      || process_id || '" ThreadID="1"/></System><EventData><Data Name="Kind">' || event_type
      || '</Data><Data Name="kind">' || upper(event_type)
      || '</Data><Data>loose</Data><Data Name="Empty"></Data></EventData>' AS cut_xml,
    concat_ws(' | ', '[' || provider || '] Event ID ' || (event_id % 5000), 'Kind: ' || event_type,
      'kind: ' || upper(event_type), CASE WHEN process_id > 0 THEN 'Process: ' || process_id END,
      'User: ' || sid) AS message,
    concat_ws(' | ', 'Event ID: ' || (event_id % 5000), 'Kind: ' || event_type,
      'kind: ' || upper(event_type), 'loose', 'Empty: ',
      CASE WHEN process_id > 0 THEN 'Process: ' || process_id END, 'User: ' || sid) AS rendered,
    CASE provider WHEN 'docker' THEN 'container' WHEN 'Microsoft-Windows-DNS-Client' THEN 'network'
      ELSE 'system' END AS provider_category
  FROM win0
),
win_full AS (
  SELECT *, CASE channel WHEN 'System' THEN 'system' WHEN 'security' THEN 'auth'
    WHEN 'Microsoft-Windows-Firewall/Operational' THEN 'security' WHEN 'Application' THEN 'app'
    WHEN 'Microsoft-Windows-TaskScheduler/Operational' THEN 'scheduler'
    ELSE provider_category END AS category
  FROM win
)"""
_WIN_FIELDS = """concat_ws(';', 'channel=' || channel, 'computer=pc' || (user_id % 20),
    'event_id=' || (event_id % 5000), 'kind=' || upper(event_type),
    CASE WHEN process_id > 0 THEN 'process_id=' || process_id END, 'provider=' || provider,
    CASE WHEN event_id % 2 = 0 THEN 'provider_guid={g}' END, 'user_id=' || sid)"""


@query(
    "win_logs",
    f"""WITH {_WIN}
SELECT 'win' || (user_id % 10) AS host_id, CASE WHEN bad THEN {S.REF_US} ELSE us END AS us,
  CASE WHEN bad THEN 'info'
    ELSE ['info', 'error', 'error', 'warning', 'info', 'debug'][event_id % 6 + 1] END AS level,
  CASE WHEN bad THEN cut_xml ELSE message END AS message,
  CASE WHEN bad THEN 'system' ELSE category END AS category,
  CAST(CASE WHEN bad THEN 0 ELSE process_id END AS INTEGER) AS pid,
  CASE WHEN bad THEN 'channel=;provider=' ELSE {_WIN_FIELDS} END AS fields,
  CASE WHEN bad THEN '' ELSE 'computer=pc' || (user_id % 20) || ';event_id=' || (event_id % 5000) END AS labels,
  channel AS service, CASE WHEN bad THEN '' ELSE coalesce(sid, '') END AS "user"
FROM win_full""",
)
def win_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_logs(A.event_xml(A.events(spark, sf_dir))).select(
        "host_id",
        F.unix_micros("ts").alias("us"),
        "level",
        "message",
        "category",
        "pid",
        render_map(F.col("fields")).alias("fields"),
        render_map(F.col("labels")).alias("labels"),
        "meta.service",
        "meta.user",
    )


@query(
    "win_message",
    f"""WITH {_WIN}
SELECT event_id, CASE WHEN NOT bad THEN message END AS message,
  CASE WHEN NOT bad THEN rendered END AS rendered
FROM win""",
)
def win_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both message forms; null for what is no event."""
    parsed = A.event_xml(A.events(spark, sf_dir)).select(
        "event_id", parse_event(F.col("xml")).alias("e")
    )
    event = F.col("e")
    good = event["_malformed"].isNull()
    with_data = parsed.withColumn("full", full_data(event_data(event)))
    return with_data.select(
        "event_id",
        F.when(good, event_message(event, F.col("full"))).alias("message"),
        F.when(good, rendered_message(event)).alias("rendered"),
    )


@query("classify_event", f"WITH {_WIN} SELECT event_id, category FROM win_full")
def classify_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    channel = F.expr(A._pick(A.CHANNELS, "event_id"))
    provider = F.expr(A._pick(A.PROVIDERS, "(event_id div 7)"))
    return A.table(spark, sf_dir, "events").select(
        "event_id", L.event_category(channel, provider).alias("category")
    )


@query(
    "channel_select",
    f"""WITH {_WIN},
kept AS (SELECT * FROM win WHERE NOT regexp_matches(channel, '^Microsoft-Windows-Diagnosis-.*$')
  AND NOT regexp_matches(channel, '^Forw.*Events$'))
SELECT event_id, channel AS channel_name, 'listed' AS mode FROM kept
WHERE lower(channel) IN ('system', 'security', 'application', 'forwardedevents')
UNION ALL SELECT event_id, channel, 'all' FROM kept""",
)
def channel_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the listed channels, and those that remain when all are collected."""
    events = A.event_xml(A.events(spark, sf_dir)).select("event_id", "channel_name")
    include = ["SYSTEM", "Security", "application", "ForwardedEvents"]
    globs = ["Microsoft-Windows-Diagnosis-*", "Forw*Events", "broken("]
    listed = select_channels(events, include, globs).withColumn("mode", F.lit("listed"))
    everything = select_channels(events, include, globs, collect_all=True)
    return listed.unionByName(everything.withColumn("mode", F.lit("all")))


@query(
    "log_union",
    f"""WITH {AUTH_CTE}, {_JOURNAL.removeprefix(S.EV + ',')},
rows_out AS (
  SELECT source, level, 'auth' AS category FROM auth
  UNION ALL SELECT 'systemd', CASE event_id % 8 WHEN 3 THEN 'error' WHEN 4 THEN 'warning' ELSE 'critical' END,
    category FROM categorised WHERE event_id % 8 <= 4 AND identifier <> 'kernel'
)
SELECT source, level, category, count(*) AS n FROM rows_out GROUP BY source, level, category""",
)
def log_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All log sources of a Linux host as one table, summarised. The Windows source and
    an unknown one are skipped."""
    ev = A.events(spark, sf_dir)
    tables = {"journal": A.journal_records(ev), "syslog": A.syslog_lines(ev), "events_xml": A.event_xml(ev)}
    union = log_registry().collect(
        spark, ["journald", "security", "eventviewer", "kmsg"], {"tables": tables}
    )
    return union.groupBy("source", "level", "category").agg(F.count("*").alias("n"))


# --- batches ------------------------------------------------------------------


@query("log_batches", f"WITH {S.CHAT} SELECT conv_id, turn, host_id, source, batch, seq FROM numbered")
def log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = A.conversation_logs(A.table(spark, sf_dir, "conversations"))
    numbered = number_batches(
        logs, ["host_id", "source"], ["conv_id", "turn"], 50, F.expr("conv_id div 16")
    )
    return numbered.select("conv_id", "turn", "host_id", "source", "batch", "seq")


_SHED = f"""{S.CHAT},
placed AS (
  SELECT *, us // 3600000000 AS tick,
    row_number() OVER (PARTITION BY host_id, source, us // 3600000000 ORDER BY conv_id, turn) AS place
  FROM chat
)"""


@query(
    "shed_logs",
    f"""WITH {_SHED}
SELECT host_id, source, tick, count(*) FILTER (WHERE place <= 20) AS kept, count(*) FILTER (WHERE place > 20) AS shed,
  min(conv_id * 1000 + turn) FILTER (WHERE place > 20) AS first_shed, count(*) AS entries
FROM placed GROUP BY host_id, source, tick""",
)
def shed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What queues of 20 entries per host, source and hour take and shed; both add up to the input."""
    logs = A.conversation_logs(A.table(spark, sf_dir, "conversations")).withColumn(
        "tick", F.expr("unix_micros(ts) div 3600000000")
    )
    keys = ["host_id", "source", "tick"]
    kept, counts = admit(logs, keys, ["conv_id", "turn"], 20, F.expr("unix_seconds(ts) div 600"))
    taken = kept.groupBy(*keys).agg(F.count("*").alias("taken"))
    return counts.join(taken, keys, "left").select(
        *keys,
        "kept",
        "shed",
        (F.col("first_shed.conv_id") * 1000 + F.col("first_shed.turn")).alias("first_shed"),
        (F.coalesce("taken", F.lit(0)) + F.col("shed")).alias("entries"),
    )


# --- text functions -----------------------------------------------------------


@query(
    "truncate_message",
    """WITH d AS (SELECT doc_id, text, strlen(text) AS bytes, hex(encode(text)) AS hx FROM documents),
cut AS (
  SELECT *, CASE
    WHEN bytes <= 1000 THEN NULL
    WHEN substr(hx, 2001, 1) NOT IN ('8', '9', 'A', 'B') THEN 0
    WHEN substr(hx, 1999, 1) NOT IN ('8', '9', 'A', 'B') THEN 1
    WHEN substr(hx, 1997, 1) NOT IN ('8', '9', 'A', 'B') THEN 2 ELSE 3 END AS partial
  FROM d
)
SELECT doc_id, CASE WHEN partial IS NULL THEN md5(text)
  ELSE md5(decode(unhex(substr(hx, 1, CAST(2000 - 2 * partial AS BIGINT))))
    || CASE WHEN partial > 0 THEN chr(65533) ELSE '' END || ' [truncated]') END AS digest,
  bytes > 1000 AS truncated
FROM cut""",
)
def truncate_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents cut at 1000 bytes, in the middle of a character where it falls so."""
    documents = A.table(spark, sf_dir, "documents")
    cut = documents.withColumn("cut", truncate_bytes(F.col("text"), 1000))
    return cut.select(
        "doc_id",
        F.md5("cut").alias("digest"),
        (F.octet_length("text") > 1000).alias("truncated"),
    )


@query(
    "sanitize_utf8",
    """SELECT doc_id, md5(CASE doc_id % 3 WHEN 0 THEN text
  WHEN 1 THEN text || chr(65533) || lang || chr(65533) || chr(65533) || source
  ELSE text || chr(65533) || source END) AS digest
FROM documents""",
)
def sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with bad bytes put in: a run of three, next to marks that were there."""
    bad = F.expr(
        "case doc_id % 3 when 0 then text "
        "when 1 then cast(concat(cast(text as binary), X'FFFEC3', cast(concat(lang, '\\uFFFD\\uFFFD', source) as binary)) as string) "
        "else cast(concat(cast(text as binary), X'80', cast(source as binary)) as string) end"
    )
    documents = A.table(spark, sf_dir, "documents").withColumn("bad", bad)
    return documents.select("doc_id", F.md5(sanitize_utf8(F.col("bad"))).alias("digest"))


@query(
    "parse_tags",
    """SELECT event_id, 'a=' || (event_id % 7) || ';b=' || event_type || '=z' AS tags FROM events""",
)
def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "concat(' a = ', user_id, ', bad, =x, y=, b=', event_type, '=z,, a=', event_id % 7)"
    )
    return A.table(spark, sf_dir, "events").select(
        "event_id", render_map(parse_tags(text)).alias("tags")
    )


@query("split_csv", "SELECT event_id, event_type || '|' || user_id || '|x y' AS items FROM events")
def csv_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("concat(event_type, ' , ,', user_id, ',,  x y ')")
    return A.table(spark, sf_dir, "events").select(
        "event_id", F.array_join(split_csv(text), "|").alias("items")
    )


@query(
    "numeric_coerce",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 1 THEN 0
  WHEN 2 THEN -CAST(event_id AS DOUBLE) / 2 ELSE 0 END AS number FROM events""",
)
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "case event_id % 4 when 0 then cast(user_id as string) when 1 then concat('n', user_id) "
        "when 2 then concat('-', cast(cast(event_id as double) / 2 as decimal(30,1))) end"
    )
    return A.table(spark, sf_dir, "events").select("event_id", to_double(text).alias("number"))


@query(
    "epoch_convert",
    f"""WITH {S.EV}
SELECT event_id, us * 1000 AS from_us, us // 1000 * 1000000 AS from_ms, us // 1000000 * 1000000000 AS from_s
FROM ev""",
)
def epoch_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.events(spark, sf_dir).select(
        "event_id",
        unix_nanos(from_micros(F.col("us"))).alias("from_us"),
        unix_nanos(from_millis(F.expr("us div 1000"))).alias("from_ms"),
        unix_nanos(from_seconds(F.expr("us div 1000000"))).alias("from_s"),
    )


@query(
    "lookback_filter",
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5 MINUTE",
)
def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return A.events(spark, sf_dir).filter(within_lookback(F.col("ts"), start)).select("event_id")
