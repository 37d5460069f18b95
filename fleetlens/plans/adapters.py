"""The given tables in the shapes of raw captures.

Every adapter is a projection over a whole table: no shuffle and no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.resource import meta_struct
from fleetlens.functions.timestamps import from_micros, wall_clock_us
from fleetlens.operators.rates import interface_total

EPOCH_US = 1704067200000000  # 2024-01-01, the first day of the events
REF_US = 1735603200000000  # 2024-12-31, the "now" of the syslog lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, host: str) -> DataFrame:
    """Rows dealt to all cores by their host.

    A fleet's captures lie in many files; a small given table is one file, and one task would
    build and parse all that is made from it.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, F.expr(host))


def with_instant(df: DataFrame) -> DataFrame:
    """Zone-less ``ts`` of a table as ``us`` and as an instant."""
    return df.withColumn("us", wall_clock_us(F.col("ts"))).withColumn("ts", from_micros(F.col("us")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_instant(table(spark, sf_dir, "events"))


def container_id(number: str) -> Column:
    """A 64-digit container id whose first 12 digits are the number in hex."""
    return F.expr(f"rpad(lpad(lower(hex({number})), 12, '0'), 64, 'f')")


def docker_stats(ev: DataFrame) -> DataFrame:
    """One stats capture per event; the container is the user."""
    rel = f"(us - {EPOCH_US})"
    total = f"(({rel} * (1 + user_id % 7)) div 2 + cast(round(value * 1000) as bigint)) % 4000000000000"
    base = ev.select(
        "event_id",
        "us",
        "ts",
        "event_type",
        "value",
        container_id("user_id").alias("id"),
        F.expr(total).alias("cpu_total"),
        F.expr(f"{rel} * 4").alias("cpu_system"),
        F.expr(
            f"(({rel} div 1000) * (1 + user_id % 5) + cast(round(value * 100) as bigint)) % 3000000000"
        ).alias("iface_rx"),
        F.expr("cast(round(value * 10) as bigint)").alias("lo"),
    )
    u = lambda e: f"cast({e} as decimal(20,0))"
    iface = (
        f"named_struct('rx_bytes', {u('iface_rx')}, 'tx_bytes', {u('iface_rx div 2')}, "
        f"'rx_packets', {u('iface_rx div 1000')}, 'tx_packets', {u('iface_rx div 2000')}, "
        f"'rx_errors', {u('event_id % 3')}, 'tx_errors', {u('event_id % 4')}, "
        f"'rx_dropped', {u('event_id % 5')}, 'tx_dropped', {u('event_id % 6')})"
    )
    loop = (
        f"named_struct('rx_bytes', {u('lo')}, 'tx_bytes', {u('lo')}, 'rx_packets', {u('lo')}, "
        f"'tx_packets', {u('lo')}, 'rx_errors', {u('0')}, 'tx_errors', {u('0')}, "
        f"'rx_dropped', {u('0')}, 'tx_dropped', {u('0')})"
    )
    return base.select(
        "event_id",
        "us",
        F.lit("host0").alias("host_id"),
        "ts",
        "id",
        F.expr(
            f"named_struct('total', {u('cpu_total')}, 'system', {u('cpu_system')}, 'online', 4, "
            f"'percpu', array({u('cpu_total div 2')}, {u('cpu_total - cpu_total div 2')}), "
            f"'throttling', named_struct('periods', {u('event_id % 10')}, "
            f"'throttled_periods', {u('event_id % 7')}, 'throttled_time', {u('event_id % 5')}))"
        ).alias("cpu"),
        F.expr(
            f"named_struct('usage', {u('cast(round(value * 1024) as bigint)')}, "
            f"'limit', {u('1073741824')}, 'max', {u('cast(round(value * 2048) as bigint)')}, "
            f"'stats', map('Active Anon', {u('lo')}, 'cache', {u('event_id % 1000')}))"
        ).alias("memory"),
        F.expr(f"map(event_type, {iface}, 'lo', {loop})").alias("networks"),
        F.expr(
            f"array(named_struct('major', 8, 'minor', 0, 'op', 'Read', 'value', {u('event_id')}), "
            f"named_struct('major', 8, 'minor', 16, 'op', 'Write', 'value', {u('event_id * 2')}))"
        ).alias("blkio"),
        F.expr(u("1 + event_id % 50")).alias("pids"),
    )


def counter_samples(ev: DataFrame) -> DataFrame:
    """The counters of :func:`docker_stats` as flat columns."""
    stats = docker_stats(ev)
    return stats.select(
        "event_id",
        "us",
        "ts",
        "id",
        F.col("cpu.total").alias("cpu_total"),
        F.col("cpu.system").alias("cpu_system"),
        F.col("cpu.online").alias("online"),
        interface_total(F.col("networks"), "rx_bytes").alias("rx"),
        interface_total(F.col("networks"), "tx_bytes").alias("tx"),
    )


def docker_list(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.lit("host0").alias("host_id"),
        container_id("c_custkey").alias("id"),
        F.expr("array(concat('/', c_name))").alias("names"),
        F.expr(
            "concat(case when c_custkey % 3 = 2 then 'reg:5000/' else '' end, lower(c_mktsegment), "
            "case when c_custkey % 3 = 0 then '' else concat(':1.', c_custkey % 10) end)"
        ).alias("image"),
        F.expr("element_at(array('running', 'exited', 'Running'), cast(c_custkey % 3 + 1 as int))").alias(
            "state"
        ),
        F.expr("map('tier', lower(c_mktsegment))").alias("labels"),
        F.expr("array_repeat('/mnt', cast(c_custkey % 4 as int))").alias("mounts"),
        F.expr(f"{EPOCH_US // 1_000_000} + (c_custkey % 30) * 86400").alias("created"),
    )


def docker_inspect(customer: DataFrame) -> DataFrame:
    """Health of the containers that report one."""
    return customer.filter(F.col("c_acctbal") >= 0).select(
        F.lit("host0").alias("host_id"),
        container_id("c_custkey").alias("id"),
        F.expr("case when c_nationkey % 2 = 0 then 'healthy' else 'unhealthy' end").alias(
            "health_status"
        ),
    )


# When an order took a snapshot of its customer's container, within the time of the events.
SNAPSHOT_US = (
    f"{EPOCH_US} + unix_date(cast(o_orderdate as date)) % 30 * 86400000000 "
    "+ o_orderkey * 7919 % 86400000 * 1000"
)


def list_snapshots(orders: DataFrame) -> DataFrame:
    """List captures over time: each order shows its customer's container in another state."""
    return orders.select(
        F.lit("host0").alias("host_id"),
        from_micros(F.expr(SNAPSHOT_US)).alias("ts"),
        container_id("o_custkey").alias("id"),
        F.expr("array(concat('/c', o_custkey))").alias("names"),
        F.expr("concat('img', o_orderkey % 5, ':1.', o_orderkey % 10)").alias("image"),
        F.expr("case o_orderstatus when 'F' then 'exited' when 'O' then 'running' else 'Running' end").alias("state"),
        F.expr("map('tier', concat('t', o_orderkey % 3))").alias("labels"),
        F.expr("array_repeat('/mnt', cast(o_orderkey % 4 as int))").alias("mounts"),
        F.expr(f"{EPOCH_US // 1_000_000} + (o_orderkey % 30) * 86400").alias("created"),
    )


def inspect_snapshots(orders: DataFrame) -> DataFrame:
    """Inspect captures of some of the list captures, at the same time."""
    return orders.filter("o_totalprice >= 200000").select(
        F.lit("host0").alias("host_id"),
        from_micros(F.expr(SNAPSHOT_US)).alias("ts"),
        container_id("o_custkey").alias("id"),
        F.expr("case when o_orderkey % 2 = 0 then 'healthy' else 'unhealthy' end").alias("health_status"),
    )


def podman_list(customer: DataFrame) -> DataFrame:
    ports = (
        "case when c_custkey % 4 = 0 then array() else array("
        "named_struct('private_port', cast(80 as int), 'public_port', cast(8000 + c_custkey % 1000 as int), "
        "'type', 'tcp'), "
        "named_struct('private_port', cast(443 as int), 'public_port', 0, 'type', 'udp')) end"
    )
    return (
        docker_list(customer)
        .withColumn("c_custkey", F.expr("cast(conv(substring(id, 1, 12), 16, 10) as bigint)"))
        .withColumn("ports", F.expr(ports))
        .drop("created", "c_custkey")
    )


def podman_stats(ev: DataFrame) -> DataFrame:
    stats = docker_stats(ev)
    return stats.select(
        "event_id",
        "us",
        "host_id",
        "ts",
        "id",
        F.expr(
            "named_struct('total', cpu.total, 'kernel', cpu.percpu[0], 'user', cpu.percpu[1], "
            "'system', cpu.system, 'online', cpu.online)"
        ).alias("cpu"),
        F.expr("named_struct('usage', memory.usage, 'limit', memory.limit)").alias("memory"),
        F.expr(
            "transform_values(networks, (k, v) -> "
            "named_struct('rx_bytes', v.rx_bytes, 'tx_bytes', v.tx_bytes))"
        ).alias("networks"),
    )


def podman_inspect(customer: DataFrame) -> DataFrame:
    started = (
        f"date_format(convert_timezone(current_timezone(), 'UTC', cast(timestamp_seconds("
        f"{EPOCH_US // 1_000_000} + (c_custkey % 30) * 86400) as timestamp_ntz)), "
        "\"yyyy-MM-dd'T'HH:mm:ss'.250Z'\")"
    )
    return customer.filter(F.col("c_acctbal") >= 0).select(
        F.lit("host0").alias("host_id"), container_id("c_custkey").alias("id"),
        F.expr(started).alias("started_at"),
    )


def app_metrics(ev: DataFrame) -> DataFrame:
    """Metric rows: users divisible by three are hosts, all others containers."""
    dims = (
        "case when user_id % 3 = 0 then map('host', concat('h', user_id)) "
        "else map('container_id', concat('c', user_id), 'name', concat('web', user_id % 10), "
        "'image', concat('img', event_id % 4), 'empty', '') end"
    )
    return ev.select(
        F.expr("concat('h', user_id % 10)").alias("host_id"),
        F.lit("App").alias("namespace"),
        F.col("event_type").alias("sub_namespace"),
        F.expr("case when event_id % 5 = 0 then 'running' else 'value' end").alias("name"),
        "ts",
        F.expr("case when event_id % 10 = 0 then 1.0D else value end").alias("value"),
        F.lit("gauge").alias("type"),
        F.lit("count").alias("unit"),
        F.expr(dims).alias("dimensions"),
        F.expr(
            "case when event_id % 4 = 0 then named_struct('minimum', value, 'maximum', value * 2, "
            "'sum', value * 3, 'sample_count', cast(event_id % 3 as int)) end"
        ).alias("stats"),
        F.lit(60).alias("storage_resolution"),
        "event_id",
        "us",
    )


def syslog_lines(ev: DataFrame) -> DataFrame:
    """One auth log line per event, reading as of the end of the year."""
    program = (
        "element_at(array('sshd', 'CRON', 'sudo', 'su', 'login'), cast(event_id % 5 + 1 as int))"
    )
    message = (
        "case event_type when 'view' then concat('session opened for user u', user_id) "
        "when 'signup' then concat('Accepted publickey for u', user_id) "
        "when 'error' then concat('error: Access DENIED for u', user_id) "
        "when 'click' then concat('Failed password for invalid user u', user_id) "
        "else concat('Error: failed login of u', user_id) end"
    )
    line = (
        "concat(date_format(wall, 'MMM d HH:mm:ss'), ' host', user_id % 10, ' ', "
        f"{program}, '[', event_id, ']: ', {message})"
    )
    wall = F.expr(f"timestampadd(MICROSECOND, us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return ev.withColumn("wall", wall).select(
        "event_id",
        "us",
        F.expr("concat('host', user_id % 10)").alias("host_id"),
        F.expr(line).alias("value"),
        F.lit("/var/log/auth.log").alias("path"),
        from_micros(F.lit(REF_US)).alias("ref_ts"),
    )


def journal_records(ev: DataFrame) -> DataFrame:
    text = lambda e, a: F.expr(e).cast("string").alias(a)
    none = F.lit(None).cast("string")
    return dealt(ev, "user_id").select(
        "event_id",
        F.expr("concat('host', user_id % 10)").alias("host_id"),
        F.col("us").alias("realtime_us"),
        text("concat(event_type, ' by ', user_id)", "MESSAGE"),
        text("event_id % 8", "PRIORITY"),
        text(
            "element_at(array('sshd', 'kernel', 'Docker', 'app', 'NetworkManager', ''), "
            "cast(event_id % 6 + 1 as int))",
            "SYSLOG_IDENTIFIER",
        ),
        text(
            "case when event_id % 7 < 3 then 'nginx.service' when event_id % 7 < 5 then 'other.unit' end",
            "_SYSTEMD_UNIT",
        ),
        text("case when event_id % 7 < 3 then 'system.slice' end", "_SYSTEMD_SLICE"),
        text("concat('/usr/bin/p', event_id % 9)", "_EXE"),
        text("concat('p', event_id % 9, ' --run')", "_CMDLINE"),
        text("case when event_id % 11 = 0 then 'x1' else cast(event_id as string) end", "_PID"),
        text("user_id", "_UID"),
        none.alias("UID"),
        text("case when event_id % 2 = 0 then concat('m', event_id) else '' end", "MESSAGE_ID"),
        none.alias("_COMM"),
        text("case when event_id % 3 = 0 then concat('c', user_id) end", "CONTAINER_ID"),
        none.alias("CONTAINER_NAME"),
        none.alias("_PRIORITY"),
        text("concat('host', user_id % 10)", "_HOSTNAME"),
        text("case when event_id % 13 = 0 then 'named' end", "USERNAME"),
        text("case when event_id % 17 = 0 then 'sudoer' end", "SUDO_USER"),
        none.alias("SSH_USER"),
    )


def journal_lines(ev: DataFrame) -> DataFrame:
    """The same records as lines of a journal export, with fields in all the forms they take:
    text, bytes, a list whose last value counts, and null."""
    records = journal_records(ev)
    quoted = lambda c: F.expr(f"substring(to_json(array(`{c}`)), 2, length(to_json(array(`{c}`))) - 2)")
    spelled = F.expr(
        "concat('[', array_join(transform(sequence(1, octet_length(MESSAGE)), "
        "i -> conv(hex(substring(cast(MESSAGE as binary), i, 1)), 16, 10)), ','), ']')"
    )
    forms = {
        "MESSAGE": F.when(F.expr("event_id % 5 = 0"), spelled).otherwise(quoted("MESSAGE")),
        "_EXE": F.when(F.expr("event_id % 3 = 0"), F.expr("to_json(array('/old', _EXE))")).otherwise(quoted("_EXE")),
    }
    fields = [c for c in records.columns if c not in ("event_id", "host_id", "realtime_us")]
    members = [
        F.concat(F.lit(f'"{c}":'), F.when(F.col(c).isNull(), "null").otherwise(forms.get(c, quoted(c)))) for c in fields
    ]
    time = F.concat(F.lit('"__REALTIME_TIMESTAMP":"'), F.col("realtime_us").cast("string"), F.lit('"'))
    return records.select(F.concat(F.lit("{"), F.concat_ws(",", time, *members), F.lit("}")).alias("value"))


def api_lines(rows: DataFrame, body: str, listed: bool = False) -> DataFrame:
    """Capture lines whose body is an SQL expression over ``rows``; listed ones as an array."""
    shown = F.expr(f"array({body})" if listed else body)
    ts = F.col("ts") if "ts" in rows.columns else F.lit(None).cast("timestamp")
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return rows.select(F.to_json(F.struct("host_id", ts.alias("ts"), shown.alias("body")), options).alias("value"))


_LISTED = "'Id', id, 'Names', names, 'Image', image, 'State', state, 'Labels', labels, 'Mounts', transform(mounts, m -> named_struct('Source', m))"
DOCKER_LIST_BODY = f"named_struct({_LISTED}, 'Created', created)"
PODMAN_LIST_BODY = (
    f"named_struct({_LISTED}, 'Ports', transform(ports, p -> "
    "named_struct('PrivatePort', p.private_port, 'PublicPort', p.public_port, 'Type', p.type)))"
)
DOCKER_STATS_BODY = (
    "named_struct('id', id, 'cpu_stats', named_struct('cpu_usage', named_struct('total_usage', cpu.total, "
    "'percpu_usage', cpu.percpu), 'system_cpu_usage', cpu.system, 'online_cpus', cpu.online, "
    "'throttling_data', cpu.throttling), 'memory_stats', named_struct('usage', memory.usage, 'limit', memory.limit, "
    "'max_usage', memory.max, 'stats', memory.stats), 'networks', networks, "
    "'blkio_stats', named_struct('io_service_bytes_recursive', blkio), 'pids_stats', named_struct('current', pids))"
)
PODMAN_STATS_BODY = (
    "named_struct('id', id, 'cpu_stats', named_struct('cpu_usage', named_struct('total_usage', cpu.total, "
    "'usage_in_kernelmode', cpu.kernel, 'usage_in_usermode', cpu.user), 'system_cpu_usage', cpu.system, "
    "'online_cpus', cpu.online), 'memory_stats', named_struct('usage_bytes', memory.usage, "
    "'limit_bytes', memory.limit), 'networks', networks)"
)
DOCKER_INSPECT_BODY = "named_struct('Id', id, 'State', named_struct('Health', named_struct('Status', health_status)))"
PODMAN_INSPECT_BODY = "named_struct('Id', id, 'State', named_struct('StartedAt', started_at))"


def journal_users(customer: DataFrame) -> DataFrame:
    """Accounts: every even customer key is a known uid, on the host of its key."""
    return customer.filter("c_custkey % 2 = 0").selectExpr(
        "concat('host', c_custkey % 10) as host_id", "cast(c_custkey as bigint) as uid", "c_name as username"
    )


CHANNELS = [
    "System",
    "security",
    "Microsoft-Windows-Firewall/Operational",
    "Microsoft-Windows-Diagnosis-PLA/Operational",
    "Application",
    "Microsoft-Windows-TaskScheduler/Operational",
    "ForwardedEvents",
]
PROVIDERS = ["Service Control Manager", "Microsoft-Windows-DNS-Client", "docker"]


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} % {len(values)} + 1 as int))"


def event_xml(ev: DataFrame) -> DataFrame:
    """One Windows event per row; every 97th is cut off in the middle."""
    wall = F.expr("timestampadd(MICROSECOND, us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    channel, provider = _pick(CHANNELS, "event_id"), _pick(PROVIDERS, "(event_id div 7)")
    xml = (
        "concat('<Event><System><Provider Name=\"', provider, '\" Guid=\"', "
        "case when event_id % 2 = 0 then '{g}' else '' end, '\"/><EventID>', event_id % 5000, "
        "'</EventID><Level>', event_id % 6, '</Level><TimeCreated SystemTime=\"', "
        "date_format(wall, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '7Z\"/><Channel>', channel, "
        "'</Channel><Computer>pc', user_id % 20, '</Computer><Security UserID=\"', "
        "case when event_id % 3 = 0 then concat('S-1-5-', user_id) else '' end, "
        "'\"/><Execution ProcessID=\"', event_id % 4 * 100, '\" ThreadID=\"1\"/></System>"
        "<EventData><Data Name=\"Kind\">', event_type, '</Data><Data Name=\"kind\">', "
        "upper(event_type), '</Data><Data>loose</Data><Data Name=\"Empty\"></Data></EventData>', "
        "case when event_id % 97 = 0 then '' else '</Event>' end)"
    )
    return (
        dealt(ev, "user_id").withColumn("wall", wall)
        .withColumn("channel", F.expr(channel))
        .withColumn("provider", F.expr(provider))
        .select(
            "event_id",
            F.expr("concat('win', user_id % 10)").alias("host_id"),
            F.expr(xml).alias("xml"),
            F.col("channel").alias("channel_name"),
            from_micros(F.lit(REF_US)).alias("ref_ts"),
        )
    )


def process_table(customer: DataFrame) -> DataFrame:
    """One snapshot of each nation's customers as processes."""
    return customer.select(
        F.expr("concat('h', c_nationkey)").alias("host_id"),
        from_micros(F.lit(EPOCH_US)).alias("snapshot_ts"),
        F.col("c_custkey").cast("int").alias("pid"),
        F.expr("case when c_custkey % 5 <> 0 then cast(c_custkey div 5 as int) end").alias("ppid"),
        F.expr("case when c_custkey % 4 <> 0 then concat('/bin/', lower(c_mktsegment)) end").alias(
            "executable"
        ),
        F.col("c_name").alias("cmdline"),
        F.expr("case when c_custkey % 6 <> 0 then concat('u', c_custkey % 50) end").alias("user"),
        F.expr("case when c_custkey % 11 <> 0 then c_acctbal end").alias("cpu_percent"),
        F.expr("cast((c_custkey * 7919) % 1000 as double)").alias("mem_percent"),
        F.expr("cast(c_custkey % 64 as int)").alias("threads"),
        F.expr(f"{EPOCH_US // 1000} + c_custkey * 1000").alias("start_ms"),
    )


def conversation_logs(conversations: DataFrame) -> DataFrame:
    """Log rows: the source is the role, the order is conversation and turn."""
    return conversations.select(
        F.expr("concat('host', conv_id % 4)").alias("host_id"),
        F.expr(f"timestamp_micros({EPOCH_US} + conv_id * 60000000 + turn * 1000000)").alias("ts"),
        F.expr("case role when 'user' then 'info' when 'system' then 'Warn' else 'error' end").alias(
            "level"
        ),
        F.col("text").alias("message"),
        F.expr("case role when 'system' then '' else role end").alias("source"),
        F.lit("chat").alias("category"),
        F.expr("cast(turn % 3 as int)").alias("pid"),
        F.expr("map('conv', cast(conv_id as string), 'blank', '')").alias("fields"),
        F.expr("map('role', role)").alias("labels"),
        F.expr(
            "named_struct('platform', 'chat', 'app_name', concat('app', conv_id % 3), "
            "'app_version', '', 'container_id', cast(null as string), "
            "'container_name', cast(null as string), 'unit', '', 'service', '', 'event_id', '', "
            "'user', role, 'executable', '', 'path', '', 'extra', map('turn', cast(turn as string)))"
        ).alias("meta"),
        "conv_id",
        "turn",
    )


def host_meta(nation: DataFrame) -> DataFrame:
    """Metadata of the hosts ``h0`` to ``h24``."""
    fields = {
        "host_id": F.expr("concat('h', n_nationkey)"),
        "hostname": F.expr("lower(n_name)"),
        "agent_id": F.expr("concat('agent', n_nationkey)"),
        "agent_version": F.lit("1.0"),
        "os": F.expr("case when n_nationkey % 2 = 0 then 'linux' else 'windows' end"),
        "ip_address": F.expr("concat('10.0.0.', n_nationkey)"),
        "region": F.expr("concat('region', n_regionkey)"),
        "environment": F.expr("case when n_nationkey % 4 = 0 then '' else 'prod' end"),
    }
    tags = F.expr("map('team', concat('t', n_regionkey), 'void', '')")
    return nation.select(meta_struct(fields, tags).alias("m")).select("m.*")


# --- host captures ------------------------------------------------------------


def host_cpu(part: DataFrame) -> DataFrame:
    times = ", ".join(
        f"'{k}', cast(p_partkey + {i} as double)"
        for i, k in enumerate(
            "user system idle nice iowait irq softirq steal guest guest_nice".split()
        )
    )
    return dealt(part, "p_partkey").select(
        F.col("p_brand").alias("host_id"),
        F.expr(f"timestamp_micros({EPOCH_US} + p_partkey * 1000000)").alias("ts"),
        F.expr("array(cast(p_size as double), p_retailprice / 100)").alias("percent_per_core"),
        F.expr("p_retailprice / 200").alias("percent_total"),
        F.expr(f"named_struct({times})").alias("times"),
        F.expr(
            "array(named_struct('mhz', p_retailprice, 'vendor', p_type, 'model', p_name, 'stepping', p_size, "
            "'cache', p_size * 512, 'family', '6', 'physical_id', "
            "case when p_partkey % 2 = 0 then '0' else '' end))"
        ).alias("info"),
        F.col("p_size").alias("count_logical"),
        F.expr("case when p_partkey % 10 <> 0 then p_size end").alias("count_physical"),
        F.expr("p_size / 10.0D").alias("load1"),
        F.expr("p_size / 20.0D").alias("load5"),
        F.expr("p_size / 40.0D").alias("load15"),
    )


def host_mem(orders: DataFrame) -> DataFrame:
    u = lambda e: f"cast({e} as decimal(20,0))"
    total, swap = "(o_orderkey * 1000 + 4096)", "(case when o_orderkey % 4 = 0 then 0 else o_orderkey * 10 + 100 end)"
    return dealt(orders, "o_custkey").select(
        F.expr("concat('h', o_custkey)").alias("host_id"),
        from_micros(wall_clock_us(F.col("o_orderdate"))).alias("ts"),
        F.expr(u(total)).alias("total"),
        F.expr(u(f"{total} div 3")).alias("available"),
        F.expr(u(f"{total} - {total} div 3")).alias("used"),
        F.expr("cast(o_orderkey % 100 as double)").alias("used_percent"),
        F.expr(
            f"named_struct('total', {u(swap)}, 'used', {u(f'{swap} - {swap} div 4')}, "
            f"'free', {u(f'{swap} div 4')}, "
            "'used_percent', case when o_orderkey % 3 = 0 then 0.0D else 12.5D end)"
        ).alias("swap"),
        "o_orderkey",
    )


DISK_IO = (
    "read_count write_count read_bytes write_bytes read_time write_time io_time "
    "merged_read_count merged_write_count weighted_io"
).split()


def host_disk(part: DataFrame) -> DataFrame:
    u = lambda e: f"cast({e} as decimal(20,0))"
    usage = (
        f"named_struct('total', {u('p_partkey * 100')}, 'used', {u('p_partkey * 40')}, "
        f"'free', {u('p_partkey * 60')}, 'inodes_total', {u('p_partkey * 10')}, "
        f"'inodes_used', {u('p_partkey')}, 'inodes_free', {u('p_partkey * 9')}, "
        "'used_percent', 40.0D, 'inodes_used_percent', cast(p_size as double))"
    )
    none = "cast(null as struct<total: decimal(20,0), used: decimal(20,0), free: decimal(20,0), inodes_total: decimal(20,0), inodes_used: decimal(20,0), inodes_free: decimal(20,0), used_percent: double, inodes_used_percent: double>)"
    io = ", ".join(f"'{n}', {u(f'p_partkey * {i + 1}')}" for i, n in enumerate(DISK_IO))
    return dealt(part, "p_partkey").select(
        F.col("p_brand").alias("host_id"),
        F.expr(f"timestamp_micros({EPOCH_US} + p_partkey * 1000000)").alias("ts"),
        F.expr("case when p_partkey % 5 = 0 then 'windows' else 'linux' end").alias("os"),
        F.expr(
            f"array(named_struct('mountpoint', concat('/data', p_size), 'device', '/dev/sda1', 'fstype', 'ext4', "
            f"'usage', case when p_partkey % 7 = 0 then {none} else {usage} end), "
            f"named_struct('mountpoint', case p_size % 3 when 0 then '/run/x' when 1 then '/proc/y' else '/' end, "
            f"'device', 'dev', 'fstype', case when p_size % 2 = 0 then 'tmpfs' else 'xfs' end, 'usage', {usage}), "
            f"named_struct('mountpoint', 'C:', 'device', concat(repeat(chr(92), 2), '.', chr(92), 'PHYS', p_size), "
            f"'fstype', case when p_size % 2 = 0 then '' else 'ntfs' end, 'usage', {usage}))"
        ).alias("partitions"),
        F.expr(
            f"map('sda', named_struct('serial_number', concat('S', p_partkey), {io}))"
        ).alias("io"),
        "p_partkey",
    )


def host_info(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.expr("concat('h', s_suppkey)").alias("host_id"),
        F.expr(f"timestamp_micros({EPOCH_US} + s_suppkey * 1000000)").alias("ts"),
        F.expr("cast(s_suppkey * 3600 as decimal(20,0))").alias("uptime"),
        F.expr("cast(s_suppkey % 300 as decimal(20,0))").alias("procs"),
        F.expr("case when s_suppkey % 4 <> 0 then array_repeat('u', cast(s_suppkey % 4 as int)) end").alias(
            "users"
        ),
        F.col("s_name").alias("hostname"),
        F.lit("linux").alias("os"),
        F.expr("concat('p', s_nationkey)").alias("platform"),
        F.lit("rhel").alias("platform_family"),
        F.lit("9").alias("platform_version"),
        F.lit("6.1").alias("kernel_version"),
        F.lit("x86_64").alias("kernel_arch"),
        F.lit("kvm").alias("virtualization_system"),
        F.lit("guest").alias("virtualization_role"),
    )


def host_net(orders: DataFrame) -> DataFrame:
    u = lambda e: f"cast({e} as decimal(20,0))"
    nic = lambda name, k: (
        f"named_struct('name', {name}, 'bytes_sent', {u(f'o_orderkey * {k}')}, "
        f"'bytes_recv', {u(f'o_orderkey * {k + 1}')}, 'packets_sent', {u(f'o_orderkey + {k}')}, "
        f"'packets_recv', {u(f'o_custkey + {k}')}, 'errin', {u(f'o_custkey % {k + 1}')}, "
        f"'errout', {u(f'o_orderkey % {k + 1}')})"
    )
    eth = nic("'eth0'", 7)
    wan = nic("concat('wan', o_custkey % 3)", 13)
    return dealt(orders, "o_custkey").select(
        F.expr("concat('h', o_custkey)").alias("host_id"),
        from_micros(wall_clock_us(F.col("o_orderdate"))).alias("ts"),
        F.expr(f"array({eth}, {wan})").alias("interfaces"),
        "o_orderkey",
    )
