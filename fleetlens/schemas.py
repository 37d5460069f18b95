"""Record shapes: the canonical tables and the raw captures they come from.

Unsigned 64-bit counters are ``decimal(20,0)`` because ``bigint`` cannot hold
2^64-1; they become ``double`` only when a metric row is made.
"""

from __future__ import annotations

from fleetlens.functions.resource import META_FIELDS


def ddl(spec: str) -> str:
    """Schema text for a reader; ``u64`` stands for an unsigned counter."""
    return spec.replace("u64", "decimal(20,0)")


STATS = "struct<minimum: double, maximum: double, sum: double, sample_count: int>"

# One metric sample, the unit of every metric table.
METRIC_COLUMNS = (
    "host_id namespace sub_namespace name ts value type unit dimensions stats storage_resolution"
).split()
METRIC = ddl(
    "host_id string, namespace string, sub_namespace string, name string, ts timestamp, "
    "value double, type string, unit string, dimensions map<string,string>, "
    f"stats {STATS}, storage_resolution int"
)

# The fields of a log record's metadata.
LOG_META_FIELDS = (
    "platform app_name app_version container_id container_name unit service "
    "event_id user executable path"
).split()
LOG_META = "struct<" + ", ".join(f"{f}: string" for f in LOG_META_FIELDS) + ", extra: map<string,string>>"

# One log record.
LOG_COLUMNS = "host_id ts level message source category pid fields labels meta".split()
LOG_ENTRY = ddl(
    "host_id string, ts timestamp, level string, message string, source string, "
    "category string, pid int, fields map<string,string>, labels map<string,string>, "
    f"meta {LOG_META}"
)

# Identity and environment of an endpoint: a small dimension table.
META = ddl(", ".join(f"{f} string" for f in META_FIELDS) + ", tags map<string,string>")

# One process of one snapshot.
PROCESS = ddl(
    "host_id string, snapshot_ts timestamp, pid int, ppid int, executable string, "
    "cmdline string, user string, cpu_percent double, mem_percent double, threads int, "
    "start_time timestamp, labels map<string,string>"
)

# --- raw captures -------------------------------------------------------------

RAW_HOST_CPU = ddl(
    "host_id string, ts timestamp, percent_per_core array<double>, percent_total double, "
    "times struct<user: double, system: double, idle: double, nice: double, iowait: double, "
    "irq: double, softirq: double, steal: double, guest: double, guest_nice: double>, "
    "info array<struct<mhz: double, vendor: string, model: string, stepping: int, "
    "cache: int, family: string, physical_id: string>>, "
    "count_logical int, count_physical int, load1 double, load5 double, load15 double"
)

RAW_HOST_MEM = ddl(
    "host_id string, ts timestamp, total u64, available u64, used u64, used_percent double, "
    "swap struct<total: u64, used: u64, free: u64, used_percent: double>"
)

RAW_HOST_DISK = ddl(
    "host_id string, ts timestamp, os string, "
    "partitions array<struct<mountpoint: string, device: string, fstype: string, "
    "usage: struct<total: u64, used: u64, free: u64, inodes_total: u64, inodes_used: u64, "
    "inodes_free: u64, used_percent: double, inodes_used_percent: double>>>, "
    "io map<string, struct<serial_number: string, read_count: u64, write_count: u64, "
    "read_bytes: u64, write_bytes: u64, read_time: u64, write_time: u64, io_time: u64, "
    "merged_read_count: u64, merged_write_count: u64, weighted_io: u64>>"
)

# What a host reports about itself.
HOST_INFO_FIELDS = (
    "hostname os platform platform_family platform_version kernel_version kernel_arch "
    "virtualization_system virtualization_role"
).split()
RAW_HOST_INFO = ddl(
    "host_id string, ts timestamp, uptime u64, procs u64, users array<string>, "
    + ", ".join(f"{f} string" for f in HOST_INFO_FIELDS)
)

RAW_HOST_NET = ddl(
    "host_id string, ts timestamp, interfaces array<struct<name: string, bytes_sent: u64, "
    "bytes_recv: u64, packets_sent: u64, packets_recv: u64, errin: u64, errout: u64>>"
)

# List and inspect rows hold from their ``ts`` on; without one, from the beginning.
RAW_DOCKER_LIST = ddl(
    "host_id string, ts timestamp, id string, names array<string>, image string, state string, "
    "labels map<string,string>, mounts array<string>, created bigint"
)
RAW_DOCKER_STATS = ddl(
    "host_id string, ts timestamp, id string, "
    "cpu struct<total: u64, system: u64, online: int, percpu: array<u64>, "
    "throttling: struct<periods: u64, throttled_periods: u64, throttled_time: u64>>, "
    "memory struct<usage: u64, limit: u64, max: u64, stats: map<string,u64>>, "
    "networks map<string, struct<rx_bytes: u64, tx_bytes: u64, rx_packets: u64, "
    "tx_packets: u64, rx_errors: u64, tx_errors: u64, rx_dropped: u64, tx_dropped: u64>>, "
    "blkio array<struct<major: int, minor: int, op: string, value: u64>>, pids u64"
)
RAW_DOCKER_INSPECT = ddl("host_id string, ts timestamp, id string, health_status string")

RAW_PODMAN_LIST = ddl(
    "host_id string, ts timestamp, id string, names array<string>, image string, state string, "
    "labels map<string,string>, mounts array<string>, "
    "ports array<struct<private_port: int, public_port: int, type: string>>"
)
RAW_PODMAN_STATS = ddl(
    "host_id string, ts timestamp, id string, "
    "cpu struct<total: u64, kernel: u64, user: u64, system: u64, online: int>, "
    "memory struct<usage: u64, limit: u64>, "
    "networks map<string, struct<rx_bytes: u64, tx_bytes: u64>>"
)
RAW_PODMAN_INSPECT = ddl("host_id string, ts timestamp, id string, started_at string")

# Journal fields are declared as columns, not as an open map, so that a columnar or
# JSON capture is pruned to them and the priority filter can reach the scan.
# Names of journal fields.
JOURNAL_FIELDS = (
    "MESSAGE PRIORITY SYSLOG_IDENTIFIER _SYSTEMD_UNIT _SYSTEMD_SLICE _EXE _CMDLINE _PID _UID UID "
    "MESSAGE_ID _COMM CONTAINER_ID CONTAINER_NAME _PRIORITY _HOSTNAME USERNAME SUDO_USER SSH_USER"
).split()
RAW_JOURNAL = ddl(
    "host_id string, realtime_us bigint, " + ", ".join(f"`{f}` string" for f in JOURNAL_FIELDS)
)

RAW_SYSLOG = ddl("host_id string, value string, path string, ref_ts timestamp")
RAW_EVENT_XML = ddl("host_id string, xml string, channel_name string, ref_ts timestamp")
RAW_PROCESS = ddl(
    "host_id string, snapshot_ts timestamp, pid int, ppid int, executable string, "
    "cmdline string, user string, cpu_percent double, mem_percent double, threads int, "
    "start_ms bigint"
)
USERS = ddl("host_id string, uid bigint, username string")
