"""Queries over process snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.topn import top_by, top_processes
from fleetlens.plans import adapters as A
from fleetlens.plans import sqltext as S
from fleetlens.plans.catalog import query
from fleetlens.plans.jobs import process_export
from fleetlens.sources.processes import process_payloads, process_rows

_PROCS = """procs AS (
  SELECT 'h' || c_nationkey AS host_id, CAST(c_custkey AS INTEGER) AS pid,
    CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey // 5 AS INTEGER) ELSE 0 END AS ppid,
    CASE WHEN c_custkey % 4 <> 0 THEN '/bin/' || lower(c_mktsegment) ELSE '' END AS executable,
    c_name AS cmdline,
    CASE WHEN c_custkey % 6 <> 0 THEN 'u' || (c_custkey % 50) ELSE '' END AS "user",
    CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal ELSE 0 END AS cpu_percent,
    CAST((c_custkey * 7919) % 1000 AS DOUBLE) AS mem_percent,
    CAST(c_custkey % 64 AS INTEGER) AS threads,
    1704067200000000 + c_custkey * 1000000 AS start_us
  FROM customer
)"""
_RANKED = (
    _PROCS
    + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY cpu_percent DESC, pid) AS by_cpu,
    row_number() OVER (PARTITION BY host_id ORDER BY mem_percent DESC, pid) AS by_mem
  FROM procs
)"""
)


def processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_rows(A.process_table(A.table(spark, sf_dir, "customer")))


@query("proc_snapshot", f"WITH {_PROCS} SELECT * FROM procs")
def proc_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = processes(spark, sf_dir)
    return rows.withColumn("start_us", F.unix_micros("start_time")).drop(
        "snapshot_ts", "start_time", "labels"
    )


@query(
    "top_cpu",
    f"WITH {_RANKED} SELECT host_id, pid, cpu_percent, by_cpu AS rank FROM ranked WHERE by_cpu <= 20",
)
def top_cpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_by(processes(spark, sf_dir), "cpu_percent").select(
        "host_id", "pid", "cpu_percent", F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "top_mem",
    f"WITH {_RANKED} SELECT host_id, pid, mem_percent, by_mem AS rank FROM ranked WHERE by_mem <= 20",
)
def top_mem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_by(processes(spark, sf_dir), "mem_percent").select(
        "host_id", "pid", "mem_percent", F.col("rank").cast("bigint").alias("rank")
    )


_TOP_COLUMNS = "host_id, pid, cmdline, cpu_percent, mem_percent, threads"


@query("top_processes", f"WITH {_RANKED} SELECT {_TOP_COLUMNS} FROM ranked WHERE by_cpu <= 20 OR by_mem <= 20")
def top_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_processes(processes(spark, sf_dir)).select(*_TOP_COLUMNS.split(", "))


@query("top_processes_compat", f"WITH {_RANKED} SELECT {_TOP_COLUMNS} FROM ranked WHERE by_cpu <= 40")
def top_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_processes(processes(spark, sf_dir), compat=True).select(*_TOP_COLUMNS.split(", "))


PAYLOAD_SQL = f"""WITH {_RANKED}
SELECT host_id, count(*) AS n, string_agg(CAST(pid AS VARCHAR), ',' ORDER BY cpu_percent DESC, pid) AS pids
FROM ranked WHERE by_cpu <= 20 OR by_mem <= 20 GROUP BY host_id"""


def payload_text(payloads: DataFrame) -> DataFrame:
    return payloads.select(
        "host_id",
        F.size("processes").cast("bigint").alias("n"),
        F.array_join(F.transform("processes", lambda p: p["pid"].cast("string")), ",").alias("pids"),
    )


@query("proc_payload", PAYLOAD_SQL)
def proc_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_text(process_payloads(top_processes(processes(spark, sf_dir))))


@query(
    "proc_export",
    f"""WITH {_RANKED}, {S.META}
SELECT r.host_id, count(*) AS n, any_value(m.agent_id) AS agent_id, any_value(m.hostname) AS hostname,
  sha256('host|' || r.host_id || '|') AS endpoint_id, 'host' AS kind, any_value(m.os) AS os
FROM ranked r LEFT JOIN meta m USING (host_id) WHERE by_cpu <= 20 OR by_mem <= 20 GROUP BY r.host_id""",
)
def proc_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export job: payloads with the identity of their host."""
    meta = A.host_meta(A.table(spark, sf_dir, "nation"))
    return process_export(processes(spark, sf_dir), meta).select(
        "host_id",
        F.size("processes").cast("bigint").alias("n"),
        "agent_id",
        "hostname",
        "endpoint_id",
        "meta.kind",
        "meta.os",
    )
