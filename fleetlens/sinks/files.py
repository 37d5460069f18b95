"""File sinks for payloads and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.schemas import LOG_META_FIELDS
from fleetlens.sinks.committed import Committed

def append_ndjson(payloads: DataFrame, path: str, rows_per_file: int = 500_000, job_id: str | None = None) -> bool:
    """Append one JSON object per line; the folder is created when missing.

    A job that is run again with its ``job_id`` adds nothing and gives False.
    """
    return Committed(payloads.sparkSession, path).append(payloads, job_id=job_id, maxRecordsPerFile=rows_per_file)


def read_ndjson(spark: SparkSession, path: str, schema) -> DataFrame:
    """Payloads that :func:`append_ndjson` has committed."""
    return Committed(spark, path).read("data", schema)


def write_export(nested: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Write OTLP-shaped or process payloads as files."""
    nested.write.mode(mode).format(fmt).save(path)


def legacy_payload(payloads: DataFrame) -> DataFrame:
    """Payload rows with re-typed counts; null metadata stays null."""
    metric = lambda m: F.struct(
        *[
            m[f].alias(f)
            for f in ("namespace", "sub_namespace", "name", "ts", "value", "unit", "dimensions", "type")
        ],
        m["storage_resolution"].cast("int").alias("storage_resolution"),
        m["stats"].alias("stats"),
    )
    return payloads.withColumn("metrics", F.transform("metrics", metric))


def log_meta_or_empty(meta):
    """Log metadata with a null record replaced by one of nulls."""
    empty = F.struct(
        *[F.lit(None).cast("string").alias(f) for f in LOG_META_FIELDS],
        F.lit(None).cast("map<string,string>").alias("extra"),
    )
    return F.coalesce(meta, empty)
