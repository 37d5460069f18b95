"""Output that counts only once it is committed.

A job writes its files below ``data``, in a folder of its own name and attempt, and then
adds one line to ``manifest``. Readers take the attempts that the manifest names, the least
one of each job: a job that died before its line left nothing behind, and one that ran
twice counts once. What must be committed together is written under several names first,
and the line comes last. The manifest is joined, never listed on the driver.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON text keeps milliseconds only unless it is told otherwise.
MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_PLACE = "__job string, __attempt string"


class Committed:
    """A folder of committed output."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def attempts(self) -> DataFrame:
        """(job, attempt) of every committed job."""
        try:
            lines = self.spark.read.schema(_PLACE).json(f"{self.path}/manifest")
        except AnalysisException:  # nothing has been committed yet
            return self.spark.createDataFrame([], _PLACE)
        return lines.groupBy("__job").agg(F.min("__attempt").alias("__attempt"))

    def has(self, job_id: str) -> bool:
        return bool(self.attempts().filter(F.col("__job") == job_id).take(1))

    def stage(self, rows: DataFrame, name: str, job_id: str, attempt: str, fmt: str = "json", **options) -> None:
        """Write rows that do not count yet."""
        placed = rows.withColumns({"__job": F.lit(job_id), "__attempt": F.lit(attempt)})
        writer = placed.write.mode("append").format(fmt).options(**MICROS, **options)
        writer.partitionBy("__job", "__attempt").save(f"{self.path}/{name}")

    def commit(self, job_id: str, attempt: str) -> None:
        line = self.spark.range(1).select(F.lit(job_id).alias("__job"), F.lit(attempt).alias("__attempt"))
        line.write.mode("append").json(f"{self.path}/manifest")

    def read(self, name: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
        """The committed rows of one name."""
        fields = [*schema.fields, T.StructField("__job", T.StringType()), T.StructField("__attempt", T.StringType())]
        try:
            rows = self.spark.read.schema(T.StructType(fields)).format(fmt).options(**MICROS).load(f"{self.path}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)
        return rows.join(self.attempts(), ["__job", "__attempt"], "left_semi").select(*schema.names)

    def append(self, rows: DataFrame, name: str = "data", job_id: str | None = None, **options) -> bool:
        """Stage and commit rows; False if the job had been committed before."""
        job_id = job_id or uuid.uuid4().hex
        if self.has(job_id):
            return False
        attempt = uuid.uuid4().hex
        self.stage(rows, name, job_id, attempt, **options)
        self.commit(job_id, attempt)
        return True


def resume(
    rows: DataFrame,
    path: str,
    job_id: str,
    keys: list[str],
    ts: str,
    tie: str,
    fmt: str = "parquet",
) -> bool:
    """Append what no earlier job has taken; a batch job that goes on where the last one ended.

    The cursor is the highest (``ts``, ``tie``) of every series of ``keys``. It is committed by
    the same line as the rows, so a job that is killed in between repeats nothing and loses
    nothing. Rows at or before the cursor of their series count as taken. ``tie`` is a number
    that, together with the time, is unique within a series.
    """
    store = Committed(rows.sparkSession, path)
    if store.has(job_id):
        return False
    kinds = {c: rows.schema[c].dataType for c in (*keys, ts, tie)}
    shape = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
    ends = store.read("cursor", shape, fmt).groupBy(*keys).agg(F.max(F.struct(ts, tie)).alias("__end"))
    ends = ends.select(*[F.col(k).alias(f"__{k}") for k in keys], "__end")
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = equal if same is None else same & equal
    fresh = rows.join(ends, same, "left").filter(
        F.col("__end").isNull() | (F.struct(F.col(ts), F.col(tie)) > F.col("__end"))
    )
    attempt = uuid.uuid4().hex
    store.stage(fresh.select(*rows.columns), "data", job_id, attempt, fmt)
    # The cursor is that of the rows as they were written, not of a second reading of the input.
    own = T.StructType([*rows.schema.fields, T.StructField("__job", T.StringType()), T.StructField("__attempt", T.StringType())])
    try:
        taken = rows.sparkSession.read.schema(own).format(fmt).options(**MICROS).load(f"{store.path}/data")
    except AnalysisException:  # no job has written a row so far
        taken = rows.sparkSession.createDataFrame([], own)
    taken = taken.filter((F.col("__job") == job_id) & (F.col("__attempt") == attempt))
    highest = taken.groupBy(*keys).agg(F.max(F.struct(ts, tie)).alias("end"))
    store.stage(highest.select(*keys, f"end.{ts}", f"end.{tie}"), "cursor", job_id, attempt, fmt)
    store.commit(job_id, attempt)
    return True
