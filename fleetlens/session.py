"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every fleetlens job relies on. Maps are built with "the last key wins", and a
# stage whose generated method is too long for the JIT runs as separate operators, which
# is several times faster for the wide parse projections. Partition counts and broadcast sizes are
# left to the cluster: AQE coalesces, splits skewed joins and turns a join into a
# broadcast only after it has measured the small side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "fleetlens", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session carrying :data:`SETTINGS` plus ``extra``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for files that executors write and read back.

    The cluster names its shared folder in ``spark.checkpoint.dir``; a folder on
    this machine is used only by a local master for which that is unset, as in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex}"
    if shared:
        return f"{shared.rstrip('/')}/fleetlens/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix='fleetlens-')}/{name}"
