"""Journal exports to log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.levels import journal_category, journal_level
from fleetlens.functions.maps import drop_empty, literal_map
from fleetlens.functions.text import parse_int, sanitize_utf8, truncate_bytes
from fleetlens.functions.timestamps import from_micros
from fleetlens.operators.lookups import resolve_user
from fleetlens.sources.logrows import log_meta, log_rows

# Journal fields that are kept, and priorities that are read.
KEPT_FIELDS = (
    "_SYSTEMD_UNIT _SYSTEMD_SLICE _EXE _CMDLINE _PID _UID MESSAGE_ID "
    "SYSLOG_IDENTIFIER _COMM CONTAINER_ID CONTAINER_NAME"
).split()
READ_PRIORITIES = ["0", "1", "2", "3", "4"]


def read_filter(raw: DataFrame) -> DataFrame:
    """Priorities 0 to 4, without the kernel's own lines."""
    kernel = F.col("SYSLOG_IDENTIFIER").eqNullSafe("kernel")
    return raw.filter(F.col("PRIORITY").isin(READ_PRIORITIES) & ~kernel)


def journal_logs(
    raw: DataFrame,
    users: DataFrame | None = None,
    max_bytes: int = 10000,
    product: str = "fleetlens",
) -> DataFrame:
    """Log rows of a journal export. Narrow, but for the account lookup by uid."""
    records = read_filter(raw)
    named = [F.col("USERNAME"), F.col("SUDO_USER"), F.col("SSH_USER")]
    uid = F.coalesce(F.when(F.col("UID") != "", F.col("UID")), F.col("_UID"))
    if users is not None:
        records = resolve_user(records, named, uid, users, "__user")
    else:
        records = records.withColumn(
            "__user", F.coalesce(*[F.when(n != "", n) for n in named], F.lit(""))
        )
    raw_fields = drop_empty(literal_map({f: F.col(f) for f in KEPT_FIELDS}))
    fields = drop_empty(
        literal_map(
            {f.removeprefix("_"): F.col(f) for f in KEPT_FIELDS}
            | {"PRIORITY": F.col("_PRIORITY"), "HOSTNAME": F.col("_HOSTNAME")}
        )
    )
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    records = records.withColumns(
        {
            "__clean": sanitize_utf8(blank("MESSAGE")),
            "__lower_id": F.lower("SYSLOG_IDENTIFIER"),
            "__lower_unit": F.lower("_SYSTEMD_UNIT"),
        }
    )
    return log_rows(
        records,
        ts=from_micros(F.col("realtime_us")),
        level=journal_level(blank("PRIORITY")),
        message=truncate_bytes(F.col("__clean"), max_bytes),
        source=F.lit("systemd"),
        category=journal_category(F.col("__lower_id"), F.col("__lower_unit"), product, lowered=True),
        pid=parse_int(F.col("_PID")),
        fields=fields,
        labels=drop_empty(
            literal_map(
                {"container_id": F.col("CONTAINER_ID"), "container_name": F.col("CONTAINER_NAME")}
            )
        ),
        meta=log_meta(
            platform=F.lit("journald"),
            app_name=blank("SYSLOG_IDENTIFIER"),
            container_id=blank("CONTAINER_ID"),
            container_name=blank("CONTAINER_NAME"),
            unit=blank("_SYSTEMD_UNIT"),
            user=F.col("__user"),
            executable=blank("_EXE"),
            extra=raw_fields,
        ),
    )
