"""Auth log text to log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.levels import detect_severity
from fleetlens.functions.maps import empty_map, literal_map
from fleetlens.functions.text import truncate_bytes
from fleetlens.functions.timestamps import parse_syslog_clock, resolve_syslog_year
from fleetlens.sources.logrows import log_meta, log_rows

# Auth log files, the first one present is read.
AUTH_LOG_PATHS = ["/var/log/secure", "/var/log/auth.log"]

_HAS_MESSAGE = r"(?U)^\s*(?:\S+\s+){4}\S+\s."
_LINE = r"(?U)^\s*(?:\S+\s+){4}\S+\s?(.*)$"


def choose_path(present: list[str]) -> str | None:
    """The auth log to read of those a host has."""
    return next((p for p in AUTH_LOG_PATHS if p in present), None)


def auth_logs(
    raw: DataFrame, zone: str = "UTC", max_bytes: int = 10000, compat: bool = False
) -> DataFrame:
    """Log rows of syslog-style lines; short lines and empty messages are dropped.

    ``compat`` finds the message by the length of the prefix written with single
    blanks, so a padded day leaves a blank in front, and treats a limit of 0 as 0.
    """
    word = lambda i: F.get(F.col("__words"), F.lit(i))
    words = F.split(F.regexp_replace("value", r"(?U)^\s+|\s+$", ""), r"(?U)\s+")
    if compat:
        lines = raw.withColumn("__words", words).filter(F.size("__words") >= 5)
        prefix = F.octet_length(F.concat_ws(" ", *[word(i) for i in range(5)])) + 1
        tail = F.substr(F.col("value").cast("binary"), prefix + 1).cast("string")
        rest = F.array_join(F.slice("__words", F.lit(6), F.size("__words")), " ")
        message = F.when(prefix < F.octet_length("value"), tail).otherwise(rest)
        lines = lines.withColumn("__message", message).filter(F.col("__message") != "")
    else:
        # One test on the raw line for "five words and a message"; a filter on the parsed
        # columns would make Spark parse every line once more below the projection.
        lines = raw.filter(F.col("value").rlike(_HAS_MESSAGE)).withColumns(
            {"__words": words, "__message": F.regexp_extract("value", _LINE, 1)}
        )
    parsed = lines.withColumns(
        {
            "__lower": F.lower("__message"),
            "__program": F.regexp_replace(F.substring_index(word(4), "[", 1), ":+$", ""),
            "__clock": parse_syslog_clock(word(0), word(1), word(2)),
        }
    )
    return log_rows(
        parsed,
        ts=resolve_syslog_year(F.col("__clock"), F.col("ref_ts"), zone),
        level=detect_severity(F.col("__lower"), lowered=True),
        message=truncate_bytes(F.col("__message"), max_bytes, zero_is_unlimited=not compat),
        source=F.col("__program"),
        category=F.lit("auth"),
        pid=F.lit(0),
        fields=empty_map(),
        labels=literal_map({"log_path": F.col("path"), "hostname_log": word(3)}),
        meta=log_meta(platform=F.lit("file"), app_name=F.col("__program"), path=F.col("path")),
    )
