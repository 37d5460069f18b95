"""Windows event XML to log rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.levels import event_category, event_level_from_number
from fleetlens.functions.maps import drop_null, last_wins, literal_map, merge_maps
from fleetlens.functions.text import null_if_empty, sanitize_utf8, truncate_bytes
from fleetlens.functions.timestamps import rfc3339
from fleetlens.sources.logrows import log_meta, log_rows

EVENT = (
    "System struct<Provider: struct<_Name: string, _Guid: string>, EventID: int, Version: int, "
    "Level: int, Task: int, Opcode: int, Keywords: string, "
    "TimeCreated: struct<_SystemTime: string>, EventRecordID: bigint, Channel: string, "
    "Computer: string, Security: struct<_UserID: string>, "
    "Execution: struct<_ProcessID: int, _ThreadID: int>>, "
    "EventData struct<Data: array<struct<_Name: string, _VALUE: string>>>, "
    "RenderingInfo struct<Message: string, Level: string, Task: string>, "
    "_malformed string"
)

_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "ignoreSurroundingSpaces": "false",
}


def parse_event(xml: Column) -> Column:
    """The event as a struct; ``_malformed`` holds text that is no event."""
    return F.from_xml(xml, EVENT, _OPTIONS)


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def event_data(event: Column) -> Column:
    """Name and value of each data element, empty strings for missing ones."""
    data = event["EventData"]["Data"]
    return F.transform(
        F.coalesce(data, F.array().cast("array<struct<_Name: string, _VALUE: string>>")),
        lambda d: F.struct(_blank(d["_Name"]).alias("key"), _blank(d["_VALUE"]).alias("value")),
    )


def full_data(data: Column) -> Column:
    """Data elements that have both a name and a value."""
    return F.filter(data, lambda d: (d["key"] != "") & (d["value"] != ""))


def _event_id(event: Column) -> Column:
    return F.coalesce(event["System"]["EventID"], F.lit(0)).cast("string")


def _process(event: Column) -> Column:
    pid = event["System"]["Execution"]["_ProcessID"]
    return F.when(pid > 0, pid.cast("string"))


def _user(event: Column) -> Column:
    return null_if_empty(event["System"]["Security"]["_UserID"])


def _message(head: Column, middle: Column, event: Column) -> Column:
    tail = F.array_compact(
        F.array(
            F.concat(F.lit("Process: "), _process(event)), F.concat(F.lit("User: "), _user(event))
        )
    )
    return F.array_join(F.concat(F.array(head), middle, tail), " | ")


def event_message(event: Column, full: Column) -> Column:
    """``[provider] Event ID n | name: value | Process: p | User: u``."""
    head = F.concat(
        F.lit("["), _blank(event["System"]["Provider"]["_Name"]), F.lit("] Event ID "), _event_id(event)
    )
    pairs = F.transform(full, lambda d: F.concat(d["key"], F.lit(": "), d["value"]))
    return _message(head, pairs, event)


def rendered_message(event: Column) -> Column:
    """The variant that prefers the pre-rendered message over the data."""
    rendered = null_if_empty(event["RenderingInfo"]["Message"])
    pairs = F.transform(
        F.filter(event_data(event), lambda d: (d["key"] != "") | (d["value"] != "")),
        lambda d: F.when(d["key"] != "", F.concat(d["key"], F.lit(": "), d["value"])).otherwise(
            d["value"]
        ),
    )
    middle = F.when(
        rendered.isNotNull(), F.array(F.concat(F.lit("Message: "), rendered))
    ).otherwise(pairs)
    return _message(F.concat(F.lit("Event ID: "), _event_id(event)), middle, event)


def event_fields(event: Column, full: Column) -> Column:
    """Field map: ids, then data by lower-case name (the last one wins), then origin."""
    system = event["System"]
    base = drop_null(
        literal_map(
            {
                "event_id": _event_id(event),
                "computer": _blank(system["Computer"]),
                "provider_guid": null_if_empty(system["Provider"]["_Guid"]),
                "user_id": _user(event),
                "process_id": _process(event),
            }
        )
    )
    data = last_wins(
        F.transform(
            full,
            lambda d: F.struct(F.lower(d["key"]).alias("key"), d["value"].alias("value")),
        )
    )
    return merge_maps(base, data)


def event_logs(raw: DataFrame, max_bytes: int = 10000, compat: bool = False) -> DataFrame:
    """Log rows of event XML. Malformed XML is kept as an info line with its raw text."""
    bad, event = F.col("__bad"), F.col("__event")
    origin = literal_map({"provider": F.col("__provider"), "channel": F.col("__channel")})
    # Intermediate columns that later ones use more than once are kept as columns, so
    # that each is computed once per row.
    prepared = (
        raw.withColumn("__event", parse_event(F.col("xml")))
        .withColumn("__bad", event.isNull() | event["_malformed"].isNotNull())
        .withColumn("__data", event_data(event))
        .withColumn("__full", full_data(F.col("__data")))
        .withColumns(
            {
                "__channel": F.when(bad, "").otherwise(_blank(event["System"]["Channel"])),
                "__provider": F.when(bad, "").otherwise(_blank(event["System"]["Provider"]["_Name"])),
                "__message": F.when(bad, F.col("xml")).otherwise(
                    event_message(event, F.col("__full"))
                ),
            }
        )
        .withColumns(
            {
                "__fields": F.when(bad, origin).otherwise(
                    merge_maps(event_fields(event, F.col("__full")), origin)
                ),
                "__clean": sanitize_utf8(F.col("__message")),
            }
        )
        .withColumns(
            {
                "__pid_text": F.col("__fields")["process_id"],
                "__event_id": F.col("__fields")["event_id"],
                "__lower_channel": F.lower("__channel"),
                "__lower_provider": F.lower("__provider"),
            }
        )
    )
    fields = F.col("__fields")
    pid_text = F.col("__pid_text")
    pid = F.when(pid_text.rlike(r"^[+-]?[0-9]+$"), pid_text.try_cast("int"))
    level = event_level_from_number(F.coalesce(event["System"]["Level"], F.lit(0)), compat)
    return log_rows(
        prepared,
        ts=F.when(bad, F.col("ref_ts")).otherwise(
            F.coalesce(rfc3339(event["System"]["TimeCreated"]["_SystemTime"]), F.col("ref_ts"))
        ),
        level=F.when(bad, "info").otherwise(level),
        message=truncate_bytes(F.col("__clean"), max_bytes),
        source=F.lit("eventviewer"),
        category=event_category(F.col("__lower_channel"), F.col("__lower_provider"), lowered=True),
        pid=F.coalesce(pid, F.lit(0)),
        fields=fields,
        labels=drop_null(
            literal_map({"event_id": F.col("__event_id"), "computer": fields["computer"]})
        ),
        meta=log_meta(
            platform=F.lit("eventviewer"),
            service=F.col("channel_name"),
            app_name=F.col("__provider"),
            event_id=_blank(F.col("__event_id")),
            user=_blank(fields["user_id"]),
            executable=F.when(pid.isNotNull(), _blank(fields["executable"])).otherwise(""),
            extra=fields,
        ),
    )
