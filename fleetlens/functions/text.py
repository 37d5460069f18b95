"""Text helpers: byte limits, encoding repair, list and tag parsing, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.maps import last_wins

REPLACEMENT = "\ufffd"
_ESCAPE = "\ue000"  # private-use character, itself escaped


def sanitize_utf8(text: Column) -> Column:
    """Each run of invalid bytes becomes one U+FFFD; valid text is untouched.

    ``make_valid_utf8`` writes one mark per bad sequence, so runs are collapsed
    afterwards. Marks that were already in the text are escaped first and put back
    last, hence they never merge with a repaired run.
    """
    escaped = F.replace(
        F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")),
        F.lit(REPLACEMENT),
        F.lit(_ESCAPE + "1"),
    )
    collapsed = F.regexp_replace(F.make_valid_utf8(escaped), REPLACEMENT + "+", REPLACEMENT)
    restored = F.replace(
        F.replace(collapsed, F.lit(_ESCAPE + "1"), F.lit(REPLACEMENT)),
        F.lit(_ESCAPE + "0"),
        F.lit(_ESCAPE),
    )
    return F.when(F.is_valid_utf8(text), text).otherwise(restored)


def truncate_bytes(text: Column, limit: int, zero_is_unlimited: bool = True) -> Column:
    """Cut at ``limit`` bytes and append a marker; a split character is repaired."""
    if limit <= 0 and zero_is_unlimited:
        return text
    head = F.substring(text.cast("binary"), 1, max(limit, 0)).cast("string")
    cut = F.concat(F.make_valid_utf8(head), F.lit(" [truncated]"))
    return F.when(F.octet_length(text) > limit, cut).otherwise(text)


def split_csv(text: Column) -> Column:
    """Comma-separated items, trimmed, empty ones dropped."""
    items = F.transform(F.split(text, ","), _strip)
    return F.filter(items, lambda s: s != "")


def parse_tags(text: Column) -> Column:
    """``k=v,k=v`` to a map: trims, skips malformed items, the last key wins."""
    pairs = F.transform(
        F.filter(F.split(text, ","), lambda s: F.instr(s, "=") > 0),
        lambda s: F.struct(
            _strip(F.substring_index(s, "=", 1)).alias("key"),
            _strip(_after_equals(s)).alias("value"),
        ),
    )
    return last_wins(F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != "")))


def _after_equals(item: Column) -> Column:
    return F.substr(item, F.instr(item, "=") + 1)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def parse_int(text: Column) -> Column:
    """A whole decimal number, anything else 0 (padding is not accepted)."""
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int")), F.lit(0))


def normalize_key(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def short_id(container_id: Column) -> Column:
    return F.substring(container_id, 1, 12)


def strip_slash(name: Column) -> Column:
    return F.regexp_replace(name, "^/", "")


def image_version(image: Column) -> Column:
    """The part after the colon, when there is exactly one colon."""
    parts = F.split(image, ":")
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(1)))


def format_ports(ports: Column) -> Column:
    """``public:private/type`` or ``private/type``, comma-joined."""
    one = lambda p: F.concat(
        F.when(p["public_port"] > 0, F.concat(p["public_port"].cast("string"), F.lit(":"))).otherwise(""),
        p["private_port"].cast("string"),
        F.lit("/"),
        p["type"],
    )
    return F.coalesce(F.array_join(F.transform(ports, one), ","), F.lit(""))
