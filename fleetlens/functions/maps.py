"""String-map helpers shared by tags, dimensions, fields and attributes.

Sessions build maps with ``spark.sql.mapKeyDedupPolicy = LAST_WIN`` (see
``session.SETTINGS``); under Spark's default a repeated key raises an error instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def merge_maps(base: Column, extra: Column) -> Column:
    """Union of two maps; the right side wins, a null map counts as empty."""
    return F.map_concat(F.coalesce(base, empty_map()), F.coalesce(extra, empty_map()))


def drop_empty(col: Column) -> Column:
    """Entries whose key and value are both non-empty."""
    return F.map_filter(F.coalesce(col, empty_map()), lambda k, v: (k != "") & (v != ""))


def drop_null(col: Column) -> Column:
    return F.map_filter(col, lambda k, v: v.isNotNull())


def literal_map(pairs: dict[str, Column | str]) -> Column:
    """A map from fixed keys to columns (or literal strings)."""
    parts: list[Column] = []
    for key, value in pairs.items():
        parts += [F.lit(key), value if isinstance(value, Column) else F.lit(value)]
    return F.create_map(*parts).cast("map<string,string>")


def prefix_keys(col: Column, prefix: str) -> Column:
    return F.transform_keys(
        F.coalesce(col, empty_map()), lambda k, v: F.concat(F.lit(prefix), k)
    )


def last_wins(entries: Column) -> Column:
    """Map from an array of ``(key, value)`` structs in which a later key wins."""
    return F.map_from_entries(entries)


def sorted_entries(col: Column) -> Column:
    """Entries ordered by key: a form that can be grouped, compared and nested."""
    return F.array_sort(F.map_entries(F.coalesce(col, empty_map())))


def render_map(col: Column) -> Column:
    """``k=v;k=v`` in key order."""
    return F.array_join(
        F.transform(sorted_entries(col), lambda e: F.concat(e["key"], F.lit("="), e["value"])),
        ";",
    )
