"""Channel selection by exclude globs and an include list."""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def glob_regex(pattern: str) -> str | None:
    """Anchored regex of a glob: ``.`` is literal, ``*`` is any text, all else stays a
    regex. A pattern that does not compile matches nothing."""
    regex = "^" + pattern.replace(".", r"\.").replace("*", ".*") + r"\z"
    try:
        re.compile(regex.replace(r"\z", r"\Z"))
    except re.error:
        log.warning("invalid channel pattern %r matches nothing", pattern)
        return None
    return regex


def matches_glob(channel: Column, pattern: str) -> Column:
    regex = glob_regex(pattern)
    return F.lit(False) if regex is None else channel.rlike(regex)


def channel_selected(
    channel: Column, include: list[str], exclude_globs: list[str], collect_all: bool = False
) -> Column:
    """Excludes win; then everything if ``collect_all``; else a case-insensitive list."""
    excluded = reduce(
        lambda a, b: a | b, [matches_glob(channel, p) for p in exclude_globs], F.lit(False)
    )
    wanted = F.lit(True) if collect_all else F.lower(channel).isin([c.lower() for c in include])
    return ~excluded & wanted


def select_channels(
    events: DataFrame,
    include: list[str],
    exclude_globs: list[str],
    collect_all: bool = False,
    channel: str = "channel_name",
) -> DataFrame:
    """Rows of the selected channels: a narrow filter that can reach the scan."""
    return events.filter(channel_selected(F.col(channel), include, exclude_globs, collect_all))
