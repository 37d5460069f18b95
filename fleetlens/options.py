"""Options of the three jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MetricOptions:
    sources: tuple[str, ...] = ("cpu", "mem", "host", "disk", "net", "podman")
    interval: str = "2 seconds"
    max_points: int | None = 1000
    product: str = "fleetlens"
    compat: bool = False


@dataclass(frozen=True)
class LogOptions:
    sources: tuple[str, ...] = ("journald", "security")
    interval: str = "30 seconds"
    batch_size: int = 50
    message_max: int = 10000
    collect_all: bool = False
    channels: tuple[str, ...] = ()
    exclude_channels: tuple[str, ...] = ()
    zone: str = "UTC"
    product: str = "fleetlens"
    compat: bool = False


def log_settings(options: LogOptions) -> dict[str, dict]:
    """What the options mean for each log source."""
    limit = {"max_bytes": options.message_max}
    return {
        "journal": {**limit, "product": options.product},
        "syslog": {**limit, "zone": options.zone, "compat": options.compat},
        "events_xml": {**limit, "compat": options.compat},
    }


@dataclass(frozen=True)
class ProcessOptions:
    interval: str = "2 seconds"
    top_n: int = 20
    compat: bool = False


@dataclass(frozen=True)
class StreamOptions:
    """Where a stream keeps its progress and how it is paced.

    ``max_files_per_trigger`` is the back-pressure: input waits instead of being
    dropped when the job cannot keep up. ``delay`` is how far behind the newest row a
    snapshot or tick is closed, ``late`` the folder of rows that come after that (beside the
    output by default). Rows at or after ``end`` only move the time on.
    """

    output: str
    checkpoint: str
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    max_files_per_trigger: int | None = None
    delay: str = "10 minutes"
    end: str | None = None
    late: str | None = None
