"""Levels, severities and ordered keyword rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# Journal priority -> level.
JOURNAL_LEVELS = {
    "0": "critical",
    "1": "critical",
    "2": "critical",
    "3": "error",
    "4": "warning",
    "5": "info",
    "6": "info",
    "7": "debug",
}

# Event level text -> level (compared in lower case).
EVENT_LEVELS = {
    "critical": "error",
    "error": "error",
    "warning": "warning",
    "information": "info",
    "verbose": "debug",
}

# Event level number -> level text.
EVENT_LEVEL_NUMBERS = {
    1: "critical",
    2: "error",
    3: "warning",
    4: "information",
    5: "verbose",
}

# Level -> OTLP severity number. Lower or upper case only.
SEVERITY_NUMBERS = {
    "trace": 1,
    "debug": 5,
    "info": 9,
    "warn": 13,
    "warning": 13,
    "error": 17,
    "fatal": 21,
    "critical": 21,
}

# Keywords of an auth message -> level, first hit wins.
AUTH_KEYWORDS = [
    ("failed", "warn"),
    ("invalid", "warn"),
    ("error", "error"),
    ("denied", "error"),
]

# Text in a syslog identifier or unit -> category, first hit wins.
JOURNAL_CATEGORIES = [
    ("sshd", "auth"),
    ("sudo", "auth"),
    ("login", "auth"),
    ("firewalld", "security"),
    ("auditd", "security"),
    ("selinux", "security"),
    ("networkmanager", "network"),
    ("dhclient", "network"),
    ("resolvconf", "network"),
    ("podman", "container"),
    ("docker", "container"),
    ("containerd", "container"),
    ("nginx", "application"),
    ("apache2", "application"),
    ("postgres", "application"),
    ("mysqld", "application"),
    ("systemd", "system"),
    ("cron", "system"),
    ("crond", "system"),
    ("kernel", "system"),
]

# Text in a channel or provider -> category, first hit wins.
EVENT_CATEGORIES = [
    ("system", "system"),
    ("microsoft-windows-kernel", "system"),
    ("microsoft-windows-systemevents", "system"),
    ("microsoft-windows-diagnostics", "system"),
    ("security", "auth"),
    ("microsoft-windows-security-authentication", "auth"),
    ("microsoft-windows-security-auditing", "auth"),
    ("microsoft-windows-security-logon", "auth"),
    ("microsoft-windows-windows defender", "security"),
    ("microsoft-windows-firewall", "security"),
    ("microsoft-windows-applocker", "security"),
    ("microsoft-windows-codeintegrity", "security"),
    ("microsoft-windows-networking", "network"),
    ("microsoft-windows-dhcp", "network"),
    ("microsoft-windows-dns", "network"),
    ("microsoft-windows-tcpip", "network"),
    ("microsoft-windows-networkprofile", "network"),
    ("application", "app"),
    ("microsoft-windows-iis", "app"),
    ("microsoft-windows-applicationhost", "app"),
    ("microsoft-windows-appxdeployment", "app"),
    ("microsoft-windows-containers", "container"),
    ("microsoft-windows-hyper-v", "container"),
    ("docker", "container"),
    ("microsoft-windows-grouppolicy", "config"),
    ("microsoft-windows-windowsupdateclient", "config"),
    ("microsoft-windows-servicing", "config"),
    ("microsoft-windows-audit", "audit"),
    ("microsoft-windows-ntlm", "audit"),
    ("microsoft-windows-certificateservicesclient", "audit"),
    ("microsoft-windows-taskscheduler", "scheduler"),
    ("microsoft-windows-windowsbackup", "scheduler"),
    ("microsoft-windows-bits", "scheduler"),
]


def lookup(value: Column, table: dict, default: Column | str | int) -> Column:
    """A fixed table as one CASE expression."""
    chain = reduce(
        lambda acc, kv: acc.when(value == F.lit(kv[0]), F.lit(kv[1])),
        list(table.items())[1:],
        F.when(value == F.lit(next(iter(table))), F.lit(next(iter(table.values())))),
    )
    return chain.otherwise(default)


def first_hit(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Result of the first rule whose key occurs in ``text``; null when none does.

    Neighbouring rules with one result share a branch, so the order is kept and the
    generated CASE stays short.
    """
    chain = None
    for result, group in groupby(rules, key=lambda rule: rule[1]):
        hit = reduce(lambda a, b: a | b, [F.contains(text, F.lit(key)) for key, _ in group])
        chain = F.when(hit, result) if chain is None else chain.when(hit, result)
    return chain


def classify(
    inputs: list[Column], rules: list[tuple[str, str]], default: str, lowered: bool = False
) -> Column:
    """First input that hits any rule decides, in input order then rule order.

    ``lowered`` says that the inputs are in lower case already.
    """
    texts = [i if lowered else F.lower(i) for i in inputs]
    return F.coalesce(*[first_hit(t, rules) for t in texts], F.lit(default))


def journal_category(
    identifier: Column, unit: Column, product: str = "fleetlens", lowered: bool = False
) -> Column:
    """Category of a journal record; the agent's own lines are named ``product``."""
    rules = JOURNAL_CATEGORIES + [(product.lower(), product)]
    return classify([identifier, unit], rules, "systemd", lowered)


def event_category(channel: Column, provider: Column, lowered: bool = False) -> Column:
    return classify([channel, provider], EVENT_CATEGORIES, "system", lowered)


def journal_level(priority: Column) -> Column:
    return lookup(priority, JOURNAL_LEVELS, "unknown")


def event_level(text: Column) -> Column:
    return lookup(F.lower(text), EVENT_LEVELS, "info")


def event_level_from_number(number: Column, compat: bool = False) -> Column:
    """Level of an event; ``compat`` looks the digits up as text, so all are info."""
    if compat:
        return event_level(number.cast("string"))
    return event_level(lookup(number, EVENT_LEVEL_NUMBERS, ""))


def severity_number(level: Column) -> Column:
    known = SEVERITY_NUMBERS | {k.upper(): v for k, v in SEVERITY_NUMBERS.items()}
    return lookup(level, known, 0)


def detect_severity(message: Column, lowered: bool = False) -> Column:
    return classify([message], AUTH_KEYWORDS, "info", lowered)
