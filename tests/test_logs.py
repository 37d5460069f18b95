"""Log sources: journal, auth log, Windows events, and text functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions import levels as L
from fleetlens.functions.text import parse_int, parse_tags, sanitize_utf8, split_csv, truncate_bytes
from fleetlens.functions.timestamps import rfc3339
from fleetlens.operators.channels import channel_selected, glob_regex
from fleetlens.sources.eventlog import event_logs
from fleetlens.sources.journal import journal_logs
from fleetlens.sources.syslog import auth_logs, choose_path

UTC = dt.timezone.utc


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# --- auth log -----------------------------------------------------------------


def lines(spark, *texts, ref="2024-06-30T12:00:00", **options):
    ref_ts = dt.datetime.fromisoformat(ref).replace(tzinfo=UTC)
    raw = spark.createDataFrame(
        [("h", t, "/var/log/secure", ref_ts) for t in texts], schemas.RAW_SYSLOG
    )
    out = auth_logs(raw, **options).withColumn("us", F.unix_micros("ts"))
    return out.collect()


def at(*parts):
    return int(dt.datetime(*parts, tzinfo=UTC).timestamp() * 1_000_000)


def test_typical_line(spark):
    text = "Apr 26 07:15:01 web-3 CRON[871]: pam_unix(job): a session was opened for backup"
    (row,) = lines(spark, text)
    assert (row.us, row.source, row.level, row.category, row.pid) == (
        at(2024, 4, 26, 7, 15, 1), "CRON", "info", "auth", 0,
    )
    assert row.message.startswith("pam_unix(job): a session")
    assert row.labels == {"log_path": "/var/log/secure", "hostname_log": "web-3"}
    assert (row.meta.platform, row.meta.app_name, row.meta.path) == ("file", "CRON", "/var/log/secure")


def test_short_lines_and_empty_messages_are_dropped(spark):
    assert lines(spark, "Apr 26 07:15:01 myhost", "", "Apr 26 07:15:01 myhost sshd:") == []


def test_padded_day(spark):
    text = "Apr  6 07:15:01 host sshd[1]: Failed password"
    (plain,) = lines(spark, text)
    (compat,) = lines(spark, text, compat=True)
    assert plain.message == "Failed password" and compat.message == " Failed password"
    assert plain.us == at(2024, 4, 6, 7, 15, 1)


@pytest.mark.parametrize(
    "text, ref, expected",
    [
        ("Dec 31 23:59:59", "2024-01-02T00:00:00", (2023, 12, 31, 23, 59, 59)),
        ("Feb 29 01:00:00", "2023-03-05T00:00:00", (2023, 3, 1, 1, 0, 0)),
        ("Feb 29 01:00:00", "2024-03-05T00:00:00", (2024, 2, 29, 1, 0, 0)),
        ("Feb 30 01:00:00", "2024-03-05T00:00:00", (2024, 3, 5, 0, 0, 0)),
        ("Foo 12 01:00:00", "2024-03-05T00:00:00", (2024, 3, 5, 0, 0, 0)),
        ("Mar 12 25:00:00", "2024-03-05T00:00:00", (2024, 3, 5, 0, 0, 0)),
        ("Mar x2 05:00:00", "2024-03-05T00:00:00", (2024, 3, 5, 0, 0, 0)),
    ],
)
def test_syslog_times(spark, text, ref, expected):
    (row,) = lines(spark, f"{text} host sshd: hello", ref=ref)
    assert row.us == at(*expected)


def test_syslog_zone(spark):
    (row,) = lines(spark, "Jul 1 12:00:00 host sshd: hi", ref="2024-07-02T00:00:00", zone="Europe/Berlin")
    assert row.us == at(2024, 7, 1, 10, 0, 0)


def test_first_keyword_group_wins(spark):
    (row,) = lines(spark, "Apr 6 07:15:01 host sshd: error: login FAILED")
    assert row.level == "warn"
    (row,) = lines(spark, "Apr 6 07:15:01 host sshd: access denied")
    assert row.level == "error"


def test_message_limit(spark):
    text = "Apr 6 07:15:01 host sshd: 0123456789"
    assert lines(spark, text, max_bytes=10)[0].message == "0123456789"
    assert lines(spark, text, max_bytes=9)[0].message == "012345678 [truncated]"
    assert lines(spark, text, max_bytes=0)[0].message == "0123456789"
    assert lines(spark, text, max_bytes=0, compat=True)[0].message == " [truncated]"


def test_path_choice():
    assert choose_path(["/var/log/auth.log", "/var/log/secure"]) == "/var/log/secure"
    assert choose_path(["/var/log/auth.log"]) == "/var/log/auth.log"
    assert choose_path([]) is None


# --- journal ------------------------------------------------------------------


def journal(spark, *records, users=None, **options):
    schema = schemas.RAW_JOURNAL
    names = ["host_id", "realtime_us", *schemas.JOURNAL_FIELDS]
    rows = [tuple({"host_id": "h", "realtime_us": 5, "MESSAGE": "m", **r}.get(n) for n in names) for r in records]
    accounts = None if users is None else spark.createDataFrame(users, schemas.USERS)
    return journal_logs(spark.createDataFrame(rows, schema), accounts, **options).collect()


def test_priorities_read(spark):
    got = journal(spark, *[{"PRIORITY": p} for p in (*"01234567", None)])
    assert sorted(r.level for r in got) == ["critical", "critical", "critical", "error", "warning"]


def test_kernel_lines_are_left_out(spark):
    ids = ["kernel", "kernels", None]
    got = journal(spark, *[{"PRIORITY": "3", "SYSLOG_IDENTIFIER": i} for i in ids])
    assert len(got) == 2


def test_journal_record(spark):
    (row,) = journal(
        spark,
        {"PRIORITY": "2", "SYSLOG_IDENTIFIER": "sshd", "_SYSTEMD_UNIT": "ssh.service", "_PID": "12",
         "_COMM": "", "_HOSTNAME": "box", "CONTAINER_ID": "c1", "_UID": "1000", "_EXE": "/bin/sshd"},
        users=[("h", 1000, "ann"), ("other", 1000, "bob")],
    )
    assert row.fields == {
        "SYSLOG_IDENTIFIER": "sshd", "SYSTEMD_UNIT": "ssh.service", "PID": "12", "HOSTNAME": "box",
        "CONTAINER_ID": "c1", "UID": "1000", "EXE": "/bin/sshd",
    }
    assert row.meta.extra["_PID"] == "12" and "_HOSTNAME" not in row.meta.extra
    assert row.labels == {"container_id": "c1"}
    assert (row.pid, row.category, row.source, row.meta.user) == (12, "auth", "systemd", "ann")


@pytest.mark.parametrize(
    "fields, user",
    [
        ({"USERNAME": "u", "SUDO_USER": "s"}, "u"),
        ({"USERNAME": "", "SUDO_USER": "s"}, "s"),
        ({"SSH_USER": "r", "_UID": "1"}, "r"),
        ({"UID": "2", "_UID": "1"}, "two"),
        ({"UID": "", "_UID": "1"}, "one"),
        ({"_UID": "x"}, ""),
        ({"_UID": "9"}, ""),
    ],
)
def test_user_of_a_record(spark, fields, user):
    users = [("h", 1, "one"), ("h", 2, "two")]
    (row,) = journal(spark, {"PRIORITY": "1", **fields}, users=users)
    assert row.meta.user == user


@pytest.mark.parametrize(
    "identifier, unit, category",
    [
        ("SSHD-session", None, "auth"),
        ("app", "docker.service", "container"),
        ("app", None, "systemd"),
        ("systemd-logind", None, "auth"),
        ("cron", "sshd", "system"),
        ("Fleetlens-agent", None, "fleetlens"),
        (None, None, "systemd"),
    ],
)
def test_journal_category(spark, identifier, unit, category):
    column = L.journal_category(F.lit(identifier).cast("string"), F.lit(unit).cast("string"))
    assert one(spark, column) == category


# --- Windows events -----------------------------------------------------------

EVENT = (
    "<Event xmlns='http://schemas.microsoft.com/win/2004/08/events/event'><System>"
    "<Provider Name='P' Guid='{1}'/><EventID Qualifiers='0'>7036</EventID><Level>{level}</Level>"
    "<TimeCreated SystemTime='2024-01-02T03:04:05.1234567Z'/><Channel>{channel}</Channel>"
    "<Computer>pc</Computer><Security UserID='S-1'/><Execution ProcessID='42' ThreadID='1'/></System>"
    "<EventData>{data}</EventData>"
    "<RenderingInfo><Message>done</Message></RenderingInfo></Event>"
)


def event(spark, xml=None, level=2, channel="System", data="", **options):
    text = xml or EVENT.replace("{level}", str(level)).replace("{channel}", channel).replace("{data}", data)
    ref = dt.datetime(2024, 6, 1, tzinfo=UTC)
    raw = spark.createDataFrame([("h", text, "Given", ref)], schemas.RAW_EVENT_XML)
    return event_logs(raw, **options).withColumn("us", F.unix_micros("ts")).first()


def test_event(spark):
    row = event(spark, data="<Data Name='A'>1</Data><Data Name='a'>2</Data><Data>x</Data><Data Name='B'/>")
    assert row.us == at(2024, 1, 2, 3, 4, 5) + 123456
    assert row.message == "[P] Event ID 7036 | A: 1 | a: 2 | Process: 42 | User: S-1"
    assert row.fields == {
        "event_id": "7036", "computer": "pc", "provider_guid": "{1}", "user_id": "S-1", "process_id": "42",
        "a": "2", "provider": "P", "channel": "System",
    }
    assert row.labels == {"event_id": "7036", "computer": "pc"}
    assert (row.pid, row.meta.service, row.meta.app_name, row.meta.event_id) == (42, "Given", "P", "7036")
    assert row.meta.extra == row.fields and row.meta.executable == ""


def test_event_data_overrides_the_fields(spark):
    row = event(spark, data="<Data Name='Executable'>x.exe</Data><Data Name='PROCESS_ID'>7</Data>")
    assert row.pid == 7 and row.meta.executable == "x.exe"


@pytest.mark.parametrize("level, name", [(0, "info"), (1, "error"), (2, "error"), (3, "warning"), (4, "info"), (5, "debug")])
def test_event_levels(spark, level, name):
    assert event(spark, level=level).level == name
    assert event(spark, level=level, compat=True).level == "info"


@pytest.mark.parametrize("xml", ["<Event><System>", "no xml", "<Event><System><EventID>x</EventID></System></Event>"])
def test_malformed_event_is_kept_as_text(spark, xml):
    row = event(spark, xml=xml)
    assert (row.message, row.level, row.category, row.pid) == (xml, "info", "system", 0)
    assert row.fields == {"provider": "", "channel": ""} and row.labels == {}
    assert row.us == at(2024, 6, 1)


@pytest.mark.parametrize(
    "channel, provider, category",
    [
        ("Microsoft-Windows-Windows Firewall With Advanced Security/Firewall", "", "auth"),
        ("Microsoft-Windows-AppLocker/EXE and DLL", "", "security"),
        ("DNS Server", "Microsoft-Windows-DNS-Client", "network"),
        ("", "", "system"),
    ],
)
def test_event_category(spark, channel, provider, category):
    assert one(spark, L.event_category(F.lit(channel), F.lit(provider))) == category


def test_channel_selection(spark):
    def selected(name, **options):
        return one(
            spark,
            channel_selected(F.lit(name), ["System"], ["Microsoft-Windows-Help*", "A.B", "bad["], **options),
        )

    assert selected("SYSTEM") and not selected("Other") and selected("Other", collect_all=True)
    assert not selected("Microsoft-Windows-HelpX", collect_all=True)
    assert selected("microsoft-windows-helpx", collect_all=True)
    assert not selected("A.B", collect_all=True) and selected("AxB", collect_all=True)
    assert selected("System\n", collect_all=True)
    assert glob_regex("bad[") is None


# --- text ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "raw, expected",
    [
        (b"plain", "plain"),
        (b"a\xff\xfe\xfdb", "a�b"),
        ("é��".encode(), "é��"),
        ("�".encode() + b"\xff" + "�".encode(), "���"),
        (b"\xffx\xff", "�x�"),
        (b"", ""),
    ],
)
def test_sanitize(spark, raw, expected):
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(sanitize_utf8(F.col("b").cast("string"))).first()[0] == expected


@pytest.mark.parametrize(
    "limit, expected", [(6, "aéé€"[:3] + "� [truncated]"), (8, "aéé€"), (5, "aéé [truncated]")]
)
def test_truncate_inside_a_character(spark, limit, expected):
    assert one(spark, truncate_bytes(F.lit("aéé€"), limit)) == expected


def test_small_parsers(spark):
    assert one(spark, parse_tags(F.lit(" a = 1 ,b,c=,=d,a=2=3,"))) == {"a": "2=3"}
    assert one(spark, split_csv(F.lit(" a ,, b c,"))) == ["a", "b c"]
    assert [one(spark, parse_int(F.lit(t))) for t in ("12", "-3", " 4", "x", "", "99999999999")] == [12, -3, 0, 0, 0, 0]
    assert one(spark, F.unix_micros(rfc3339(F.lit("2024-01-02T03:04:05.1234567+01:00")))) == at(2024, 1, 2, 2, 4, 5) + 123456
    assert one(spark, rfc3339(F.lit("2024-01-02 03:04:05"))) is None


LEVEL_NUMBERS = {
    "trace": 1, "debug": 5, "info": 9, "warn": 13, "warning": 13, "error": 17, "fatal": 21, "critical": 21,
}


@pytest.mark.parametrize(
    "level, number",
    [*LEVEL_NUMBERS.items(), *[(k.upper(), v) for k, v in LEVEL_NUMBERS.items()], ("Warn", 0), ("unknown", 0)],
)
def test_severity_numbers(spark, level, number):
    assert one(spark, L.severity_number(F.lit(level))) == number
