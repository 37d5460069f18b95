"""CPU and network rates: edge rows of the counters."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from fleetlens.operators.rates import sample_rates

SCHEMA = (
    "id string, seq int, ts timestamp, cpu_total decimal(20,0), cpu_system decimal(20,0), online int, "
    "rx decimal(20,0), tx decimal(20,0)"
)
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
TOP = 2**64 - 1


def frame(spark, rows):
    """Rows of (id, seq, seconds, cpu, system, online, rx, tx)."""
    return spark.createDataFrame(
        [
            (i, seq, T0 + dt.timedelta(seconds=s), Decimal(c), Decimal(y), n, Decimal(rx), Decimal(tx))
            for i, seq, s, c, y, n, rx, tx in rows
        ],
        SCHEMA,
    )


def rates(spark, rows, **options):
    out = sample_rates(frame(spark, rows), ["id"], ["ts", "seq"], 60, **options).collect()
    return {(r.id, r.seq): r for r in out}


def test_second_sample_gives_rates(spark):
    got = rates(spark, [("a", 1, 0, 100, 1000, 4, 0, 10), ("a", 2, 2, 150, 1100, 4, 500, 30)])
    assert got["a", 1].cpu_percent == 0 and got["a", 1].rx_rate == 0
    assert got["a", 2].cpu_percent == pytest.approx(50 / 100 * 4 * 100)
    assert (got["a", 2].rx_rate, got["a", 2].tx_rate) == (250.0, 10.0)


def test_zero_deltas_and_no_cpus(spark):
    got = rates(
        spark,
        [
            ("a", 1, 0, 100, 1000, 4, 0, 0),
            ("a", 2, 0, 150, 1100, 4, 500, 0),  # same time
            ("a", 3, 1, 150, 1200, 4, 500, 0),  # idle
            ("a", 4, 2, 160, 1200, 4, 500, 0),  # system clock stands still
            ("a", 5, 3, 170, 1300, 0, 500, 0),  # no CPUs
        ],
    )
    assert got["a", 2].rx_rate == 0 and got["a", 2].cpu_percent > 0
    assert [got["a", i].cpu_percent for i in (3, 4, 5)] == [0, 0, 0]


def test_reset_is_zero_and_flagged(spark):
    rows = [("a", 1, 0, 1000, 1000, 1, 900, 900), ("a", 2, 1, 10, 2000, 1, 5, 950)]
    got = rates(spark, rows)["a", 2]
    assert got.reset and got.cpu_percent == 0 and got.rx_rate == 0 and got.tx_rate == 50


def test_compat_wraps_the_counter_and_has_no_network_rate(spark):
    rows = [("a", 1, 0, 1000, 1000, 1, 900, 900), ("a", 2, 1, 990, 2000, 1, 950, 950)]
    got = rates(spark, rows, compat=True)["a", 2]
    assert got.cpu_percent == pytest.approx((2**64 - 10) / 1000 * 100)
    assert (got.rx_rate, got.tx_rate) == (0, 0)


def test_largest_counter(spark):
    rows = [("a", 1, 0, TOP - 10, 0, 1, 0, 0), ("a", 2, 1, TOP, 100, 1, TOP, 0)]
    got = rates(spark, rows)["a", 2]
    assert got.cpu_percent == pytest.approx(10.0)
    assert got.rx_rate == float(TOP)


def test_input_order_does_not_matter(spark):
    rows = [("a", i, i * 45, i * 10, i * 100, 2, i * 7, i) for i in range(8)]
    assert rates(spark, rows) == rates(spark, rows[::-1])


def test_containers_do_not_mix(spark):
    rows = [("a", 1, 0, 100, 100, 1, 0, 0), ("b", 2, 1, 900, 900, 1, 0, 0)]
    assert rates(spark, rows)["b", 2].cpu_percent == 0
