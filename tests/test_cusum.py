"""Cumulative sums against a plain loop, for any cut into blocks and batches."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import models
from conftest import SCHEMA, alert_rows, at, make_readings
from fieldwatch.operators import cusum as C
from fieldwatch.operators.cusum import CusumRule, cusum_alerts, cusum_series, cusum_state
from fieldwatch.operators.registry import detect
from fieldwatch.sources.thresholds import load_thresholds

LIMITS = load_thresholds()
EXCESSES = st.lists(st.integers(-50, 50), min_size=1, max_size=60)


def slow(excesses, begun=0):
    out = []
    for x in excesses:
        begun = max(0, begun + x)
        out.append(begun)
    return out


@settings(max_examples=300, deadline=None)
@given(EXCESSES, st.integers(0, 100), st.sets(st.integers(0, 59)))
def test_running_sums_equal_the_loop(excesses, carry, restarts):
    starts = np.array([i in restarts for i in range(len(excesses))])
    expected, total = [], carry
    for x, begins in zip(excesses, starts, strict=True):
        total = max(0, (0 if begins else total) + x)
        expected.append(total)
    assert C.running_sums(np.array(excesses), starts, carry).tolist() == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(EXCESSES, min_size=1, max_size=6), st.integers(0, 200))
def test_effects_of_stretches_chain(stretches, given_sum):
    effect = None
    for part in stretches:
        own = (sum(part), slow(part)[-1])
        effect = own if effect is None else C.chained(effect, own)
    assert C.after(effect, given_sum) == slow([x for part in stretches for x in part], given_sum)[-1]


def rows_of(seed, lengths, gap_every=None):
    rng = random.Random(seed)
    rows = []
    for series, length in enumerate(lengths):
        seconds = 0
        for i in range(length):
            seconds += 7200 if gap_every and i % gap_every == gap_every - 1 else rng.choice([0, 60, 60])
            rows.append((f"S{series // 2}", ["PM10", "PM2.5"][series % 2], at(seconds), len(rows), round(rng.uniform(150, 420), 2)))
    return rows


def expected_sums(rows, gap=None):
    found = {}
    for key in {row[:2] for row in rows}:
        part = sorted((row for row in rows if row[:2] == key), key=lambda r: (r[2], r[3]))
        times = [row[2].timestamp() for row in part]
        sums = models.cusum_values([row[4] for row in part], 280.0, times, gap)
        found |= {row[3]: total / 1e6 for row, total in zip(part, sums, strict=True)}
    return found


@pytest.mark.parametrize(("blocks", "fan_out"), [(1, 64), (3, 64), (30, 2), (30, 5)])
@pytest.mark.parametrize("gap", [None, 3600])
def test_series_equal_the_loop(spark, blocks, fan_out, gap):
    rows = rows_of(blocks, [120, 1, 40, 7], 11 if gap else None)
    result = cusum_series(spark.createDataFrame(rows, SCHEMA), LIMITS, max_gap=gap, blocks=blocks, fan_out=fan_out)
    assert {row["event_id"]: row["cusum"] for row in result.collect()} == expected_sums(rows, gap)


def test_rule_table(spark):
    """Allowance 280, orange from a sum of 350, red from 700."""
    values = [280.0, 630.0, 280.0, 629.99, 280.01, 0.0, 279.0, 910.0, 630.0, -1e300]
    readings = make_readings(spark, list(enumerate(values)))
    alerts = [(row[2], row[4], row[6]) for row in alert_rows(cusum_alerts(readings, LIMITS))]
    assert alerts == [
        (1, 350.0, "orange"), (2, 350.0, "orange"), (3, 699.99, "orange"), (4, 700.0, "red"), (5, 420.0, "orange"),
        (6, 419.0, "orange"), (7, 1049.0, "red"), (8, 1399.0, "red"),
    ]


def test_other_rules_and_unknown_pollutants(spark):
    readings = make_readings(spark, [(0, 400.0), (1, 400.0)]).unionByName(make_readings(spark, [(0, 9999.0)], "XX"))
    rule = CusumRule(allowance=1.0, orange_sum=0.1, red_sum=0.2)
    assert [row[6] for row in alert_rows(detect("CUSUMThresholding", readings, LIMITS, rule=rule))] == ["orange", "red"]
    with pytest.raises(ValueError):
        CusumRule(orange_sum=2.0, red_sum=1.0)


def test_state_and_empty_tables(spark):
    rows = rows_of(5, [30, 20])
    table = spark.createDataFrame(rows, SCHEMA)
    state = {(r["site_id"], r["pollutant_type"]): (r["total"], r["last_at"]) for r in cusum_state(table, LIMITS, blocks=4).collect()}
    sums = expected_sums(rows)
    for key in {row[:2] for row in rows}:
        last = max((row for row in rows if row[:2] == key), key=lambda r: (r[2], r[3]))
        assert state[key] == (round(sums[last[3]] * 1e6), int(last[2].timestamp() * 1e6))
    assert cusum_alerts(table.limit(0), LIMITS).collect() == []
    with pytest.raises(ValueError, match="streams"):
        cusum_alerts(table, LIMITS, history=table)
