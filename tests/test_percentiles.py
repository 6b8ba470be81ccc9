"""Percentiles against the rank rule written out in Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

import stopclock as sc
from events_timetable import schedule_from_events
from stopclock.operators import ordering

LEVELS = (0.0, 12.5, 50.0, 90.0, *sc.PERCENTILES, 100.0)


def by_hand(values, percentile):
    ordered = sorted(values)
    rank = percentile / 100.0 * (len(ordered) - 1)
    low = ordered[math.floor(rank)]
    high = ordered[min(math.floor(rank) + 1, len(ordered) - 1)]
    value = low + (rank - math.floor(rank)) * (high - low)
    return value, sum(v > value for v in ordered)


def _random_groups():
    rng = random.Random(7)
    groups = {}
    for g in range(60):
        size = rng.choice([1, 2, 3, 5, 20, 21, 200, 201])
        pool = rng.choice([[2.0], [2.0, 5.0], range(1, 30), None])
        groups[g] = [
            float(rng.choice(pool)) if pool else rng.randint(1, 86_400) / 60.0 for _ in range(size)
        ]
    return groups


def test_grouped_percentiles_match_the_rank_rule_exactly(make_stops):
    groups = _random_groups()
    rows = [(g, v) for g, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    table = sc.percentile_table(make_stops(rows, "g int,"), LEVELS, by=["g"]).collect()
    assert len(table) == len(groups) * len(LEVELS)
    for r in table:
        assert (r.value, r.exceeding_count) == by_hand(groups[r.g], r.percentile), r
        assert r.valid == len(groups[r.g])


@pytest.mark.parametrize("values", [[3.0], [3.0, 9.0], [5.0] * 7, [1.0, 2.0, 3.0, 4.0, 5.0]])
def test_small_inputs(make_stops, values):
    got = {r.percentile: (r.value, r.exceeding_count) for r in sc.percentile_table(make_stops(values), LEVELS).collect()}
    assert got == {p: by_hand(values, p) for p in LEVELS}


def test_empty_input_gives_no_rows(make_stops, make_schedule):
    assert sc.percentile_table(make_stops([])).collect() == []
    assert sc.percentile_table(make_stops([(None,)])).collect() == []
    with pytest.warns(UserWarning, match="no stop durations"):
        assert sc.percentile_values(make_stops([])) == {}
    assert sc.stop_duration_report(make_schedule([])).collect() == []
    assert sc.sorted_durations(make_stops([(None,)])).collect() == []


def test_null_durations_are_ignored(make_stops):
    assert sc.percentile_values(make_stops([(None,), (1.0,), (3.0,), (None,)]), [50]) == {50.0: 2.0}


def test_one_row_per_request_in_requested_order(make_stops):
    requested = [99.0, 50.0, 95.0, 50.0]
    table = sc.exact_percentiles(make_stops([1.0, 2.0, 3.0]), requested)
    assert [r.percentile for r in table.collect()] == requested
    totals = sc.station_exceeding_total(make_stops([("a", 1.0), ("a", 2.0), ("b", 4.0)], "station_name string,"), [50, 0, 50]).collect()
    assert sorted(tuple(r) for r in totals) == [(0.0, 1), (50.0, 1), (50.0, 1)]


def test_empty_thresholds_are_refused(make_stops):
    with pytest.raises(ValueError, match="thresholds"):
        sc.threshold_counts(make_stops([1.0]), [])


def test_a_frequent_duration_is_split_among_partitions(make_stops, spark):
    n, rare = 200_000, 5_000
    minutes = F.when(F.col("id") < n * 95 // 100, 2.0).otherwise((F.col("id") % rare + 130) / 60.0)
    ordered = sc.sorted_durations(spark.range(n).select(minutes.alias("stop_duration_minutes")))
    parts = ordered.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
    assert sum(r["rows"] for r in parts) == n and max(r["rows"] for r in parts) <= 2 * n / len(parts)
    got = [r[0] for r in ordered.collect()]
    assert got == sorted(got) and got.count(2.0) == n * 95 // 100


@pytest.mark.parametrize("bad", [[], [-1], [100.5], [float("nan")]])
def test_bad_percentiles_are_refused(make_stops, bad):
    with pytest.raises(ValueError):
        sc.exact_percentiles(make_stops([1.0]), bad)


def test_result_does_not_depend_on_partitioning(events_schedule):
    expected = sc.stop_duration_report(events_schedule).collect()
    for n in (1, 3, 40):
        assert sc.stop_duration_report(events_schedule.repartition(n)).collect() == expected


def test_exceeding_counts_fall_as_percentiles_rise(events_schedule):
    counts = [r.exceeding_count for r in sc.stop_duration_report(events_schedule).collect()]
    assert counts == sorted(counts, reverse=True)


def test_thresholds_in_one_pass(make_stops):
    stops = make_stops([1.0, 2.0, 2.0, (None,), 5.0])
    assert [tuple(r) for r in sc.threshold_counts(stops, [2, 0.5, 5]).collect()] == [
        (2.0, 1),
        (0.5, 4),
        (5.0, 0),
    ]
    assert sc.count_exceeding(stops, 1.5) == 3


def test_station_totals_follow_each_station(make_stops):
    rows = [("a", float(v)) for v in range(1, 101)] + [("b", float(v)) for v in range(1001, 1101)]
    total = sc.station_exceeding_total(make_stops(rows, "station_name string,"), [90.0])
    assert [tuple(r) for r in total.collect()] == [(90.0, 20)]


def test_one_hot_station_changes_nothing_for_the_others(make_stops):
    rows = [("hot", float(1 + n % 7)) for n in range(6000)] + [(f"s{n}", 4.0) for n in range(50)]
    got = sc.station_percentiles(make_stops(rows, "station_name string,"), [50.0]).collect()
    assert {r.value for r in got} == {4.0} and len(got) == 51


@pytest.mark.parametrize("chunk", [1, 3, 1_000_000])
def test_sorted_durations(make_stops, monkeypatch, chunk):
    monkeypatch.setattr(ordering, "_CHUNK", chunk)
    values = [float(random.Random(3).choice([1, 2, 2, 2, 7, 30])) for _ in range(20)] + [9.0, 1.5]
    got = [r.stop_duration_minutes for r in sc.sorted_durations(make_stops(values)).collect()]
    assert got == sorted(values)


GOLDEN = {
    "sf0.001": [(141.45, 46), (212.89, 10), (240.235, 5), (309.691, 1), (325.269, 1)],
    "sf0.01": [(148.0, 445), (226.0, 90), (259.78, 46), (346.489, 5), (443.086, 1)],
    "sf0.1": [(150.0, 4436), (228.0, 898), (263.915, 453), (382.792, 46), (478.437, 5)],
}


@pytest.mark.parametrize("scale", GOLDEN)
def test_golden_report(spark, scale):
    events = spark.read.parquet(f"/root/testdata/{scale}/events.parquet")
    schedule = schedule_from_events(events)
    report = sc.stop_duration_report(schedule).collect()
    assert [(round(r.value, 3), r.exceeding_count) for r in report] == GOLDEN[scale]
    # The one-pass analysis must agree with the report to the last digit.
    assert sc.analysis(schedule).first().results == report


def test_result_does_not_depend_on_ansi_mode(spark, events_schedule):
    expected = sc.analysis(events_schedule).first()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert sc.analysis(events_schedule).first() == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
