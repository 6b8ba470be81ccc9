"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import Observation

import __spark_entry__ as entry_module
import stopclock as sc

SF = "/root/testdata/sf0.001"
QUERIES = entry_module.timetable_queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


#: These rank any numbers in ranges, which are stored, read for their sums and for their ranks, and joined.
RANGED = ("number_percentiles", "sorted_numbers", "threshold_sweep")


@pytest.mark.parametrize("name", RANGED)
def test_ranges_are_only_joined_with_their_sums(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for banned in ("Python", "Cartesian", "NestedLoop", "SortMergeJoin"):
        assert banned not in plan, banned
    assert plan.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in RANGED])
def test_no_python_workers_no_joins_and_one_scan(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for banned in ("Python", "Cartesian", "NestedLoop", "Join"):
        assert banned not in plan, banned
    assert plan.count("FileScan") == 1


@pytest.fixture(scope="module")
def stored(spark, events_schedule, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "schedule")
    events_schedule.write.parquet(path)
    return sc.read_parquet(spark, path)


def test_clock_texts_are_parsed_once(stored):
    stops = sc.with_stop_duration(sc.clean(stored))
    for df in (
        sc.valid_stops(stored),
        sc.valid_stops(stored).where("stop_duration_minutes > 10"),
        sc.classify(stored).where("row_class = 'valid'"),
        sc.cross_midnight(stops),
        sc.stop_duration_report(stored),
        sc.analysis(stored),
        sc.quality_breakdown(stored),
        sc.platform_peak(sc.valid_stops(stored)),
    ):
        assert _plan(df).count("RLIKE(") == 2


def test_filters_and_columns_reach_the_scan(stored, capsys):
    sc.stop_duration_report(stored).explain("formatted")
    pushed = capsys.readouterr().out.split("PushedFilters: [")[1].split("]")[0]
    for name in sc.SCHEDULE.names:
        assert f"IsNotNull({name})" in pushed
    assert "Not(EqualTo(train_no,Train No))" in pushed and "Not(EqualTo(arrival_time,NA))" in pushed
    # Only the columns a query needs are read.
    terminal = _plan(sc.terminal_profile(stored))
    assert "ReadSchema: struct<arrival_time:string,departure_time:string>" in terminal


def test_rows_are_reduced_before_the_first_shuffle(stored):
    for df in (
        sc.stop_duration_report(stored),
        sc.station_percentiles(sc.valid_stops(stored)),
        sc.analysis(stored),
        sc.sorted_durations(sc.valid_stops(stored)),
        sc.platform_peak(sc.valid_stops(stored)),
    ):
        # The plan prints from the result down, so the last exchange is the first to run.
        below = _plan(df).rsplit("Exchange", 1)[1]
        assert "HashAggregate" in below and "partial_" in below


def test_a_hot_station_is_merged_by_many_tasks(stored):
    plan = _plan(sc.station_percentiles(sc.valid_stops(stored)))
    first = plan.rsplit("Exchange", 1)[1]
    assert re.match(r" hashpartitioning\(station_name#\d+, stop_duration_minutes#\d+, ", first)


def test_sample_is_a_bounded_top_k(stored):
    plan = _plan(sc.duration_sample(sc.valid_stops(stored)))
    assert "TakeOrderedAndProject(limit=5" in plan


def test_observed_analysis_runs_one_scan(stored):
    observed = Observation()
    df = sc.analysis(stored, observation=observed)
    assert _final_plan(df).count("FileScan") == 1
    row = df.first()
    assert observed.get["total"] == row.total and observed.get["valid"] == row.valid


def test_analysis_runs_one_scan(stored):
    assert _final_plan(sc.analysis(stored)).count("FileScan") == 1
