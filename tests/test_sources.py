"""CSV reading, schema checks, writing, and the run from path to report."""

import csv
import re
from datetime import datetime

import pytest

import stopclock as sc

HEADER = ["Train No", "Station Name", "Arrival time", "Departure Time", "Distance"]


def _write_csv(path, rows, header=HEADER):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_round_trip(spark, events_schedule, tmp_path, multi_line):
    rows = _rows(events_schedule)
    for part in range(2):
        _write_csv(tmp_path / f"{part}.csv", [[*("" if v is None else v for v in r), "7"] for r in rows[part::2]])
    assert _rows(sc.read_csv(spark, str(tmp_path), multi_line)) == rows


def test_csv_is_read_by_header_name(spark, tmp_path):
    path = _write_csv(tmp_path / "t.csv", [["9", "10:05:00", "A", "10:00:00", "1"]], ["Distance", "Departure Time", "Station Name", "Arrival time", "Train No"])
    assert _rows(sc.read_csv(spark, path)) == [("1", "A", "10:00:00", "10:05:00")]


def test_short_long_and_multi_line_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "Train No,Station Name,Arrival time,Departure Time\n"
        "8,A,10:00:00\n"
        "13,A,10:00:00,10:05:00,extra\n"
        '7,"A\nB",10:00:00,10:05:00\n'
    )
    assert _rows(sc.read_csv(spark, str(path), multi_line=True)) == [
        ("13", "A", "10:00:00", "10:05:00"),
        ("7", "A\nB", "10:00:00", "10:05:00"),
        ("8", "A", "10:00:00", None),
    ]
    # Line by line the broken row falls apart. The job says so, unless told to take it as bad rows.
    with pytest.raises(Exception, match="multi_line=True"):
        sc.quality_summary(sc.read_csv(spark, str(path))).collect()
    with pytest.raises(Exception, match="multi_line=True"):
        sc.read_csv(spark, str(path)).count()
    with pytest.raises(Exception, match="multi_line=True"):
        sc.terminal_profile(sc.read_csv(spark, str(path))).collect()
    assert sc.quality_summary(sc.read_csv(spark, str(path), open_quotes="keep")).first().valid == 1


def test_closed_quotes_and_short_rows_are_no_open_quotes(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('Train No,Station Name,Arrival time,Departure Time\n8,"A, B"\n9,"A ""x""",10:00:00,10:05:00\n')
    assert sc.read_csv(spark, str(path)).count() == 2


def test_files_with_different_column_order(spark, tmp_path):
    names = ["Distance", "Departure Time", "Station Name", "Arrival time", "Train No"]
    _write_csv(tmp_path / "a.csv", [["1", "A", "10:00:00", "10:05:00", "7"]])
    _write_csv(tmp_path / "b.csv", [["9", "11:05:00", "B", "11:00:00", "2"]], names)
    _write_csv(tmp_path / "c.csv", [["C", "3", "12:00:00", "12:05:00"]], ["Station Name", "Train No", "Arrival time", "Departure Time"])
    (tmp_path / "d.csv").write_text("")
    expected = [("1", "A", "10:00:00", "10:05:00"), ("2", "B", "11:00:00", "11:05:00"), ("3", "C", "12:00:00", "12:05:00")]
    for multi_line in (False, True):
        assert _rows(sc.read_csv(spark, str(tmp_path), multi_line)) == expected
        assert _rows(sc.read_csv(spark, [str(tmp_path / f"{x}.csv") for x in "bac"], multi_line)) == expected
    minutes = sc.valid_stops(sc.read_csv(spark, str(tmp_path))).select("stop_duration_minutes").collect()
    assert [r[0] for r in minutes] == [5.0] * 3


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_file_without_a_column_is_refused_wherever_it_is(spark, tmp_path, at):
    for k in range(3):
        header = ["Train No", "Station Name", "Arrival time", "Departure" if k == at else "Departure Time"]
        _write_csv(tmp_path / f"{k}.csv", [["1", "A", "10:00:00", "10:05:00"]], header)
    with pytest.raises(sc.SchemaError, match="'Departure Time': missing"):
        sc.read_csv(spark, str(tmp_path))


def test_line_wise_reading_splits_a_file_and_multi_line_does_not(spark, tmp_path):
    path = _write_csv(tmp_path / "t.csv", [["1", "A", "10:00:00", "10:05:00", "x" * 50]] * 4000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        plain, multi = sc.read_csv(spark, path), sc.read_csv(spark, path, True)
        assert plain.rdd.getNumPartitions() > 1 == multi.rdd.getNumPartitions()
        assert plain.count() == multi.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_parquet_with_either_kind_of_names(spark, events_schedule, tmp_path):
    ours, theirs = str(tmp_path / "ours"), str(tmp_path / "theirs")
    events_schedule.write.parquet(ours)
    events_schedule.toDF(*HEADER[:4]).write.parquet(theirs)
    assert _rows(sc.read_parquet(spark, ours)) == _rows(sc.read_parquet(spark, theirs)) == _rows(events_schedule)


def test_schema_is_checked_before_any_job(spark):
    with pytest.raises(sc.SchemaError, match="'Arrival time': missing.*'Departure Time': expected string, found int"):
        sc.as_schedule(spark.createDataFrame([], "`Train No` string, `Station Name` string, `Departure Time` int"))
    with pytest.raises(sc.SchemaError, match="more than once"):
        sc.as_schedule(spark.createDataFrame([], "train_no string, `Train No` string, station_name string, arrival_time string, departure_time string"))


def test_run_from_csv_to_report(spark, tmp_path):
    rows = [[str(n), "A", "10:00:00", f"10:{n % 60:02d}:00", ""] for n in range(2_000)]
    rows += [HEADER, ["1", "A", "NA", "10:00:00", ""]]
    path = _write_csv(tmp_path / "t.csv", rows)
    report, table = str(tmp_path / "report"), str(tmp_path / "table")
    told = []
    result = sc.run(spark, path, report_path=report, result_path=table, progress=told.append)
    assert told[0] == {"total": 2_002, "header_removed": 1, "corrupt_removed": 1, "bad_rows": 2, "valid": 1_966}
    assert list(told[1]) == [f"exceeding {p}" for p in sc.PERCENTILES]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", result.timestamp)
    assert (result.total_records, result.bad_rows_filtered) == (2_002, 2)
    assert result.valid_durations == 2_000 - 34
    assert result.retention_rate == 1966 / 2002 * 100
    assert [p.percentile for p in result.percentile_results] == list(sc.PERCENTILES)
    lines = [r.value for r in spark.read.text(report).collect()]
    time_line, blank, *lines = lines
    assert re.fullmatch(r"\*\*Analysis Timestamp:\*\* \d{4}-\d\d-\d\d \d\d:\d\d:\d\d", time_line)
    assert blank == ""
    assert lines[:7] == [
        "| Metric | Value |",
        "|--------|-------|",
        "| **Total Records** | 2,002 |",
        "| **Valid Stop Durations** | 1,966 |",
        "| **Bad Rows Handled** | 2 |",
        "| **Data Retention Rate** | 98.2% |",
        "",
    ]
    assert lines[9:] == [f"| {p.percentile}th | {p.value:.3f} | {p.exceeding_count:,} |" for p in result.percentile_results]
    stored = spark.read.parquet(table).orderBy("percentile").collect()
    assert [tuple(r) for r in stored] == [(p.percentile, p.value, p.exceeding_count) for p in result.percentile_results]
    # An output that exists is refused before the input is even looked for, and nothing is written.
    new = str(tmp_path / "new")
    with pytest.raises(FileExistsError, match="already exists"):
        sc.run(spark, str(tmp_path / "no such file"), report_path=new, result_path=table)
    assert not (tmp_path / "new").exists()
    sc.run(spark, path, report_path=report, result_path=table, mode="overwrite")
    with pytest.raises(ValueError):
        sc.run(spark, path, report_path=new, result_path=new)


def test_run_on_a_file_without_valid_rows(spark, tmp_path):
    path = _write_csv(tmp_path / "t.csv", [HEADER])
    result = sc.run(spark, path)
    assert (result.percentile_results, result.total_records, result.retention_rate) == ([], 1, 0.0)


def test_timed_path():
    assert sc.timed_path("out/report", datetime(2025, 7, 20, 10, 38, 41)) == "out/report_20250720_103841"
