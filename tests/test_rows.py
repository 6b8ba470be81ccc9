"""Row-level behaviour: cleaning, clock parsing, durations, classes."""

import pytest
from pyspark.sql import functions as F

import stopclock as sc
from stopclock.functions import fixed_point

# train, station, arrival, departure, class, minutes (None where not parsed)
EDGE_ROWS = [
    ("1", "A", "11:06:00", "11:08:00", "valid", 2.0),
    ("2", "A", "00:00:00", "06:15:00", "terminal", None),
    ("14", "A", "23:50:00", "00:00:00", "terminal", None),
    ("3", "A", "23:55:00", "00:10:00", "valid_cross_midnight", 15.0),
    ("16", "A", "23:45:00", "00:15:00", "valid_cross_midnight", 30.0),
    ("Train No", "Station Name", "Arrival time", "Departure Time", "repeated_header", None),
    (None, "A", "10:00:00", "10:05:00", "null_train", 5.0),
    ("12", None, "10:00:00", "10:05:00", "null_field", 5.0),
    ("8", "A", "10:00:00", None, "null_field", None),
    ("4", "A", "NA", "10:05:00", "not_available", None),
    ("17", "A", "10:00:00", "10:05", "short_time", None),
    ("5", "A", "1:02:03", "01:05:00", "bad_format", None),
    ("11", "A", " 10:00:00", "10:05:00", "bad_format", None),
    ("18", "A", "10:00:00", "+1:05:00", "bad_format", None),
    ("19", "A", "10:00:00", "garbage", "bad_format", None),
    ("20", "A", "10-00-00", "10:05:00", "bad_format", None),
    ("6", "A", "99:99:99", "10:00:00", "negative", -4000.65),
    ("10", "A", "10:00:00", "99:00:00", "over_24h", 5340.0),
    ("9", "A", "10:00:00", "10:00:00", "zero", 0.0),
    ("13", "A", "10:00:00", "10:05:00", "valid", 5.0),
    ("7", "A", "10:00:00\n", "10:05:00", "valid", 5.0),
    ("15", "A", "10:00:00", "34:00:00", "valid", 1440.0),
    ("21", "A", "10:00:00", "34:00:01", "over_24h", 1440 + 1 / 60),
]
BAD = ("repeated_header", "null_train", "null_field", "not_available", "short_time")


@pytest.fixture(scope="module")
def edge(make_schedule):
    return make_schedule([r[:4] for r in EDGE_ROWS])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_row_gets_its_class_and_minutes(edge):
    got = {tuple(r)[:4]: (r.row_class, r.stop_duration_minutes) for r in sc.classify(edge).collect()}
    assert got == {r[:4]: (r[4], pytest.approx(r[5]) if r[5] is not None else None) for r in EDGE_ROWS}


def test_clean_keeps_exactly_the_rows_not_called_bad(edge):
    assert _rows(sc.clean(edge)) == sorted((r[:4] for r in EDGE_ROWS if r[4] not in BAD), key=str)


def test_single_filters(edge):
    rows = [r[:4] for r in EDGE_ROWS]
    both = lambda test: [r for r in rows if all(t is not None and test(t) for t in r[2:])]
    expected = {
        sc.drop_repeated_headers: [r for r in rows if r[0] not in (None, "Train No")],
        sc.drop_null_fields: [r for r in rows if None not in r],
        sc.drop_not_available: both(lambda t: t != "NA"),
        sc.drop_short_times: both(lambda t: len(t) >= 7),
    }
    for operator, kept in expected.items():
        assert _rows(operator(edge)) == sorted(kept, key=str), operator.__name__


def test_valid_stops_are_those_of_the_valid_classes(edge):
    expected = sorted(r[5] for r in EDGE_ROWS if r[4].startswith("valid"))
    got = sorted(r.stop_duration_minutes for r in sc.valid_stops(edge).collect())
    assert got == pytest.approx(expected)


def test_with_stop_duration_keeps_columns_and_rows(edge):
    stops = sc.with_stop_duration(edge)
    assert stops.columns == [
        *edge.columns,
        "arrival_seconds",
        "departure_seconds",
        "stop_duration_minutes",
    ]
    assert stops.count() == len(EDGE_ROWS)
    assert dict(stops.dtypes)["arrival_seconds"] == "int"


def test_clock_is_not_range_checked(make_schedule):
    row = sc.with_clock_seconds(make_schedule([("1", "A", "99:99:99", "00:00:01")])).first()
    assert (row.arrival_seconds, row.departure_seconds) == (362_439, 1)


def test_every_second_of_the_day_parses(spark):
    seconds = spark.range(1, 86_400).select(
        F.col("id"), F.date_format(F.timestamp_seconds(F.col("id") - 19_800), "HH:mm:ss").alias("t")
    )
    from stopclock.functions import clock_to_seconds

    # 19,800 s is the offset of the session zone, so the text is the id's clock.
    assert seconds.where(~clock_to_seconds(F.col("t")).eqNullSafe(F.col("id"))).count() == 0


def test_fixed_point_rounds_like_c(spark):
    rows = spark.range(1, 86_401).select(
        F.col("id"), fixed_point(F.col("id") / 60.0, 1).alias("a"), fixed_point(F.col("id") / 7.0, 3).alias("b")
    )
    for r in rows.collect():
        assert (r.a, r.b) == (f"{r.id / 60:.1f}", f"{r.id / 7:.3f}")


def test_sample_is_deterministic_and_cut(make_schedule):
    rows = [(str(n), "A very long station name", "10:00:00", f"10:0{n}:15") for n in range(9, 0, -1)]
    sample = sc.duration_sample(sc.valid_stops(make_schedule(rows)))
    got = [tuple(r) for r in sample.collect()]
    assert got[0] == ("1", "A very long sta", "10:00:00", "10:01:15", "1.2")
    assert [g[0] for g in got] == ["1", "2", "3", "4", "5"]
