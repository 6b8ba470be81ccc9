"""Counts, progress figures and platform occupancy."""

import random

from pyspark.sql import Observation

import stopclock as sc


def test_summary_and_breakdown_add_up(events_schedule):
    summary = sc.quality_summary(events_schedule).first()
    assert tuple(summary)[:5] == (10_000, 170, 355, 525, 9_023)
    assert round(summary.retention_rate, 6) == 90.23
    breakdown = {r["class"]: r.rows for r in sc.quality_breakdown(events_schedule).collect()}
    assert sum(breakdown.values()) == summary.total
    assert breakdown["repeated_header"] + breakdown["null_train"] == summary.header_removed
    assert breakdown["valid"] + breakdown["valid_cross_midnight"] == summary.valid
    assert sc.clean(events_schedule).count() == summary.total - summary.bad_rows


def test_analysis_repeats_the_summary(events_schedule):
    both = sc.analysis(events_schedule).first().asDict()
    both.pop("results")
    assert both == sc.quality_summary(events_schedule).first().asDict()


def test_empty_table(make_schedule):
    empty = make_schedule([])
    assert tuple(sc.quality_summary(empty).first()) == (0, 0, 0, 0, 0, 0.0)
    assert sc.quality_breakdown(empty).collect() == []
    assert sc.analysis(empty).first().results == []
    assert tuple(sc.terminal_profile(empty).first()) == (0, 0)


def test_progress_figures_ride_on_the_main_job(events_schedule):
    seen = Observation("progress")
    progress = sc.observe_progress(events_schedule, seen)
    stops = progress.where("row_class like 'valid%'")
    assert stops.count() == 9_023
    assert seen.get == {
        "total": 10_000,
        "header_removed": 170,
        "corrupt_removed": 355,
        "bad_rows": 525,
        "valid": 9_023,
    }


def test_terminals_and_stations(make_schedule):
    schedule = make_schedule(
        [
            ("1", "A", "00:00:00", "06:00:00"),
            ("1", "B", "07:00:00", "00:00:00"),
            ("2", "C", "07:00:00", "07:04:00"),
            ("2", None, "07:00:00", "07:30:00"),
            ("2", "C", "23:59:00", "00:01:00"),
            ("Train No", "Station Name", "Arrival time", "Departure Time"),
        ]
    )
    assert tuple(sc.terminal_profile(schedule).first()) == (1, 1)
    assert tuple(sc.station_overview(schedule).first()) == (3, 2.0, 4.0)


def _clock(second):
    return f"{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


def test_platform_peak_against_counting_every_second(make_schedule):
    rng = random.Random(5)
    rows, present = [], {}
    for n in range(300):
        station = rng.choice("ABC")
        arrival = rng.randint(1, 2_000) if n % 3 else 86_400 - rng.randint(1, 900)
        length = rng.randint(1, 1_500)
        departure = arrival + length
        # Past midnight either wrapped or written as hour 24 and later.
        shown = departure % 86_400 if n % 2 else departure
        if shown % 86_400 == 0:
            continue
        rows.append((str(n), station, _clock(arrival), _clock(shown)))
        seconds = present.setdefault(station, {})
        for s in range(arrival, departure):
            seconds[s % 86_400] = seconds.get(s % 86_400, 0) + 1
    got = {r.station_name: r.peak for r in sc.platform_peak(sc.valid_stops(make_schedule(rows))).collect()}
    assert got == {station: max(seconds.values()) for station, seconds in present.items()}


def test_platform_peak_edges(make_schedule):
    schedule = make_schedule(
        [
            # Leaving and arriving in the same second do not overlap.
            ("1", "A", "10:00:00", "10:05:00"),
            ("2", "A", "10:05:00", "10:10:00"),
            # A stop of exactly one day is there all day.
            ("3", "B", "10:00:00", "34:00:00"),
            ("4", "B", "03:00:00", "03:01:00"),
            # Not valid, so never present.
            ("5", "C", "10:00:00", "10:00:00"),
            # Both stand there at midnight.
            ("6", "D", "23:50:00", "00:10:00"),
            ("7", "D", "23:58:00", "00:02:00"),
        ]
    )
    got = {r.station_name: r.peak for r in sc.platform_peak(sc.valid_stops(schedule)).collect()}
    assert got == {"A": 1, "B": 2, "D": 2}
