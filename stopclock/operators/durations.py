"""From clean rows to stop durations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.functions import clock_to_seconds, is_valid_stop, stop_minutes
from stopclock.operators.cleaning import clean


def with_clock_seconds(schedule: DataFrame) -> DataFrame:
    return schedule.withColumns(
        {
            "arrival_seconds": clock_to_seconds(F.col("arrival_time")),
            "departure_seconds": clock_to_seconds(F.col("departure_time")),
        }
    )


def with_stop_duration(schedule: DataFrame) -> DataFrame:
    """Add the seconds of both times and ``stop_duration_minutes``.

    The three columns leave through a one-element ``inline``, which is a no-op
    for the data but a fence for the optimizer: a filter on a projected column
    is pushed below the projection by substituting its expression, so one test
    of the minutes would parse both clock texts some twenty times per row
    (measured: ten to twenty times slower). Above a generator it stays a test
    of a value that has been computed once, and the generator itself costs
    nothing measurable.
    """
    minutes = stop_minutes(F.col("arrival_seconds"), F.col("departure_seconds"))
    wide = with_clock_seconds(schedule).withColumn("stop_duration_minutes", minutes)
    derived = ["arrival_seconds", "departure_seconds", "stop_duration_minutes"]
    return wide.select(*schedule.columns, F.inline(F.array(F.struct(*derived))))


def valid_only(stops: DataFrame) -> DataFrame:
    return stops.where(is_valid_stop(F.col("stop_duration_minutes")))


def cross_midnight(stops: DataFrame) -> DataFrame:
    return stops.where(F.col("departure_seconds") < F.col("arrival_seconds"))


def valid_stops(schedule: DataFrame) -> DataFrame:
    """Raw timetable rows to valid stops: what the statistics are taken over."""
    return valid_only(with_stop_duration(clean(schedule)))
