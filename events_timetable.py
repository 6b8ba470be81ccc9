"""A timetable for queries and tests, derived from the ``events`` test table.

The public timetable file is not available, so the checks run on this
stand-in: one stop per event, with bad rows of every kind planted by
``event_id`` (FIXTURES.md, section 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.schema import MIDNIGHT, NOT_AVAILABLE, REPEATED_HEADER


def _clock(minute_of_day: Column) -> Column:
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(two(F.floor(minute_of_day / 60)), F.lit(":"), two(minute_of_day % 60), F.lit(":00"))


def schedule_from_events(events: DataFrame) -> DataFrame:
    """Minute-of-day arithmetic only, so no session time zone gets in."""
    every = lambda n: F.col("event_id") % n == 0
    minute = F.hour("ts") * 60 + F.minute("ts")
    arrival = _clock(F.col("arrival_minute"))
    departure = _clock(F.col("departure_minute"))
    no_text = F.lit(None).cast("string")
    minutes = events.select(
        "event_id",
        "user_id",
        "event_type",
        minute.alias("arrival_minute"),
        F.pmod(minute + F.floor("value"), F.lit(1440)).alias("departure_minute"),
    )
    columns = F.struct(
        F.when(every(103), REPEATED_HEADER)
        .when(every(137), no_text)
        .otherwise(F.col("user_id").cast("string"))
        .alias("train_no"),
        F.when(every(113), no_text).otherwise(F.col("event_type")).alias("station_name"),
        F.when(every(101), NOT_AVAILABLE)
        .when(every(107), MIDNIGHT)
        .when(every(131), no_text)
        .when(every(139), F.ltrim(arrival, F.lit("0")))
        .otherwise(arrival)
        .alias("arrival_time"),
        F.when(every(127), "99:99:99")
        .when(every(109), F.substring(departure, 1, 5))
        .when(every(149), MIDNIGHT)
        .otherwise(departure)
        .alias("departure_time"),
    )
    # Through inline() for the reason given in operators.durations: filters on
    # the texts must not make Spark build the texts again.
    return minutes.select(F.inline(F.array(columns)))
