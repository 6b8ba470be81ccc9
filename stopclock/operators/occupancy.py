"""How many trains stand in a station at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopclock.schema import SECONDS_PER_DAY


def occupancy_steps(valid_stops: DataFrame) -> DataFrame:
    """Net change of trains present per station and second of day.

    A train is present from its arrival up to, not including, its departure. A
    stop over midnight is present from the start of the day as well. Clock
    values past 24 h are folded into the day. The sums are formed before the
    shuffle, so a station has at most 86,400 rows however busy it is.
    """
    of_day = lambda c: F.pmod(F.col(c), F.lit(SECONDS_PER_DAY)).alias(c)
    step = lambda second, change: F.struct(
        second.alias("second"), F.lit(change).alias("change")
    )
    arrival, departure = F.col("arrival_seconds"), F.col("departure_seconds")
    same_day = F.array(step(arrival, 1), step(departure, -1))
    over_night = F.array(step(F.lit(0), 1), step(arrival, 1), step(departure, -1))
    return (
        valid_stops.select("station_name", of_day("arrival_seconds"), of_day("departure_seconds"))
        .select("station_name", F.inline(F.when(departure > arrival, same_day).otherwise(over_night)))
        .groupBy("station_name", "second")
        .agg(F.sum("change").alias("change"))
    )


def platform_peak(valid_stops: DataFrame) -> DataFrame:
    """Most trains present at any moment of the day, per station."""
    over_day = Window.partitionBy("station_name").orderBy("second")
    present = F.sum("change").over(
        over_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        occupancy_steps(valid_stops)
        .withColumn("present", present)
        .groupBy("station_name")
        .agg(F.max("present").alias("peak"))
    )
