"""Clock-time expressions. All are plain ``Column`` builders, so they run in
generated JVM code next to the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopclock.schema import CLOCK_PATTERN, MAX_STOP_MINUTES, MIDNIGHT, SECONDS_PER_DAY


def clock_to_seconds(clock: Column) -> Column:
    """Seconds since midnight of an ``HH:MM:SS`` text, else NULL.

    ``00:00:00`` stands for "no time" at the ends of a route and gives NULL.
    The digits are not range checked: ``99:99:99`` is 362,439 seconds, and it
    is the duration filter that judges it later.
    """
    # Fixed positions, because the pattern has already been checked; cutting
    # by position costs a third of what split() does per row.
    part = lambda start: F.substring(clock, start, 2).try_cast("int")
    usable = clock.rlike(CLOCK_PATTERN) & (clock != MIDNIGHT)
    return F.when(usable, part(1) * 3600 + part(4) * 60 + part(7))


def stop_minutes(arrival: Column, departure: Column) -> Column:
    """Minutes from arrival to departure; an earlier departure is next day's."""
    same_day = F.when(departure >= arrival, departure - arrival)
    return same_day.when(departure < arrival, departure + SECONDS_PER_DAY - arrival) / 60.0


def is_valid_stop(minutes: Column) -> Column:
    """More than nothing, at most a day. NULL stays NULL."""
    return (minutes > 0) & (minutes <= MAX_STOP_MINUTES)
