"""Row filters that run before any time is parsed.

All four look at raw text only, so Spark evaluates them at the scan and pushes
the comparisons into the file reader.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.schema import MIN_TIME_LENGTH, NOT_AVAILABLE, REPEATED_HEADER, SOURCE_HEADERS


def _both_times(test) -> Column:
    return test(F.col("arrival_time")) & test(F.col("departure_time"))


def is_train_row() -> Column:
    """False for a repeated header line, NULL when the train number is NULL."""
    return F.col("train_no") != REPEATED_HEADER


def has_all_fields() -> Column:
    return reduce(Column.__and__, (F.col(name).isNotNull() for name in SOURCE_HEADERS))


def has_times() -> Column:
    return _both_times(lambda t: t != NOT_AVAILABLE)


def times_long_enough() -> Column:
    return _both_times(lambda t: F.length(t) >= MIN_TIME_LENGTH)


def drop_repeated_headers(schedule: DataFrame) -> DataFrame:
    """Rows with a NULL train number go too, and count as headers."""
    return schedule.where(is_train_row())


def drop_null_fields(schedule: DataFrame) -> DataFrame:
    return schedule.where(has_all_fields())


def drop_not_available(schedule: DataFrame) -> DataFrame:
    return schedule.where(has_times())


def drop_short_times(schedule: DataFrame) -> DataFrame:
    return schedule.where(times_long_enough())


def clean(schedule: DataFrame) -> DataFrame:
    """All of the above. A length test already fails on ``NA``; it stays for
    the sake of the reader filter it yields."""
    return schedule.where(is_train_row() & has_all_fields() & has_times() & times_long_enough())
