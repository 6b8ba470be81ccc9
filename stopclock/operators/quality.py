"""Where every input row went, counted in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stopclock.functions import is_valid_stop
from stopclock.operators import cleaning
from stopclock.operators.durations import with_stop_duration
from stopclock.schema import MAX_STOP_MINUTES, MIDNIGHT, REPEATED_HEADER

# First match wins, in this order.
HEADER_CLASSES = ("repeated_header", "null_train")
CORRUPT_CLASSES = ("null_field", "not_available", "short_time")
UNUSABLE_CLASSES = ("terminal", "bad_format", "zero", "negative", "over_24h")
VALID_CLASSES = ("valid_cross_midnight", "valid")


def row_class() -> Column:
    """The one class of a row of ``with_stop_duration``."""
    train, arrival, departure = (
        F.col(c) for c in ("train_no", "arrival_seconds", "departure_seconds")
    )
    minutes = F.col("stop_duration_minutes")
    at_midnight = (F.col("arrival_time") == MIDNIGHT) | (F.col("departure_time") == MIDNIGHT)
    return (
        F.when(train == REPEATED_HEADER, "repeated_header")
        .when(train.isNull(), "null_train")
        .when(~cleaning.has_all_fields(), "null_field")
        .when(~cleaning.has_times(), "not_available")
        .when(~cleaning.times_long_enough(), "short_time")
        .when(at_midnight, "terminal")
        .when(minutes.isNull(), "bad_format")
        .when(minutes == 0, "zero")
        .when(minutes < 0, "negative")
        .when(minutes > MAX_STOP_MINUTES, "over_24h")
        .when(departure < arrival, "valid_cross_midnight")
        .otherwise("valid")
    )


def classify(schedule: DataFrame) -> DataFrame:
    return with_stop_duration(schedule).withColumn("row_class", row_class())


def summary_counts(rows: Column) -> list[Column]:
    """Aggregates over classified rows, each standing for ``rows`` input rows."""

    def total(*classes: str) -> Column:
        weight = F.when(F.col("row_class").isin(*classes), rows) if classes else rows
        return F.coalesce(F.sum(weight), F.lit(0).cast("bigint"))

    return [
        total().alias("total"),
        total(*HEADER_CLASSES).alias("header_removed"),
        total(*CORRUPT_CLASSES).alias("corrupt_removed"),
        total(*HEADER_CLASSES, *CORRUPT_CLASSES).alias("bad_rows"),
        total(*VALID_CLASSES).alias("valid"),
    ]


def retention_rate() -> Column:
    kept = F.col("valid") / F.col("total") * 100
    return F.when(F.col("total") > 0, kept).otherwise(0.0)


def quality_summary(schedule: DataFrame) -> DataFrame:
    counts = classify(schedule).agg(*summary_counts(F.lit(1)))
    return counts.withColumn("retention_rate", retention_rate())


def quality_breakdown(schedule: DataFrame) -> DataFrame:
    counts = classify(schedule).groupBy(F.col("row_class").alias("class"))
    return counts.agg(F.count(F.lit(1)).alias("rows"))


def terminal_profile(schedule: DataFrame) -> DataFrame:
    """How often ``00:00:00`` stands for arrival and for departure."""
    return schedule.agg(
        F.count_if(F.col("arrival_time") == MIDNIGHT).alias("arrival_midnight"),
        F.count_if(F.col("departure_time") == MIDNIGHT).alias("departure_midnight"),
    )


def valid_class_minutes() -> Column:
    """The minutes of a classified row, NULL unless the row is valid."""
    return F.when(F.col("row_class").isin(*VALID_CLASSES), F.col("stop_duration_minutes"))


def station_overview(schedule: DataFrame) -> DataFrame:
    """Distinct stations among train rows; shortest and longest valid stop.

    Validity is a condition on the minutes, not a filter, so a station whose
    stops are all unusable is still counted.
    """
    trains = with_stop_duration(cleaning.drop_repeated_headers(schedule))
    usable = cleaning.has_all_fields() & cleaning.has_times() & cleaning.times_long_enough()
    minutes = F.col("stop_duration_minutes")
    valid = F.when(usable & is_valid_stop(minutes), minutes)
    stops = trains.select("station_name", valid.alias("minutes"))
    return stops.agg(
        F.countDistinct("station_name").alias("stations"),
        F.min("minutes").alias("min_minutes"),
        F.max("minutes").alias("max_minutes"),
    )


def observe_progress(schedule: DataFrame, observation: Observation) -> DataFrame:
    """Classified rows that report the summary counts while another job runs.

    The figures ride on whatever action consumes the result, so they cost no
    extra scan. They are for watching: after a lost executor a recomputed
    partition may be counted twice, while ``quality_summary`` stays exact.
    """
    return classify(schedule).observe(observation, *summary_counts(F.lit(1)))
