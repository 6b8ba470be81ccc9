"""Sorted output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.functions import fixed_point
from stopclock.operators.percentiles import duration_histogram, with_ranks

# Most rows one histogram entry expands to at a time: bounds the arrays built
# while expanding.
_CHUNK = 1_000_000


def sorted_durations(stops: DataFrame) -> DataFrame:
    """All non-NULL durations in ascending order, globally sorted.

    A counting sort: only the histogram is shuffled and sorted, in chunks, and
    every chunk is expanded where it lies. A chunk goes to the partition that
    the rank of its first row belongs to, and holds no more rows than a
    partition's share, so partitions stay even however frequent one duration
    is. A plain ``orderBy`` would move every row, and send all rows of one
    duration to a single task because equal keys cannot be split by range.
    Minutes must stand for whole seconds (see ``with_ranks``).
    """
    partitions = int(stops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    minutes = F.col("stop_duration_minutes")
    chunk = F.least(F.ceil(F.col("n") / partitions), F.lit(_CHUNK)).cast("bigint")
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("stops") - 1, chunk))
    rank = F.col("upto") - F.col("stops") + F.col("first")
    part = F.least(F.floor(rank * partitions / F.col("n")), F.lit(partitions - 1)).cast("int")
    size = F.least(F.col("stops") - F.col("first"), F.col("chunk")).cast("int")
    return (
        with_ranks(duration_histogram(stops).where(F.col("stops") > 0))
        .select(minutes, "stops", "upto", "n", chunk.alias("chunk"), first.alias("first"))
        .withColumn("part", part)
        .repartitionById(partitions, "part")
        .sortWithinPartitions("stop_duration_minutes", "first")
        .select(F.explode(F.array_repeat(minutes, size)).alias("stop_duration_minutes"))
    )


def duration_sample(valid_stops: DataFrame, rows: int = 5) -> DataFrame:
    """The first few valid stops by train, station and times, as display text."""
    keys = ("train_no", "station_name", "arrival_time", "departure_time")
    return (
        valid_stops.orderBy(*keys)
        .limit(rows)
        .select(
            F.col("train_no").alias("train"),
            F.substring("station_name", 1, 15).alias("station"),
            F.col("arrival_time").alias("arrival"),
            F.col("departure_time").alias("departure"),
            fixed_point(F.col("stop_duration_minutes"), 1).alias("duration"),
        )
    )
