"""Ranks among any numbers, with no bound on how many different ones there are.

Whole seconds make a histogram that one task can hold (see ``percentiles``). Other numbers may
all be different. So the histogram itself is cut into ranges of values: equal numbers are
counted before anything is cut, so no number is too frequent for a range, and ranges hold about
equally many different numbers. What a range holds in all, summed up over the ranges before it,
is the rank at which it begins; within it ranks are running sums. Each range is sorted by one
task, and only a row per range passes through a single one.

The ranged histogram is written to ``spark.checkpoint.dir``: a cut is drawn from a sample, and must be
the same for the sums and for the ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopclock.operators.percentiles import needed_cells, results_from_cells
from stopclock.schema import PERCENTILES
from stopclock.sources.folders import stored

#: Most rows that one entry expands to at a time.
_CHUNK = 1_000_000


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_histogram(df: DataFrame, column: str | Column) -> DataFrame:
    """``number`` (double) and ``times``. NULL and NaN are left out; -0.0 is 0.0."""
    number = F.col(f"`{column}`") if isinstance(column, str) else column
    # Adding zero makes one zero of both.
    numbers = df.select((number.cast("double") + F.lit(0.0)).alias("number"))
    return numbers.where(F.col("number").isNotNull() & ~F.isnan("number")).groupBy("number").agg(F.count(F.lit(1)).alias("times"))


def with_range_ranks(histogram: DataFrame, *order: str) -> DataFrame:
    """Add ``upto`` (the sum of ``times`` up to this entry) and ``n`` (all of it) to any histogram.

    Entries are ordered by ``order``, ``number`` unless told otherwise, and must differ in it.
    """
    order = order or ("number",)
    ranges = histogram.repartitionByRange(_partitions(histogram), *order).withColumn("part", F.spark_partition_id())
    ranges = stored(ranges)
    # One row for each partition meets in one task.
    sums = ranges.groupBy("part").agg(F.sum("times").alias("own"))
    in_order = Window.orderBy("part")
    sums = sums.select(
        F.col("part").alias("of"),
        F.coalesce(F.sum("own").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("own").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
    )
    running = F.sum("times").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = ranges.withColumn("running", running).join(F.broadcast(sums), F.col("part") == F.col("of"))
    return ranked.select(*histogram.columns, (F.col("before") + F.col("running")).alias("upto"), "n")


def number_percentiles(df: DataFrame, column: str | Column, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """``percentile``, ``value``, ``exceeding_count`` of any numbers, by the rule of ``percentile_table``."""
    ranked = with_range_ranks(number_histogram(df, column)).withColumnsRenamed({"number": "stop_duration_minutes", "times": "stops"})
    cells = ranked.agg(F.max("n").alias("valid"), needed_cells(percentiles).alias("cells"))
    return cells.select(F.inline(results_from_cells(percentiles, F.col("cells"), F.col("valid"))))


def sorted_numbers(df: DataFrame, column: str | Column, name: str = "number") -> DataFrame:
    """All numbers in ascending order, globally sorted, in even partitions.

    An entry's ranks decide which partitions its rows go to, so the rows of one frequent number
    lie in as many neighbouring partitions as they fill, and all partitions hold equally many
    rows. Histogram entries are moved, not rows.
    """
    partitions = _partitions(df)
    # Of the rows from rank a to before rank b, partition p has those from ceil(p * n / partitions) on.
    entry = with_range_ranks(number_histogram(df, column)).selectExpr("number", "n", "upto - times AS a", "upto AS b")
    share = entry.selectExpr("*", f"explode(sequence(a * {partitions} div n, (b - 1) * {partitions} div n)) AS part")
    start = lambda p: f"(({p}) * n + {partitions - 1}) div {partitions}"
    share = share.selectExpr("number", "part", f"greatest(a, {start('part')}) AS a", f"least(b, {start('part + 1')}) AS b")
    chunk = share.selectExpr("number", "part", "b", f"explode(sequence(a, b - 1, {_CHUNK}L)) AS a")
    return (
        chunk.withColumn("part", F.col("part").cast("int"))
        .repartitionById(partitions, "part")
        .sortWithinPartitions("number", "a")
        .select(F.explode(F.array_repeat("number", F.least(F.col("b") - F.col("a"), F.lit(_CHUNK)).cast("int"))).alias(name))
    )


def threshold_table(df: DataFrame, column: str | Column, thresholds: DataFrame, threshold: str = "value") -> DataFrame:
    """``threshold`` and ``exceeding_count`` (numbers strictly above it) for each row of ``thresholds``.

    Thresholds take their place among the numbers as entries that count nothing, behind equal
    ones; what is not up to there exceeds them. The plan is the same for any number of
    thresholds, and no row is compared with more than its neighbours. A NULL or NaN
    threshold is exceeded by nothing.
    """
    wanted = thresholds.select((F.col(f"`{threshold}`").cast("double") + F.lit(0.0)).alias("number"))
    wanted = wanted.groupBy("number").agg(F.count(F.lit(1)).alias("asked"))
    none = F.col("number").isNull() | F.isnan("number")
    nothing = F.lit(0).cast("bigint")
    entries = number_histogram(df, column).withColumns({"kind": F.lit(0), "asked": nothing})
    entries = entries.unionByName(wanted.where(~F.coalesce(none, F.lit(True))).withColumns({"kind": F.lit(1), "times": nothing}))
    ranked = with_range_ranks(entries, "number", "kind").where("kind = 1")
    found = ranked.select("number", "asked", (F.col("n") - F.col("upto")).alias("exceeding_count"))
    found = found.unionByName(wanted.where(none).withColumn("exceeding_count", nothing))
    row = F.struct(F.col("number").alias(threshold), "exceeding_count")
    return found.select(F.explode(F.array_repeat(row, F.col("asked").cast("int"))).alias("row")).select("row.*")
