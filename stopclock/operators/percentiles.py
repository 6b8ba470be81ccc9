"""Exact percentiles of the stop duration, and how many stops exceed them.

Everything here works on a histogram, never on sorted rows. A duration is a
difference of two whole seconds below 362,440, so a group has at most 86,400
distinct valid durations (some 800,000 with the invalid ones) whether it holds
a thousand stops or a trillion. The histogram is built with partial
aggregation, so a station with a third of all rows sends no more over the
network than any other; running sums over it give ranks, values and exceeding
counts in one go, without a second pass over the data and without a join.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopclock.schema import PERCENTILES


def duration_histogram(stops: DataFrame, *by: str) -> DataFrame:
    """``by``, distinct duration, number of stops. NULL durations weigh 0."""
    return stops.groupBy(*by, "stop_duration_minutes").agg(
        F.count("stop_duration_minutes").alias("stops")
    )


def with_ranks(histogram: DataFrame, *by: str) -> DataFrame:
    """Add ``upto`` (stops not longer than this) and ``n`` (stops in the group).

    One task per group, and without ``by`` one task in all. It sorts histogram
    entries, never rows. Their number is bounded by the distinct durations, so
    minutes must stand for whole seconds, as those of ``with_stop_duration`` do.
    """
    ascending = Window.partitionBy(*by).orderBy("stop_duration_minutes")
    stops = F.sum("stops")
    return histogram.withColumns(
        {
            "upto": stops.over(ascending.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "n": stops.over(
                ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        }
    )


def _requested(percentiles: Sequence[float]) -> Column:
    wanted = [float(p) for p in percentiles]
    if not wanted or not all(0.0 <= p <= 100.0 for p in wanted):
        raise ValueError("percentiles must be one or more numbers from 0 to 100")
    return F.array(
        *(F.struct(F.lit(p).alias("percentile"), F.lit(p / 100.0).alias("share")) for p in wanted)
    )


def _position(request: Column, n: Column) -> Column:
    """0-based, usually fractional rank of a percentile among ``n`` values."""
    return request["share"] * (n - 1)


def _covers(request: Column, n: Column, first: Column, upto: Column) -> Column:
    """Do the ranks ``first .. upto - 1`` include one the percentile needs?"""
    below = F.floor(_position(request, n))
    above = F.least(below + 1, n - 1)
    return (first <= above) & (upto > below)


def needed_cells(percentiles: Sequence[float]) -> Column:
    """Aggregate: the ranked histogram rows that decide the percentiles.

    At most two per percentile, so the list stays tiny for any input.
    """
    first, upto, n = F.col("upto") - F.col("stops"), F.col("upto"), F.col("n")
    needed = F.exists(_requested(percentiles), lambda p: _covers(p, n, first, upto))
    cell = F.struct(F.col("stop_duration_minutes").alias("minutes"), "upto", first.alias("first"))
    return F.collect_list(F.when(needed, cell))


def results_from_cells(percentiles: Sequence[float], cells: Column, n: Column) -> Column:
    """Array of (percentile, value, exceeding_count), NULL when there are no stops."""

    def bracket(p: Column) -> Column:
        own = F.filter(cells, lambda c: _covers(p, n, c["first"], c["upto"]))
        position = _position(p, n)
        return F.struct(
            p["percentile"].alias("percentile"),
            (position - F.floor(position)).alias("weight"),
            F.array_min(own).alias("low"),
            F.array_max(own).alias("high"),
        )

    def interpolate(b: Column) -> Column:
        low, high = b["low"]["minutes"], b["high"]["minutes"]
        return F.struct(
            b["percentile"].alias("percentile"),
            (low + b["weight"] * (high - low)).alias("value"),
            b["low"].alias("low"),
            b["high"].alias("high"),
        )

    def count_exceeding(v: Column) -> Column:
        # No duration lies between low and high, so the unrounded value splits
        # the stops either after low or after high.
        reached = F.when(v["value"] >= v["high"]["minutes"], v["high"]["upto"])
        return F.struct(
            v["percentile"].alias("percentile"),
            v["value"].alias("value"),
            (n - reached.otherwise(v["low"]["upto"])).alias("exceeding_count"),
        )

    steps = F.transform(F.transform(_requested(percentiles), bracket), interpolate)
    return F.when(n > 0, F.transform(steps, count_exceeding))


def percentile_table(
    stops: DataFrame, percentiles: Sequence[float] = PERCENTILES, by: Sequence[str] = ()
) -> DataFrame:
    """``by``, valid, percentile, value, exceeding_count; in requested order per group.

    ``value`` is linearly interpolated between the two nearest ranks and not
    rounded; a stop exceeds it only if strictly longer. A group without valid
    stops gives no rows. ``stop_duration_minutes`` must stand for whole seconds
    (at most 86,400 valid values, see ``with_ranks``); minutes of arbitrary
    precision give right results, but a histogram as long as the data.
    """
    ranked = with_ranks(duration_histogram(stops, *by), *by)
    grouped = ranked.groupBy(*by).agg(
        F.max("n").alias("valid"), needed_cells(percentiles).alias("cells")
    )
    return grouped.select(
        *by, "valid", F.inline(results_from_cells(percentiles, F.col("cells"), F.col("valid")))
    )


def exact_percentiles(stops: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    return percentile_table(stops, percentiles).select("percentile", "value")


def exceeding_counts(stops: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    return percentile_table(stops, percentiles).select("percentile", "exceeding_count")


def exceeding_share(stops: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Exceeding stops in percent of all valid stops."""
    return percentile_table(stops, percentiles).select(
        "percentile", (F.col("exceeding_count") / F.col("valid") * 100).alias("share_pct")
    )


def station_percentiles(stops: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    return percentile_table(stops, percentiles, by=["station_name"]).select(
        "station_name", "percentile", "value"
    )


def station_exceeding_total(
    stops: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """Stops longer than their own station's percentile, over all stations."""
    requests = Counter(float(p) for p in percentiles)
    per_station = percentile_table(stops, list(requests), by=["station_name"])
    totals = per_station.groupBy("percentile").agg(
        F.sum("exceeding_count").alias("exceeding_count")
    )
    if max(requests.values()) == 1:
        return totals
    times = F.create_map(*(F.lit(x) for request in requests.items() for x in request))
    row = F.struct("percentile", "exceeding_count")
    return totals.select(F.inline(F.array_repeat(row, times[F.col("percentile")])))


def threshold_counts(stops: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """(value, exceeding_count) for given minutes: one pass for all of them."""
    values = [float(v) for v in thresholds]
    if not values:
        raise ValueError("thresholds must be one or more numbers of minutes")
    longer = [
        F.count_if(F.col("stop_duration_minutes") > v).alias(f"t{i}") for i, v in enumerate(values)
    ]
    cells = [
        F.struct(F.lit(v).alias("value"), F.col(f"t{i}").alias("exceeding_count"))
        for i, v in enumerate(values)
    ]
    return stops.agg(*longer).select(F.inline(F.array(*cells)))


def percentile_values(
    stops: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> dict[float, float]:
    """The percentiles as Python numbers; one small row each reaches the driver."""
    values = {r.percentile: r.value for r in exact_percentiles(stops, percentiles).collect()}
    if not values:
        warnings.warn("no stop durations to take percentiles of", stacklevel=2)
    return values


def count_exceeding(stops: DataFrame, minutes: float) -> int:
    return threshold_counts(stops, [minutes]).first().exceeding_count
