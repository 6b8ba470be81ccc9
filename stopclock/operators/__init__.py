from stopclock.operators.cleaning import (
    clean,
    drop_not_available,
    drop_null_fields,
    drop_repeated_headers,
    drop_short_times,
)
from stopclock.operators.durations import (
    cross_midnight,
    valid_only,
    valid_stops,
    with_clock_seconds,
    with_stop_duration,
)
from stopclock.operators.occupancy import platform_peak
from stopclock.operators.ordering import duration_sample, sorted_durations
from stopclock.operators.percentiles import (
    count_exceeding,
    duration_histogram,
    exact_percentiles,
    exceeding_counts,
    exceeding_share,
    percentile_table,
    percentile_values,
    station_exceeding_total,
    station_percentiles,
    threshold_counts,
)
from stopclock.operators.quality import (
    classify,
    observe_progress,
    quality_breakdown,
    quality_summary,
    station_overview,
    terminal_profile,
)
from stopclock.operators.ranking import number_percentiles, sorted_numbers, threshold_table

__all__ = [
    "classify",
    "clean",
    "count_exceeding",
    "cross_midnight",
    "drop_not_available",
    "drop_null_fields",
    "drop_repeated_headers",
    "drop_short_times",
    "duration_histogram",
    "duration_sample",
    "exact_percentiles",
    "exceeding_counts",
    "exceeding_share",
    "number_percentiles",
    "observe_progress",
    "percentile_table",
    "percentile_values",
    "platform_peak",
    "quality_breakdown",
    "quality_summary",
    "sorted_durations",
    "sorted_numbers",
    "station_exceeding_total",
    "station_overview",
    "station_percentiles",
    "terminal_profile",
    "threshold_counts",
    "threshold_table",
    "valid_only",
    "valid_stops",
    "with_clock_seconds",
    "with_stop_duration",
]
