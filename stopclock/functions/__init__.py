from stopclock.functions.clock import clock_to_seconds, is_valid_stop, stop_minutes
from stopclock.functions.text import fixed_point, percentile_label, run_time, with_commas

__all__ = [
    "clock_to_seconds",
    "fixed_point",
    "is_valid_stop",
    "percentile_label",
    "run_time",
    "stop_minutes",
    "with_commas",
]
