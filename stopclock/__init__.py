"""Exact dwell-time statistics of railway timetables on Spark."""

from stopclock.operators import *  # noqa: F403
from stopclock.operators import __all__ as _operators
from stopclock.plans import (
    AnalysisResult,
    PercentileResult,
    analysis,
    report_lines,
    run,
    stop_duration_report,
)
from stopclock.schema import PERCENTILES, SCHEDULE, SchemaError, as_schedule
from stopclock.sources import (
    read_csv,
    read_parquet,
    timed_path,
    write_lines,
    write_result,
    write_together,
)

__all__ = [
    *_operators,
    "AnalysisResult",
    "PERCENTILES",
    "PercentileResult",
    "SCHEDULE",
    "SchemaError",
    "analysis",
    "as_schedule",
    "read_csv",
    "read_parquet",
    "report_lines",
    "run",
    "stop_duration_report",
    "timed_path",
    "write_lines",
    "write_result",
    "write_together",
]
