from stopclock.plans.analysis import (
    AnalysisResult,
    PercentileResult,
    analysis,
    run,
    stop_duration_report,
)
from stopclock.plans.report import report_lines

__all__ = [
    "AnalysisResult",
    "PercentileResult",
    "analysis",
    "report_lines",
    "run",
    "stop_duration_report",
]
