"""The analysis as markdown table lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.functions import fixed_point, percentile_label, run_time, with_commas

# The text of the time line and of the two tables.
TIME_LABEL = "**Analysis Timestamp:** "
SUMMARY_HEADING = ("| Metric | Value |", "|--------|-------|")
RESULT_HEADING = (
    "| Percentile of stop duration | Value of stop duration (minutes) "
    "| Number of trains that exceed this stop duration |",
    "|------------------------------|-----------------------------------"
    "|--------------------------------------------------|",
)
TOTAL_LABEL = "**Total Records**"
VALID_LABEL = "**Valid Stop Durations**"
BAD_ROWS_LABEL = "**Bad Rows Handled**"
RETENTION_LABEL = "**Data Retention Rate**"


def _table_row(*cells: Column | str) -> Column:
    texts = [F.lit(c) if isinstance(c, str) else c for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *texts), F.lit(" |"))


def _result_row(result: Column) -> Column:
    return _table_row(
        percentile_label(result["percentile"]),
        fixed_point(result["value"], 3),
        with_commas(result["exceeding_count"]),
    )


def report_lines(analysed: DataFrame, timed: bool = False) -> DataFrame:
    """(line_no, line) from the row of ``analysis``: summary, blank, results.

    ``timed`` puts the time of the run and a blank line in front.
    """
    time = (F.concat(F.lit(TIME_LABEL), run_time()), F.lit("")) if timed else ()
    summary = (
        _table_row(TOTAL_LABEL, with_commas(F.col("total"))),
        _table_row(VALID_LABEL, with_commas(F.col("valid"))),
        _table_row(BAD_ROWS_LABEL, F.col("bad_rows").cast("string")),
        _table_row(
            RETENTION_LABEL, F.concat(fixed_point(F.col("retention_rate"), 1), F.lit("%"))
        ),
    )
    head = (*time, *map(F.lit, SUMMARY_HEADING), *summary, F.lit(""), *map(F.lit, RESULT_HEADING))
    lines = F.concat(F.array(*head), F.transform("results", _result_row))
    return analysed.select(F.posexplode(lines).alias("line_no", "line"))
