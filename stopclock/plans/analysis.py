"""The whole analysis, from raw rows to the result table, in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopclock.operators.durations import valid_stops
from stopclock.operators.percentiles import (
    needed_cells,
    percentile_table,
    results_from_cells,
    with_ranks,
)
from stopclock.operators.quality import (
    classify,
    observe_progress,
    retention_rate,
    summary_counts,
    valid_class_minutes,
)
from stopclock.plans.live import told_live
from stopclock.plans.report import report_lines
from stopclock.schema import PERCENTILES
from stopclock.sources import MODES, path_exists, read_csv, write_lines, write_result, write_together


@dataclass(frozen=True)
class PercentileResult:
    percentile: float
    value: float
    exceeding_count: int


# The field names are those that users of the result rely on.
@dataclass(frozen=True)
class AnalysisResult:
    percentile_results: list[PercentileResult]
    total_records: int
    valid_durations: int
    bad_rows_filtered: int
    retention_rate: float
    timestamp: str


def stop_duration_report(
    schedule: DataFrame, percentiles: Sequence[float] = PERCENTILES
) -> DataFrame:
    """The required table: percentile, value in minutes, stops exceeding it."""
    return percentile_table(valid_stops(schedule), percentiles).drop("valid")


def analysis(
    schedule: DataFrame,
    percentiles: Sequence[float] = PERCENTILES,
    observation: Observation | None = None,
) -> DataFrame:
    """One row: the quality summary and the ``results`` array of the report.

    ``observation`` gets the summary counts from the same job.

    Both come from one scan. The rows are counted by class and valid duration,
    which leaves at most 86,400 entries and one per other class, and summary,
    ranks, values and exceeding counts are all read off that table.
    """
    minutes = F.col("stop_duration_minutes")
    # One class for all valid rows, so that a duration is one entry.
    kind = F.when(minutes.isNotNull(), "valid").otherwise(F.col("row_class"))
    profile = (
        (observe_progress(schedule, observation) if observation else classify(schedule))
        .select("row_class", valid_class_minutes().alias("stop_duration_minutes"))
        .select(kind.alias("row_class"), minutes)
        .groupBy("row_class", "stop_duration_minutes")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    weighed = profile.withColumn(
        "stops", F.when(minutes.isNull(), 0).otherwise(F.col("rows"))
    )
    counts = with_ranks(weighed).agg(
        *summary_counts(F.col("rows")), needed_cells(percentiles).alias("cells")
    )
    return counts.select(
        "total",
        "header_removed",
        "corrupt_removed",
        "bad_rows",
        "valid",
        retention_rate().alias("retention_rate"),
        F.coalesce(
            results_from_cells(percentiles, F.col("cells"), F.col("valid")), F.array()
        ).alias("results"),
    )


def run(
    spark: SparkSession,
    path: str | list[str],
    percentiles: Sequence[float] = PERCENTILES,
    multi_line: bool | str = False,
    report_path: str | None = None,
    result_path: str | None = None,
    mode: str = "errorifexists",
    progress: Callable[[dict[str, int]], None] | None = None,
    live: Callable[[dict[str, int]], None] | None = None,
    live_every: float = 1.0,
) -> AnalysisResult:
    """Analyse a timetable CSV; optionally write the report text and the table.

    The data is read once. What comes to the driver, and is then written, is a
    single row with one array entry per percentile. With the default ``mode`` an
    output that exists is refused before any job starts, so nothing is computed
    in vain. Both outputs appear together or not at all (see ``write_together``).

    ``progress`` is called with the row counts (total, header_removed,
    corrupt_removed, bad_rows, valid) of the job that reads the data, and then
    with ``exceeding`` for each percentile, before anything is written. ``live`` is called every
    ``live_every`` seconds while that job runs, with its tasks begun and done (see ``told_live``).
    """
    outputs = [p for p in (report_path, result_path) if p]
    if len(set(outputs)) < len(outputs):
        raise ValueError("the report and the result need different paths")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if mode in ("errorifexists", "error"):
        for taken in (p for p in outputs if path_exists(spark, p)):
            raise FileExistsError(f"{taken} already exists")
    when = datetime.now()
    schedule = read_csv(spark, path, multi_line)
    observation = Observation() if progress else None
    with told_live(spark, live, live_every) if live else nullcontext():
        row = analysis(schedule, percentiles, observation).first()
    if progress:
        progress(observation.get)
        progress({f"exceeding {r.percentile}": r.exceeding_count for r in row.results})
    if outputs:
        done = spark.createDataFrame([row], analysis(schedule, percentiles).schema)
        lines, table = report_lines(done, timed=True), done.select(F.inline("results"))
        writers = {report_path: partial(write_lines, lines), result_path: partial(write_result, table)}
        write_together(spark, {path: writers[path] for path in outputs}, mode)
    return AnalysisResult(
        [PercentileResult(**r.asDict()) for r in row.results],
        row.total,
        row.valid,
        row.bad_rows,
        row.retention_rate,
        f"{when:%Y-%m-%d %H:%M:%S}",
    )
