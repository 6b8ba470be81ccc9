"""

Every query runs over the whole ``schedule`` table, which is derived from
``events`` (see ``events_timetable``); the SQL repeats the derivation
as a common table expression and computes each result its own way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stopclock as sc
from events_timetable import schedule_from_events
from stopclock.sources.folders import shared_folder

# The operators on training text may be absent; anything else that is missing is an error.
try:
    import corpus_pipeline
    from stopclock.llm import registry as llm
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "stopclock.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Minutes given as thresholds, one pass for all of them.
THRESHOLDS = (10.0, 20.0, 25.0, 60.0, 155.0)


def _schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _on_schedule(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_schedule(spark, sf_dir))


def _on_clean(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_schedule(lambda schedule: operator(sc.clean(schedule)))


def _on_timed(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_clean(lambda cleaned: operator(sc.with_stop_duration(cleaned)))


def _on_valid(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_schedule(lambda schedule: operator(sc.valid_stops(schedule)))


def _displayed(df: DataFrame) -> DataFrame:
    """Percentile values at the precision the report shows."""
    return df.withColumn("value", F.round("value", 3))


def entry(spark: SparkSession) -> DataFrame:
    """The stop duration report on sf0.001."""
    return queries()["stop_duration_report"](spark, "/root/testdata/sf0.001")


def _llm_queries() -> dict[str, Query]:
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}


def _llm_sql() -> dict[str, str]:
    return llm.ORACLE_SQL if llm else {}


def _analysis_rows(schedule: DataFrame) -> DataFrame:
    """One row per percentile, beside the quality summary."""
    rows = sc.analysis(schedule).select("*", F.inline("results")).drop("results")
    return _displayed(rows)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timetable, written as CSV with a remark that has a line break, and read in pieces."""
    folder = shared_folder(spark)
    names = sc.schema.SOURCE_HEADERS
    schedule = _schedule(spark, sf_dir).withColumnsRenamed(names)
    remark = F.concat(F.lit('a "remark",\non '), F.coalesce("Station Name", F.lit("nothing")))
    columns = [remark.alias("Remark"), *(f"`{h}`" for h in reversed(names.values()))]
    schedule.select(*columns).write.option("header", True).csv(folder)
    return sc.read_csv(spark, folder, multi_line="split")


def _written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table of a whole run from CSV to its two outputs, read back."""
    folder = shared_folder(spark)
    _schedule(spark, sf_dir).withColumnsRenamed(sc.schema.SOURCE_HEADERS).write.option("header", True).csv(f"{folder}/in")
    sc.run(spark, f"{folder}/in", report_path=f"{folder}/report", result_path=f"{folder}/result")
    return _displayed(spark.read.parquet(f"{folder}/result"))


def _threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the events as a threshold of the valid stops."""
    return sc.threshold_table(sc.valid_stops(_schedule(spark, sf_dir)), "stop_duration_minutes", _events(spark, sf_dir).select("value"))


def queries() -> dict[str, Query]:
    return {**timetable_queries(), **_llm_queries()}


def timetable_queries() -> dict[str, Query]:
    return {
        "schedule_scan": _on_schedule(sc.as_schedule),
        "drop_repeated_headers": _on_schedule(sc.drop_repeated_headers),
        "drop_null_fields": _on_schedule(sc.drop_null_fields),
        "drop_na_sentinel": _on_schedule(sc.drop_not_available),
        "min_time_length": _on_schedule(sc.drop_short_times),
        "clean_schedule": _on_schedule(sc.clean),
        "time_to_seconds": _on_clean(sc.with_clock_seconds),
        "stop_duration": _on_clean(sc.with_stop_duration),
        "cross_midnight_stops": _on_timed(sc.cross_midnight),
        "valid_durations": _on_timed(sc.valid_only),
        "sorted_durations": _on_valid(sc.sorted_durations),
        "duration_sample": _on_valid(sc.duration_sample),
        "quality_summary": _on_schedule(sc.quality_summary),
        "exact_percentiles": _on_valid(lambda stops: _displayed(sc.exact_percentiles(stops))),
        "exceeding_counts": _on_valid(sc.exceeding_counts),
        "threshold_counts": _on_valid(
            lambda stops: sc.threshold_counts(stops, THRESHOLDS)
        ),
        "stop_duration_report": _on_schedule(lambda s: _displayed(sc.stop_duration_report(s))),
        "analysis": _on_schedule(_analysis_rows),
        "report_lines": _on_schedule(lambda s: sc.report_lines(sc.analysis(s))),
        "station_percentiles": _on_valid(lambda stops: _displayed(sc.station_percentiles(stops))),
        "station_exceeding_total": _on_valid(sc.station_exceeding_total),
        "terminal_profile": _on_schedule(sc.terminal_profile),
        "quality_breakdown": _on_schedule(sc.quality_breakdown),
        "exceeding_share": _on_valid(sc.exceeding_share),
        "station_overview": _on_schedule(sc.station_overview),
        "platform_peak": _on_valid(sc.platform_peak),
        "csv_round_trip": _csv_round_trip,
        "written_report": _written_report,
        "number_percentiles": lambda spark, sf_dir: _displayed(sc.number_percentiles(_events(spark, sf_dir), "value")),
        "sorted_numbers": lambda spark, sf_dir: sc.sorted_numbers(_events(spark, sf_dir), "value", "value"),
        "threshold_sweep": _threshold_sweep,
    }


_SCHEDULE = """
WITH stamped AS (
  SELECT *, date_trunc('minute', ts) AS arrived,
         date_trunc('minute', ts) + to_minutes(CAST(floor(value) AS BIGINT)) AS departed
  FROM events
), texts AS (
  SELECT *, strftime(arrived, '%H:%M:%S') AS a, strftime(departed, '%H:%M:%S') AS d FROM stamped
), schedule AS (
  SELECT
    CASE WHEN event_id % 103 = 0 THEN 'Train No'
         WHEN event_id % 137 = 0 THEN NULL
         ELSE CAST(user_id AS VARCHAR) END AS train_no,
    CASE WHEN event_id % 113 = 0 THEN NULL ELSE event_type END AS station_name,
    CASE WHEN event_id % 101 = 0 THEN 'NA'
         WHEN event_id % 107 = 0 THEN '00:00:00'
         WHEN event_id % 131 = 0 THEN NULL
         WHEN event_id % 139 = 0 THEN ltrim(a, '0')
         ELSE a END AS arrival_time,
    CASE WHEN event_id % 127 = 0 THEN '99:99:99'
         WHEN event_id % 109 = 0 THEN left(d, 5)
         WHEN event_id % 149 = 0 THEN '00:00:00'
         ELSE d END AS departure_time
  FROM texts
)"""

_CLEAN = (
    _SCHEDULE
    + """, cleaned AS (
  SELECT * FROM schedule
  WHERE train_no <> 'Train No' AND train_no IS NOT NULL AND station_name IS NOT NULL
    AND arrival_time IS NOT NULL AND departure_time IS NOT NULL
    AND arrival_time <> 'NA' AND departure_time <> 'NA'
    AND length(arrival_time) >= 7 AND length(departure_time) >= 7
)"""
)


def _seconds(clock: str) -> str:
    parts = " + ".join(
        f"TRY_CAST(split_part({clock}, ':', {i}) AS INTEGER) * {unit}"
        for i, unit in ((1, 3600), (2, 60), (3, 1))
    )
    pattern = "[0-9]{2}:[0-9]{2}:[0-9]{2}"
    return (
        f"CASE WHEN {clock} <> '00:00:00' AND regexp_full_match({clock}, '{pattern}') "
        f"THEN CAST({parts} AS INTEGER) END"
    )


def _with_minutes(source: str) -> str:
    return f""", seconds AS (
  SELECT *, {_seconds("arrival_time")} AS arrival_seconds,
         {_seconds("departure_time")} AS departure_seconds
  FROM {source}
), stops AS (
  SELECT *, CASE WHEN departure_seconds >= arrival_seconds
                 THEN (departure_seconds - arrival_seconds) / 60.0::DOUBLE
                 WHEN departure_seconds < arrival_seconds
                 THEN (departure_seconds + 86400 - arrival_seconds) / 60.0::DOUBLE
            END AS stop_duration_minutes
  FROM seconds
)"""


_STOPS = _CLEAN + _with_minutes("cleaned")
_VALID = (
    _STOPS
    + """, valid AS (
  SELECT * FROM stops WHERE stop_duration_minutes > 0 AND stop_duration_minutes <= 1440
)"""
)
_LEVELS = ", levels(percentile) AS (VALUES " + ", ".join(
    f"({p}::DOUBLE)" for p in sc.PERCENTILES
) + ")"


def _quantiles(by: str = "") -> str:
    """One row per percentile (and group), with the interpolated value."""
    columns = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    arms = " UNION ALL ".join(
        f"SELECT {columns}{p}::DOUBLE AS percentile, "
        f"quantile_cont(stop_duration_minutes, {p / 100.0!r}) AS value FROM valid{group}"
        for p in sc.PERCENTILES
    )
    return f", quantiles AS ({arms})"


_GLOBAL = _VALID + _quantiles()
_STATION = _VALID + _quantiles("station_name")
_EXCEEDING = (
    _GLOBAL
    + """, exceeding AS (
  SELECT q.percentile, q.value, count(*) FILTER (v.stop_duration_minutes > q.value) AS exceeding_count,
         count(*) AS valid
  FROM quantiles q CROSS JOIN valid v GROUP BY q.percentile, q.value
)"""
)
_NUMBERS = """
WITH numbers AS (
  SELECT value FROM events WHERE value IS NOT NULL AND NOT isnan(value)
), quantiles AS (""" + " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS percentile, quantile_cont(value, {p / 100.0!r}) AS value FROM numbers" for p in sc.PERCENTILES
) + """)
SELECT q.percentile, round(q.value, 3) AS value, count(*) FILTER (v.value > q.value) AS exceeding_count
FROM quantiles q CROSS JOIN numbers v GROUP BY q.percentile, q.value"""
_CLASSES = (
    _SCHEDULE
    + _with_minutes("schedule")
    + """, classes AS (
  SELECT *, CASE
      WHEN train_no = 'Train No' THEN 'repeated_header'
      WHEN train_no IS NULL THEN 'null_train'
      WHEN station_name IS NULL OR arrival_time IS NULL OR departure_time IS NULL THEN 'null_field'
      WHEN 'NA' IN (arrival_time, departure_time) THEN 'not_available'
      WHEN least(length(arrival_time), length(departure_time)) < 7 THEN 'short_time'
      WHEN '00:00:00' IN (arrival_time, departure_time) THEN 'terminal'
      WHEN stop_duration_minutes IS NULL THEN 'bad_format'
      WHEN stop_duration_minutes = 0 THEN 'zero'
      WHEN stop_duration_minutes < 0 THEN 'negative'
      WHEN stop_duration_minutes > 1440 THEN 'over_24h'
      WHEN departure_seconds < arrival_seconds THEN 'valid_cross_midnight'
      ELSE 'valid' END AS class
  FROM stops
)"""
)
# Counted stage by stage, not by class as the engine does it.
_SUMMARY = (
    _VALID
    + """, counted AS (
  SELECT (SELECT count(*) FROM schedule) AS total,
         (SELECT count(*) FROM schedule WHERE train_no <> 'Train No') AS trains,
         (SELECT count(*) FROM cleaned) AS clean_rows,
         (SELECT count(*) FROM valid) AS valid
), summary AS (
  SELECT total, total - trains AS header_removed, trains - clean_rows AS corrupt_removed,
         total - clean_rows AS bad_rows, valid,
         CASE WHEN total > 0 THEN valid / total * 100 ELSE 0 END AS retention_rate
  FROM counted
)"""
)


def _filtered(condition: str) -> str:
    return f"{_SCHEDULE} SELECT * FROM schedule WHERE {condition}"


def oracle_sql() -> dict[str, str]:
    return {**_timetable_sql(), **_llm_sql()}


def _timetable_sql() -> dict[str, str]:
    exceeding = _SUMMARY + _EXCEEDING[len(_VALID) :]
    return {
        "schedule_scan": f"{_SCHEDULE} SELECT * FROM schedule",
        "drop_repeated_headers": _filtered("train_no <> 'Train No'"),
        "drop_null_fields": _filtered(
            "train_no IS NOT NULL AND station_name IS NOT NULL "
            "AND arrival_time IS NOT NULL AND departure_time IS NOT NULL"
        ),
        "drop_na_sentinel": _filtered("arrival_time <> 'NA' AND departure_time <> 'NA'"),
        "min_time_length": _filtered("length(arrival_time) >= 7 AND length(departure_time) >= 7"),
        "clean_schedule": f"{_CLEAN} SELECT * FROM cleaned",
        "time_to_seconds": f"{_STOPS} SELECT * FROM seconds",
        "stop_duration": f"{_STOPS} SELECT * FROM stops",
        "cross_midnight_stops": (
            f"{_STOPS} SELECT * FROM stops WHERE departure_seconds < arrival_seconds"
        ),
        "valid_durations": f"{_VALID} SELECT * FROM valid",
        "sorted_durations": (
            f"{_VALID} SELECT stop_duration_minutes FROM valid ORDER BY stop_duration_minutes"
        ),
        "duration_sample": f"""{_VALID}
SELECT train_no AS train, left(station_name, 15) AS station, arrival_time AS arrival,
       departure_time AS departure, printf('%.1f', stop_duration_minutes) AS duration
FROM valid ORDER BY train_no, station_name, arrival_time, departure_time LIMIT 5""",
        "quality_summary": f"{_SUMMARY} SELECT * FROM summary",
        "exact_percentiles": f"{_GLOBAL} SELECT percentile, round(value, 3) AS value FROM quantiles",
        "exceeding_counts": f"{_EXCEEDING} SELECT percentile, exceeding_count FROM exceeding",
        "threshold_counts": f"""{_VALID}
SELECT t.value, count(*) FILTER (v.stop_duration_minutes > t.value) AS exceeding_count
FROM (VALUES {", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS)}) t(value)
CROSS JOIN valid v GROUP BY t.value""",
        "stop_duration_report": f"""{_EXCEEDING}
SELECT percentile, round(value, 3) AS value, exceeding_count FROM exceeding""",
        "analysis": f"""{exceeding}
SELECT s.*, e.percentile, round(e.value, 3) AS value, e.exceeding_count FROM summary s CROSS JOIN exceeding e""",
        "report_lines": f"""{exceeding}, lines AS (
  -- Fixed values: the heading and separator lines of the report.
  SELECT 0 AS line_no, '| Metric | Value |' AS line
  UNION ALL SELECT 1, '|--------|-------|'
  UNION ALL SELECT 2, format('| **Total Records** | {{:,}} |', total) FROM summary
  UNION ALL SELECT 3, format('| **Valid Stop Durations** | {{:,}} |', valid) FROM summary
  UNION ALL SELECT 4, format('| **Bad Rows Handled** | {{}} |', bad_rows) FROM summary
  UNION ALL SELECT 5, printf('| **Data Retention Rate** | %.1f%% |', retention_rate) FROM summary
  UNION ALL SELECT 6, ''
  UNION ALL SELECT 7, '| Percentile of stop duration | Value of stop duration (minutes) | Number of trains that exceed this stop duration |'
  UNION ALL SELECT 8, '|------------------------------|-----------------------------------|--------------------------------------------------|'
  UNION ALL
  SELECT 8 + row_number() OVER (ORDER BY percentile),
         format('| {{}}th | {{:.3f}} | {{:,}} |', percentile, value, exceeding_count)
  FROM exceeding
) SELECT CAST(line_no AS INTEGER) AS line_no, line FROM lines""",
        "station_percentiles": f"""{_STATION}
SELECT station_name, percentile, round(value, 3) AS value FROM quantiles""",
        "station_exceeding_total": f"""{_STATION}
SELECT q.percentile, count(*) FILTER (v.stop_duration_minutes > q.value) AS exceeding_count
FROM quantiles q JOIN valid v ON v.station_name = q.station_name GROUP BY q.percentile""",
        "terminal_profile": f"""{_SCHEDULE}
SELECT count(*) FILTER (arrival_time = '00:00:00') AS arrival_midnight,
       count(*) FILTER (departure_time = '00:00:00') AS departure_midnight FROM schedule""",
        "quality_breakdown": f"""{_CLASSES}
SELECT class, count(*) AS "rows" FROM classes GROUP BY class""",
        "exceeding_share": f"""{_EXCEEDING}
SELECT percentile, exceeding_count / valid * 100 AS share_pct FROM exceeding""",
        "station_overview": f"""{_VALID}
SELECT (SELECT count(DISTINCT station_name) FROM schedule WHERE train_no <> 'Train No') AS stations,
       min(stop_duration_minutes) AS min_minutes, max(stop_duration_minutes) AS max_minutes
FROM valid""",
        "platform_peak": f"""{_VALID}, folded AS (
  SELECT station_name, arrival_seconds % 86400 AS a, departure_seconds % 86400 AS d FROM valid
), moments AS (
  SELECT DISTINCT station_name, a AS t FROM folded
  UNION SELECT DISTINCT station_name, 0 FROM folded
), present AS (
  SELECT m.station_name, m.t, count(*) FILTER (
           CASE WHEN f.d > f.a THEN m.t >= f.a AND m.t < f.d ELSE m.t >= f.a OR m.t < f.d END
         ) AS trains
  FROM moments m JOIN folded f ON f.station_name = m.station_name
  GROUP BY m.station_name, m.t
) SELECT station_name, max(trains) AS peak FROM present GROUP BY station_name""",
        "csv_round_trip": f"{_SCHEDULE} SELECT * FROM schedule",
        "written_report": f"""{_EXCEEDING}
SELECT percentile, round(value, 3) AS value, exceeding_count FROM exceeding""",
        "number_percentiles": _NUMBERS,
        "sorted_numbers": "SELECT value FROM events WHERE value IS NOT NULL AND NOT isnan(value) ORDER BY value",
        # Binned instead of compared: how many of the sorted minutes lie above a threshold.
        "threshold_sweep": f"""{_VALID}, counted AS (
  SELECT stop_duration_minutes AS minutes, count(*) AS n FROM valid GROUP BY stop_duration_minutes
), asked AS (
  SELECT value, count(*) AS times FROM events GROUP BY value
), answered AS (
  SELECT value, times, CAST(coalesce(sum(n), 0) AS BIGINT) AS exceeding_count
  FROM asked LEFT JOIN counted ON minutes > value GROUP BY value, times
)
SELECT value, exceeding_count FROM answered, unnest(range(0, times)) AS t(k)""",
    }
