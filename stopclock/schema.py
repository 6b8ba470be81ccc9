"""Table layout and the fixed values every module agrees on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# They decide which rows count, so they must not drift.
SOURCE_HEADERS = {
    "train_no": "Train No",
    "station_name": "Station Name",
    "arrival_time": "Arrival time",
    "departure_time": "Departure Time",
}
REPEATED_HEADER = "Train No"
NOT_AVAILABLE = "NA"
MIDNIGHT = "00:00:00"
CLOCK_PATTERN = "^[0-9]{2}:[0-9]{2}:[0-9]{2}$"
MIN_TIME_LENGTH = 7
SECONDS_PER_DAY = 86_400
MAX_STOP_MINUTES = 1_440
PERCENTILES = (95.0, 99.0, 99.5, 99.95, 99.995)

SCHEDULE = T.StructType([T.StructField(name, T.StringType()) for name in SOURCE_HEADERS])


class SchemaError(ValueError):
    """The input table cannot be read as a timetable."""


def as_schedule(df: DataFrame) -> DataFrame:
    """Project any timetable table onto the four ``SCHEDULE`` columns.

    Columns are found by their source header or by their name here, and other
    columns are left to be pruned. Fails before any job runs when one is
    missing, ambiguous or not a string. Looks at the schema only.
    """
    fold = (lambda s: s) if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    picked, problems = [], []
    for name, header in SOURCE_HEADERS.items():
        found = [f for f in df.schema.fields if fold(f.name) in (fold(name), fold(header))]
        if len(found) != 1:
            problems.append(f"{header!r}: " + ("missing" if not found else "found more than once"))
        elif not isinstance(found[0].dataType, T.StringType):
            problems.append(f"{header!r}: expected string, found {found[0].dataType.simpleString()}")
        else:
            picked.append(F.col(f"`{found[0].name}`").alias(name))
    if problems:
        raise SchemaError("not a timetable: " + "; ".join(problems))
    return df.select(picked)
