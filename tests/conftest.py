import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stopclock-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        # Not UTC on purpose: no result may depend on the session time zone.
        .config("spark.sql.session.timeZone", "Asia/Kolkata")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_schedule(spark):
    from stopclock import SCHEDULE

    return lambda rows: spark.createDataFrame(rows, SCHEDULE)


@pytest.fixture(scope="session")
def make_stops(spark):
    """Durations in minutes, optionally with leading key columns."""

    def make(rows, keys=""):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        return spark.createDataFrame(rows, f"{keys} stop_duration_minutes double")

    return make


@pytest.fixture(scope="session")
def events_schedule(spark):
    from events_timetable import schedule_from_events

    path = str(TESTDATA / "sf0.01" / "events.parquet")
    return schedule_from_events(spark.read.parquet(path))
