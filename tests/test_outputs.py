"""Outputs that appear together or not at all, and figures of a job while it runs."""

import sys
import threading
import time

import pytest
from pyspark.sql import functions as F

import stopclock as sc
from stopclock.plans.live import told_live
from stopclock.sources.folders import shared_folder


def _writer(spark, n):
    return lambda path: spark.range(n).write.parquet(path)


def _broken(path):
    raise RuntimeError("no room")


def _left(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))


@pytest.mark.parametrize("mode", ["errorifexists", "overwrite", "append"])
def test_a_failing_write_leaves_nothing(spark, tmp_path, mode):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    with pytest.raises(RuntimeError):
        sc.write_together(spark, {a: _writer(spark, 3), b: _broken}, mode)
    assert _left(tmp_path) == []
    sc.write_together(spark, {a: _writer(spark, 3), b: _writer(spark, 4)}, mode)
    assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (3, 4)
    if mode != "errorifexists":
        with pytest.raises(RuntimeError):
            sc.write_together(spark, {a: _writer(spark, 30), b: _broken}, mode)
        assert spark.read.parquet(a).count() == 3
    assert _left(tmp_path) == ["a", "b"]


@pytest.mark.parametrize("mode", ["errorifexists", "overwrite", "append"])
def test_a_failing_move_is_taken_back(spark, tmp_path, mode, monkeypatch):
    from stopclock.sources import folders

    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    if mode != "errorifexists":
        sc.write_together(spark, {a: _writer(spark, 3), b: _writer(spark, 4)})
    move, moved = folders._move, []

    def fails_for_b(spark, old, new):
        if new.startswith(b) and ".replaced-" not in new and not moved:
            moved.append(new)
            raise OSError("gone")
        move(spark, old, new)

    monkeypatch.setattr(folders, "_move", fails_for_b)
    with pytest.raises(OSError, match="gone"):
        sc.write_together(spark, {a: _writer(spark, 30), b: _writer(spark, 40)}, mode)
    if mode == "errorifexists":
        assert _left(tmp_path) == []
    else:
        assert _left(tmp_path) == ["a", "b"]
        assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (3, 4)


def test_modes(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "deep" / "b")
    both = lambda n: {a: _writer(spark, n), b: _writer(spark, n)}
    sc.write_together(spark, {a: _writer(spark, 1)})
    with pytest.raises(FileExistsError):
        sc.write_together(spark, both(2))
    assert not (tmp_path / "deep").exists()
    sc.write_together(spark, both(2), "ignore")
    assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (1, 2)
    sc.write_together(spark, both(4), "append")
    assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (5, 6)
    sc.write_together(spark, both(7), "overwrite")
    assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (7, 7)
    with pytest.raises(ValueError, match="unknown mode"):
        sc.write_together(spark, both(7), "merge")


def test_a_run_whose_second_output_fails_leaves_no_report(spark, events_schedule, tmp_path, monkeypatch):
    path = str(tmp_path / "in")
    events_schedule.toDF("Train No", "Station Name", "Arrival time", "Departure Time").write.option("header", True).csv(path)
    monkeypatch.setattr(sys.modules["stopclock.plans.analysis"], "write_result", lambda table, path: _broken(path))
    with pytest.raises(RuntimeError):
        sc.run(spark, path, report_path=str(tmp_path / "report"), result_path=str(tmp_path / "table"))
    assert _left(tmp_path) == ["in"]


def test_figures_come_while_the_job_runs(spark):
    told, ended = [], []
    slow = spark.range(0, 64, 1, 64).select(F.udf(lambda x: time.sleep(0.3) or x, "long")("id"))
    before = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    with told_live(spark, lambda now: told.append((now, bool(ended))), every=0.1):
        slow.write.format("noop").mode("overwrite").save()
        ended.append(True)
    during = [now for now, late in told if not late]
    assert len(during) >= 2 and during[0]["tasks"] == 64
    assert 0 < max(now["tasks_done"] for now in during) and any(now["tasks_done"] < 64 for now in during)
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == before and threading.active_count() < 50

    def fails(now):
        raise KeyError("listener")

    with pytest.raises(KeyError, match="listener"), told_live(spark, fails, every=0.05):
        slow.write.format("noop").mode("overwrite").save()


def test_run_tells_live(spark, events_schedule, tmp_path):
    path = str(tmp_path / "in")
    wide = events_schedule.toDF("Train No", "Station Name", "Arrival time", "Departure Time")
    wide.crossJoin(spark.range(40)).drop("id").write.option("header", True).csv(path)
    told = []
    result = sc.run(spark, path, live=told.append, live_every=0.02)
    assert told and result.total_records == 40 * events_schedule.count()
    assert all(now["tasks_done"] <= now["tasks"] for now in told)


def test_shared_folder(spark):
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Cluster)
    assert shared_folder(spark) != shared_folder(spark)
