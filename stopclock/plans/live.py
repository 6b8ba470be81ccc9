"""How far a running job is, told while it runs."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import SparkContext, StatusTracker
from pyspark.sql import SparkSession

_PROPERTIES = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")


def tasks_so_far(tracker: StatusTracker, group: str) -> dict[str, int]:
    """Jobs, and tasks begun and done, of the stages of a job group that are known by now."""
    jobs = [job for k in tracker.getJobIdsForGroup(group) if (job := tracker.getJobInfo(k))]
    stages = [stage for k in {k for job in jobs for k in job.stageIds} if (stage := tracker.getStageInfo(k))]
    return {
        "jobs": len(jobs),
        "tasks": sum(s.numTasks for s in stages),
        "tasks_active": sum(s.numActiveTasks for s in stages),
        "tasks_done": sum(s.numCompletedTasks for s in stages),
    }


def _set_properties(context: SparkContext, values: dict[str, str | None]) -> None:
    for name, value in values.items():
        context.setLocalProperty(name, value)


@contextmanager
def told_live(spark: SparkSession, tell: Callable[[dict[str, int]], None], every: float = 1.0) -> Iterator[None]:
    """Call ``tell`` with ``tasks_so_far`` every so many seconds while the block's jobs run.

    A thread of the driver asks Spark's status tracker; the tasks know nothing of it, and no web page
    is read. What ``tell`` raises is raised at the end of the block, which it doesn't stop.
    """
    context, group = spark.sparkContext, f"stopclock-{uuid.uuid4().hex}"
    tracker, over, raised = context.statusTracker(), threading.Event(), []

    def ask() -> None:
        last = None
        while not over.wait(every):
            try:
                now = tasks_so_far(tracker, group)
                if now["jobs"] and now != last:
                    tell(now)
                last = now
            except Exception as e:
                raised.append(e)
                return

    before = {name: context.getLocalProperty(name) for name in _PROPERTIES}
    _set_properties(context, dict(zip(_PROPERTIES, (group, before[_PROPERTIES[1]], "false"), strict=True)))
    asking = threading.Thread(target=ask, daemon=True)
    asking.start()
    try:
        yield
    finally:
        over.set()
        asking.join()
        _set_properties(context, before)
    if raised:
        raise raised[0]
