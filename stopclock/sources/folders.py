"""Folders that the driver and all executors see, and outputs that appear together or not at all."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``, which all executors see.

    Only where that is unset and Spark runs on this machine alone (tests) a temporary folder takes
    its place; on a cluster each executor would write to a disk of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors see")
        base = "file://" + tempfile.mkdtemp(prefix="stopclock-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a shared folder and read it back: computed once, lineage cut, and nothing lost
    with an executor."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _hadoop(spark, path)
    return system.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    hadoop, system = _hadoop(spark, path)
    system.delete(hadoop, True)


def _move(spark: SparkSession, old: str, new: str) -> None:
    source, system = _hadoop(spark, old)
    target, _ = _hadoop(spark, new)
    if target.getParent():
        system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def _files(spark: SparkSession, path: str) -> list[str]:
    hadoop, system = _hadoop(spark, path)
    return [f.getPath().getName() for f in system.listStatus(hadoop)]


MODES = ("errorifexists", "error", "overwrite", "append", "ignore")


@contextmanager
def _undone_on_error() -> Iterator[list[Callable[[], None]]]:
    """Steps added to the list are taken, the last one first, if the block fails."""
    undo: list[Callable[[], None]] = []
    try:
        yield undo
    except BaseException:
        for step in reversed(undo):
            step()
        raise


def write_together(spark: SparkSession, outputs: dict[str, Callable[[str], None]], mode: str = "errorifexists") -> None:
    """Write several outputs so that all of them appear, or none.

    ``outputs`` maps each path to what writes a new folder at the path it is given. All are first
    written beside their places; only when that is done are they moved there, and if a move fails
    those before it are taken back, and what they replaced is put back. With ``append`` the new
    files join those of a folder that is there; with ``ignore`` such a folder is left alone.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    taken = {path for path in outputs if path_exists(spark, path)}
    if taken and mode in ("errorifexists", "error"):
        raise FileExistsError(f"{sorted(taken)[0]} already exists")
    wanted = {path: write for path, write in outputs.items() if not (mode == "ignore" and path in taken)}
    mark = uuid.uuid4().hex
    pending = {path: f"{path.rstrip('/')}.pending-{mark}" for path in wanted}
    replaced = {path: f"{path.rstrip('/')}.replaced-{mark}" for path in wanted if path in taken and mode == "overwrite"}
    try:
        for path, write in wanted.items():
            write(pending[path])
        with _undone_on_error() as undo:
            for path in wanted:
                if path in taken and mode == "append":
                    for name in _files(spark, pending[path]):
                        if not name.startswith(("_", ".")):
                            _move(spark, f"{pending[path]}/{name}", f"{path}/{name}")
                            undo.append(lambda at=f"{path}/{name}": delete(spark, at))
                    continue
                if path in replaced:
                    _move(spark, path, replaced[path])
                    undo.append(lambda path=path: _move(spark, replaced[path], path))
                _move(spark, pending[path], path)
                undo.append(lambda path=path: delete(spark, path))
    finally:
        for path in pending.values():
            delete(spark, path)
    for path in replaced.values():
        delete(spark, path)
