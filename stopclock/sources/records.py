"""CSV records that quoted line breaks spread over several lines, read from files that are split.

A task gets some lines of a file and cannot know whether its first line begins a record or
goes on inside a quoted field. But a line does the same to whoever comes before it: it takes the
state "outside" to one state and "inside quotes" to one. So a first job composes the lines of each
range of a file to such a pair, and running over the pairs of a file gives the state in which
each range begins. A second pass then reads every range from its own state. A record
that a range begins and a later one ends leaves a piece in each; there are at most two pieces per
range, and they are put together by file and order.

The rules are those of Spark's reader with its default quote, escape and delimiter: a field is
quoted if its first character is a quote, a backslash keeps the next quote or backslash from
meaning anything, quotes before a backslash mean nothing either, and after any other
quote the field goes on to the next delimiter or line end, whatever comes first. Fields in which a backslash comes right after a quote, which no
writer makes, may be read otherwise: Spark's parser takes them in more than one way.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The functions that tasks call travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTSIDE, INSIDE = 0, 1
_CONTENT = rb'(?:[^"\\]++|\\["\\]?|"++(?=\\))*+'
_PLAIN, _CLOSED = rb'(?:[^",][^,]*+)?+', rb'"' + _CONTENT + rb'"[^,]*+'
#: A line from outside that ends inside: whole fields, then a field that is not closed.
_LEFT_OPEN = re.compile(rb"(?:(?:" + _CLOSED + rb"|" + _PLAIN + rb"),)*+" + rb'"' + _CONTENT + rb"\Z", re.DOTALL)
#: The rest of a quoted field, with its closing quote.
_REST = re.compile(_CONTENT + rb'"', re.DOTALL)
#: Whole records in one batch of this many, however long.
_ROWS = 4_096


def state_after(state: int, line: bytes) -> int:
    """The state in which the line ends."""
    if state == INSIDE:
        rest = _REST.match(line)
        if not rest:
            return INSIDE
        comma = line.find(b",", rest.end())
        if comma < 0:
            return OUTSIDE
        line = line[comma + 1 :]
    return INSIDE if _LEFT_OPEN.match(line) else OUTSIDE


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line``, and of which ``file`` and range (``start``) of it. Within a range in order."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """File, start, and first and last row of what a batch has of each range."""
    file = batch["file"].dictionary_encode().indices.to_numpy(zero_copy_only=False)
    start = batch["start"].to_numpy()
    if len(start):
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(start)], strict=True):
            yield batch["file"][a].as_py(), int(start[a]), int(a), int(b)


def _quoting(batch: pa.RecordBatch, a: int, b: int) -> np.ndarray:
    """The rows with a quote; all others leave every state as it is."""
    return a + np.flatnonzero(pc.match_substring(batch["line"].slice(a, b - a), '"').to_numpy(zero_copy_only=False))


def range_states(found: DataFrame) -> DataFrame:
    """``file``, ``start`` and ``state`` (in which the range begins) of all ranges with lines."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends = None, (OUTSIDE, INSIDE)
        for batch in batches:
            for file, start, a, b in _ranges(batch):
                if (file, start) != at:
                    if at:
                        yield told(*at, *ends)
                    at, ends = (file, start), (OUTSIDE, INSIDE)
                for k in _quoting(batch, a, b):
                    line = batch["line"][k].as_py()
                    to = state_after(OUTSIDE, line), state_after(INSIDE, line)
                    ends = to[ends[0]], to[ends[1]]
        if at:
            yield told(*at, *ends)

    def told(file: str, start: int, outside: int, inside: int) -> pa.RecordBatch:
        columns = pa.array([file]), pa.array([start], pa.int64()), pa.array([outside], pa.int32()), pa.array([inside], pa.int32())
        return pa.RecordBatch.from_arrays([*columns], ["file", "start", "outside", "inside"])

    composed = found.mapInArrow(compose, "file string, start long, outside int, inside int")
    # A range either keeps, swaps or forgets the state. What holds is what the last one that forgets
    # says, swapped as often as ranges swap after it. A row for each range of one file meet in a task.
    in_file = Window.partitionBy("file").orderBy("start")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.col("outside") > F.col("inside")
    swapped = composed.withColumn("swaps", F.sum(swaps.cast("int")).over(in_file))
    known = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "swaps"))
    last = F.last(known, ignorenulls=True).over(before)
    since = F.coalesce(F.lag("swaps").over(in_file), F.lit(0)) - F.coalesce(last["swaps"], F.lit(0))
    state = (F.coalesce(last["outside"], F.lit(OUTSIDE)) + since) % 2
    return swapped.select("file", "start", state.cast("int").alias("state"))


def records(spark: SparkSession, path: str | list[str], skip_first: bool = True) -> DataFrame:
    """``record``, the text of every record, without the first of each file if ``skip_first``.

    The first pass runs now. The ranges that begin inside quotes go to all tasks; there is one
    for each record that a range's end cuts. Both passes must cut the files alike, so Spark's
    settings for that must not change before the result is used; the second pass fails if they did.
    """
    found = lines(spark, path)
    begun_inside = F.when(F.col("state") == INSIDE, F.struct("file", "start"))
    # As many different starts as the longest file has ranges.
    summary = range_states(found).agg(F.collect_list(begun_inside).alias("inside"), F.collect_set("start").alias("starts")).first()
    inside = {(r["file"], r["start"]) for r in summary["inside"]}
    step = math.gcd(*summary["starts"])  # all ranges start at a multiple of it; 0 if no file has two

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, held, out = None, OUTSIDE, [], []
        first, whole = False, False

        def close(file: str, start: int) -> None:
            # What the range leaves open is the head of a record, or all of a range inside one.
            if held:
                out.append((b"\n".join(held), file, start, 1 if whole else 2))

        for batch in batches:
            for file, start, a, b in _ranges(batch):
                if (file, start) != at:
                    if at:
                        close(*at)
                    if start and (not step or start % step):
                        raise ValueError("files are cut otherwise than when they were first read; read them again")
                    at, held = (file, start), []
                    state = INSIDE if at in inside else OUTSIDE
                    whole = state == INSIDE
                    first = skip_first and start == 0
                quoting = set(_quoting(batch, a, b).tolist())
                for k in range(a, b):
                    line = batch["line"][k].as_py()
                    held.append(line)
                    if k in quoting:
                        state = state_after(state, line)
                    if state == OUTSIDE:
                        if first:
                            first = False
                        else:
                            out.append((b"\n".join(held), file, start, 1 if whole else 0))
                        held, whole = [], False
                        if len(out) >= _ROWS:
                            yield told(out)
                            out.clear()
        if at:
            close(*at)
        yield told(out)

    def told(out: list[tuple[bytes, str, int, int]]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.string(), pa.int64(), pa.int32())
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["record", "file", "start", "piece"])

    # Pieces: 0 a whole record; 1 goes on with a record of an earlier range; 2 begins one.
    cut_up = found.mapInArrow(cut, "record binary, file string, start long, piece int")
    text = F.col("record").cast("string").alias("record")
    if not inside:
        # Then no record is cut, and one that is open at the end of its file ends there.
        return cut_up.select(text)
    pieces = cut_up.filter("piece > 0")
    place = Window.partitionBy("file").orderBy("start", "piece")
    pieces = pieces.withColumn("chain", F.sum((F.col("piece") == 2).cast("int")).over(place))
    parts = F.array_sort(F.collect_list(F.struct("start", "piece", F.col("record").cast("string").alias("text"))))
    joined = pieces.groupBy("file", "chain").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("record"))
    return cut_up.filter("piece = 0").select(text).unionByName(joined.select("record"))
