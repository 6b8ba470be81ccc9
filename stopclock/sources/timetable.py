"""Readers and writers. Paths may use any scheme Spark's file system layer knows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.schema import SchemaError, as_schedule
from stopclock.sources.records import INSIDE, OUTSIDE, records, state_after


class OpenQuoteError(ValueError):
    """The message of the job that meets a record cut off inside a quoted field."""

    HINT = "a quoted field is not closed on its line; read with multi_line=True, or open_quotes='keep' to take such lines as bad rows"


def header_lines(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files that have lines, by their first line. The tasks open the files, not the driver.

    Every file is one task, which reads its first line and ends. What comes back is a row for each
    file, as the driver lists the files of any read.
    """
    # A session of its own, so that its settings are nobody else's: no file is cut, and none
    # shares a task with another.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", 1 << 62)
    apart.conf.set("spark.sql.files.openCostInBytes", 1 << 62)
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    first = apart.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    found = first.mapInArrow(lambda batches: islice((b for b in batches if b.num_rows), 1), "file string, line binary")
    groups: dict[str, list[str]] = {}
    for r in found.collect():
        groups.setdefault(bytes(r.line).decode("utf-8", "replace").lstrip("\ufeff").strip(), []).append(r.file)
    return groups


def _read_split(spark: SparkSession, path: str | list[str], file: str) -> DataFrame:
    """Files with one and the same header line, ``file`` among them, cut wherever Spark cuts them."""
    # Spark's own names for the columns; only the header is read for them.
    names = spark.read.option("header", True).option("multiLine", True).csv(file).schema
    as_schedule(spark.createDataFrame([], names))
    line = spark.read.option("lineSep", "\n").text(file).first()[0]
    if state_after(OUTSIDE, line.encode()) == INSIDE:
        raise SchemaError("the header of a file has a line break inside quotes")
    # Line ends of two characters count as one, inside quotes as well. Blank lines are no records.
    two = F.col("record").endswith("\r") | F.lit(line.endswith("\r"))
    record = F.when(two, F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "\r\n", "\n")).otherwise(F.col("record"))
    found = records(spark, path).select(record.alias("record")).filter(F.col("record") != "")
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in names.names)
    parsed = F.from_csv("record", columns, {"multiLine": "true"})
    return as_schedule(found.select(parsed.alias("row")).select("row.*"))


def _read_alike(spark: SparkSession, path: str | list[str], multi_line: bool, open_quotes: str) -> DataFrame:
    """Files with one and the same header line."""
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    # The header of each file is compared with the schema as it is read.
    reader = reader.option("enforceSchema", False)
    table = reader.csv(path)
    if multi_line or open_quotes == "keep":
        return as_schedule(table)
    raw = "_raw_record"
    while raw in table.columns:
        raw = f"_{raw}"
    as_schedule(table)  # a wrong header is reported as such
    # All fields are parsed, whatever a query needs, or the parser would not miss any.
    reader = reader.option("columnNameOfCorruptRecord", raw).option("columnPruning", False)
    marked = reader.schema(f"{table._jdf.schema().toDDL()}, `{raw}` string").csv(path)
    # A record cut off at a line break has too few or too many fields, so the parser
    # keeps its text, and an odd number of quotes. The empty substring makes the test
    # need a column of the data: Spark refuses to read the raw text alone.
    text = F.concat(F.col(raw), F.substring(F.coalesce(F.col(f"`{table.columns[0]}`"), F.lit("")), 1, 0))
    quotes = F.length(F.regexp_replace(text, '[^"]', ""))
    cut_off = F.coalesce(quotes % 2 == 1, F.lit(False))
    message = F.concat(F.lit(f"{OpenQuoteError.HINT}: "), F.substring(F.col(raw), 1, 200))
    return as_schedule(marked.where(F.when(cut_off, F.raise_error(message).cast("boolean")).otherwise(True)).drop(raw))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool | str = False,
    open_quotes: str = "raise",
) -> DataFrame:
    """Timetable CSV with a header row; every column is text.

    The header line of every file is read first, in tasks. Files whose headers differ (in order
    or in other columns) are read apart and put together by column name; a file that
    lacks a column is refused. Every file is also checked against its header as it is read.

    Where quoted fields may hold line breaks there are two ways. ``multi_line="split"`` reads
    the files twice (see ``records``), once right away, and cuts them like any others.
    ``multi_line=True`` is Spark's own way: a file is read once, by one task, however large it is.
    Both give the same rows.

    The default reads line by line, once. A record that a line break inside quotes cuts off
    then fails the job and is shown (``open_quotes="raise"``); with ``"keep"`` its
    pieces are rows, mostly bad ones.
    """
    if open_quotes not in ("raise", "keep"):
        raise ValueError("open_quotes must be 'raise' or 'keep'")
    if multi_line not in (False, True, "split"):
        raise ValueError("multi_line must be False, True or 'split'")
    groups = list(header_lines(spark, path).values())
    read = _read_split if multi_line == "split" and groups else _read_alike
    how = (lambda files: (files[0],)) if read is _read_split else (lambda files: (bool(multi_line), open_quotes))
    if len(groups) < 2:
        return read(spark, path, *how(*groups or [[]]))
    return reduce(DataFrame.unionByName, [read(spark, files, *how(files)) for files in groups])


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return as_schedule(spark.read.parquet(*paths))


def write_result(result: DataFrame, path: str, mode: str = "errorifexists") -> None:
    result.write.mode(mode).parquet(path)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``(line_no, line)`` rows as one text file, in order.

    Meant for report lines, of which there are a few plus one per percentile,
    so a single writing task is right.
    """
    ordered = lines.repartition(1).sortWithinPartitions("line_no")
    ordered.select("line").write.mode(mode).text(path)


def timed_path(path: str, when: datetime | None = None) -> str:
    """``path`` with the date and time appended, to keep one output per run."""
    return f"{path}_{when or datetime.now():%Y%m%d_%H%M%S}"
