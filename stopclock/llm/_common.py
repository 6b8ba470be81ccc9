"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.sources.folders import shared_folder

__all__ = ["discard", "fresh", "is_held_out", "n_words", "shared_folder", "stored"]

#: Shuffle files go when the query that made them is done, not when the driver's
#: garbage is next collected. The setting is the session's while a table is written, so
#: operators that share a session should run one after the other.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, folder: str | None = None, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut,
    and nothing lost with an executor."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, True)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table that no result reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def is_held_out(doc_id: Column) -> Column:
    """One fold of five by the checksum of the id; a null id is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def n_words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space. Null: none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
