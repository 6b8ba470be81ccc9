"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` places on a ring of 2**16 slots. A document
belongs to the slot of its id's hash and goes clockwise to the first shard that still has
room, so it moves on only where a shard is full. The loads are bounded by
``capacities``: rows may be at most one apart (``slack`` 0), or a shard may hold
up to (1 + slack) times the mean.

Documents arrive slot by slot around the ring. The outcome of this order depends on
the number of documents in each slot alone, so only those counts (65,536 at most,
whatever the input) come to the driver; they give each slot its runs of
(shard, first place). A document's shard and place then follow from its rank within
its slot. Ranks are numbered within cells: a slot has one for about every ``rows_per_cell`` of
its rows, dealt by a hash of the whole row, so rows that share an id part. Equal rows part only by a
column that tells them apart (``spread``), such as a stored row number.

Defined results: a null id hashes like an empty text; repeated ids share a slot, and equal
rows take different places in no stated order; a null text has size 0 + 8 and
checksum 0; columns that clash with a result column are replaced, all others kept; a text of any
length is only measured; no documents, no rows.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopclock.llm import _common as c

SLOTS = 1 << 16
SHARDS = 24
VIRTUAL_NODES = 128
ROWS_PER_CELL = 20_000


@dataclass(frozen=True)
class Ring:
    """The shard that owns each virtual node, by place on the ring."""

    places: tuple[int, ...]
    owners: tuple[int, ...]

    @classmethod
    def of(cls, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> Ring:
        # A place depends on its shard and number only: another shard moves none of them.
        nodes: dict[int, int] = {}
        for shard in range(shards):
            for node in range(virtual_nodes):
                nodes.setdefault(zlib.crc32(f"shard {shard} node {node}".encode()) % SLOTS, shard)
        places = sorted(nodes)
        return cls(tuple(places), tuple(nodes[p] for p in places))

    def clockwise(self, slot: int):
        """The owners from ``slot`` on, once around; a shard may come several times."""
        at = bisect.bisect_left(self.places, slot)
        n = len(self.places)
        return (self.owners[(at + k) % n] for k in range(n))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most rows of each shard: whole numbers, at most one apart, enough for all."""
    if slack > 0:
        return [int((1 + slack) * rows / shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def fill(counts: dict[int, int], ring: Ring, room: list[int]) -> list[tuple[int, int, int, int]]:
    """(slot, first rank, shard, place of that rank in the shard), for ranks from 0."""
    room, held, runs = list(room), [0] * len(room), []
    for slot in sorted(counts):
        rank, left = 0, counts[slot]
        for shard in ring.clockwise(slot):
            if not left:
                break
            if take := min(left, room[shard]):
                runs.append((slot, rank, shard, held[shard]))
                rank, left = rank + take, left - take
                room[shard] -= take
                held[shard] += take
        if left:
            raise ValueError("the shards have no room for all rows")
    return runs


def _hash(key: Column) -> Column:
    return F.xxhash64(F.coalesce(key.cast("string"), F.lit("")))


def _local(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A small table of the driver's rows. From Arrow it is a local relation, where a list of
    tuples would start Python workers in the executors just to unpickle it."""
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), columns.values(), strict=True)]
    return spark.createDataFrame(pa.table(dict(zip(columns, arrays, strict=True))))


def shard(docs: DataFrame, *, key: str = "doc_id", shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, slack: float = 0.0, rows_per_cell: int = ROWS_PER_CELL, spread: str | None = None) -> DataFrame:
    """Add ``shard`` and ``slot`` (its place in the shard, gapless from 0); ``spread`` is dropped.

    ``docs`` is read three times: to count slots, to count cells, and for the result.
    """
    spark = docs.sparkSession
    place = F.pmod(_hash(F.col(key)), F.lit(SLOTS)).cast("int")
    # One struct holds the row, so no column of it can clash with the ones used here.
    row = F.struct(*(F.col(f"`{x}`") for x in docs.columns if x.lower() not in ("shard", "slot") and x != spread))
    hashable = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    rows = docs.select(row.alias("row"), place.alias("place"), F.xxhash64(*hashable).alias("whole"), F.col(key).alias("key"))
    counts = {r["place"]: r["count"] for r in rows.groupBy("place").count().collect()}  # SLOTS rows at most
    runs = fill(counts, Ring.of(shards, virtual_nodes), capacities(sum(counts.values()), shards, slack))
    # Slots, and a run more wherever a shard fills up: bounded by SLOTS + shards.
    table = _local(spark, runs or [(-1, 0, 0, 0)], place_r=pa.int32(), first=pa.int64(), shard=pa.int32(), slot=pa.int64())
    table = table.groupBy("place_r").agg(F.array_sort(F.collect_list(F.struct("first", "shard", "slot"))).alias("runs"))
    cells_of = [(p, 1 + (n - 1) // rows_per_cell) for p, n in counts.items() if n > rows_per_cell] or [(-1, 1)]
    cells_of = _local(spark, cells_of, place_n=pa.int32(), cells=pa.int32())
    rows = rows.join(F.broadcast(cells_of), F.col("place") == F.col("place_n"), "left")
    rows = rows.withColumn("cell", F.pmod("whole", F.coalesce("cells", F.lit(1))).cast("int"))
    before = Window.partitionBy("place").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("place", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("place").alias("place_c"), F.col("cell").alias("cell_c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    # Slots that are one cell begin at 0; only the others are looked up, a row for each of their cells.
    cells = c.stored(cells.filter("before > 0"))
    within = Window.partitionBy("place", "cell").orderBy("key", "whole")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1)
    ranked = ranked.join(cells, (F.col("place") == F.col("place_c")) & (F.col("cell") == F.col("cell_c")), "left")
    ranked = ranked.withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    ranked = ranked.join(F.broadcast(table), F.col("place") == F.col("place_r"))
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    return ranked.withColumn("run", run).select(
        "row.*", F.col("run.shard").alias("shard"), (F.col("run.slot") + F.col("rank") - F.col("run.first")).alias("slot")
    )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and 8) and ``text_crc32``."""
    data = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data.cast("binary")).alias("text_crc32"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    docs = c.stored(docs.withColumn("number", F.monotonically_increasing_id()))
    return shard(docs, spread="number").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
