"""Removal of long repeated byte strings with a logarithmic family of suffix indexes.

A byte goes if some ``length``-byte string that covers it also starts anywhere else.

*Sampled suffixes.* Of the suffixes of a text only some are indexed: in every string
of ``length`` bytes, the place whose next ``GRAM`` bytes have the smallest hash (the
leftmost, if equal). Equal strings choose the same place, wherever they stand, so two
equal strings always meet at an indexed suffix. The strings that chose one suffix follow
each other; the bytes they span are the suffix's *block*. On ordinary text one suffix in
``length`` * 0.4 is kept.

*Index family.* Documents arrive in batches. The index of a batch holds its
sampled suffixes by their fingerprints, one entry for each (equal prefixes come
together, which is all that a search for long matches needs; nothing is sorted),
with the fingerprint of its block, or two where blocks differ. A new batch is merged with
all existing levels in one hash aggregation by fingerprint: what stands in the batch and anywhere
else is a match. Levels of the size of what is inserted are merged with it, so level k
holds 2**k batches and every entry is rewritten a logarithmic number of times.

*Exact strings.* Suffixes without a match end here. A matched suffix whose blocks are
all equal marks its whole block. Where blocks differ (at the ends of a copied
passage), each distinct block is taken once; equal blocks mark each other, and all others
are compared in steps of a 16-byte grid: strings of a step share a core of 184 bytes, and
without an equal core elsewhere none is repeated; blocks equal in all bytes of a step repeat
all its strings; only what is left is compared string by string.
Each comparison is a count of fingerprints (in all, 128 bits and the place), so no group of
blocks ever meets in one task.

Texts are known by 96 bits of their content, so copies of a text share their marks.

Defined results: a null text is empty; texts shorter than ``length`` keep all bytes; equal
rows and ids stay and count as copies of each other; a null id stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.llm import _common as c

LENGTH = 200
GRAM = 32
GRID = 16
BATCHES = 4
_PIECE = 1 << 18  # windows that are worked on at once
_PLACE_BITS = 20

_rng = np.random.default_rng(1)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_ODD = _rng.integers(0, 1 << 63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place, by doubling."""
    h = _BYTE[data]
    size, k = 1, 0
    while size < GRAM:
        h = h[:-size] * _ODD[k] + h[size:]
        h ^= h >> np.uint64(29)
        size, k = 2 * size, k + 1
    return h * _ODD[7]


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each ``span`` neighbours, by doubling."""
    size = 1
    while 2 * size <= span:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = span - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def sampled(data: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(fingerprint of the suffix, fingerprint of its block, first string of the block,
    number of strings, place of the suffix in the block) of the indexed suffixes."""
    for begin in range(0, len(data) - length + 1, _PIECE):
        piece = data[begin : begin + _PIECE + length - 1]
        grams = _gram_hashes(np.frombuffer(piece, np.uint8))
        low = np.uint64((1 << _PLACE_BITS) - 1)
        keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        place = (_smallest(keyed, length - GRAM + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        number = np.diff(np.append(first, len(place)))
        at = place[first]
        block = [xxhash.xxh64_intdigest(piece[a:b], 1) for a, b in zip(first.tolist(), (first + number + length - 1).tolist(), strict=True)]
        yield grams[at].view(np.int64), np.array(block, np.uint64).view(np.int64), first + begin, number, at - first


_SAMPLED = "t long, u long, h long, block long, first long, number int, at int"


def suffixes(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """The sampled suffixes of ``texts`` (``t``, ``u``, ``text``)."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            size = 0
            for t, u, text in zip(batch["t"].to_numpy(), batch["u"].to_numpy(), batch["text"], strict=True):
                for found in sampled(text.as_buffer().to_pybytes(), length):
                    n = len(found[0])
                    parts.append((np.full(n, t), np.full(n, u), *found))
                    size += n
                if size > 200_000:
                    yield _arrow(parts)
                    parts, size = [], 0
            if parts:
                yield _arrow(parts)

    return texts.mapInArrow(sample, _SAMPLED)


def _arrow(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, np.int32, np.int32)
    columns = [np.concatenate([p[k] for p in parts]).astype(kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["t", "u", "h", "block", "first", "number", "at"])


class IndexFamily:
    """Levels of suffix indexes; level k holds 2**k batches or is empty.

    An entry has the suffix fingerprint ``h``, the smallest and largest fingerprint of its
    blocks (``low``, ``high``) and ``many``, true if the suffix occurs more than once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder
        self.levels: dict[int, DataFrame] = {}
        self.inserted = 0

    def insert(self, batch: DataFrame) -> DataFrame:
        """Index the suffixes ``h``, ``block`` of a batch. Returns those of its suffixes that
        occur elsewhere too, with ``low`` and ``high`` over all their occurrences."""
        new = batch.select("h", F.col("block").alias("low"), F.col("block").alias("high"), F.lit(1).alias("n"), F.lit(-1).alias("level"))
        sources = [new]
        for k, level in self.levels.items():
            sources.append(level.select("h", "low", "high", F.when(F.col("many"), 2).otherwise(1).alias("n"), F.lit(k).alias("level")))
        top = 0
        while top in self.levels:
            top += 1
        joins = F.col("level") < top  # the batch itself, and the levels that it fills up
        here = F.col("level") == -1
        merged = (
            reduce(DataFrame.unionByName, sources)
            .groupBy("h")
            .agg(
                F.max(here).alias("new"),
                F.sum("n").alias("n"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
                F.sum(F.when(joins, F.col("n"))).alias("n_here"),
                F.min(F.when(joins, F.col("low"))).alias("low_here"),
                F.max(F.when(joins, F.col("high"))).alias("high_here"),
            )
        )
        matched = F.col("new") & (F.col("n") > 1)
        step = c.stored(
            merged.filter(matched | F.col("n_here").isNotNull()).select(
                "h",
                F.col("n_here").isNotNull().alias("kept"),
                (F.col("n_here") > 1).alias("many"),
                "low_here",
                F.when(F.col("high_here") != F.col("low_here"), F.col("high_here")).alias("high_here"),
                matched.alias("matched"),
                F.when(matched, F.col("low")).alias("low"),
                F.when(matched, F.col("high")).alias("high"),
            ),
            self.folder,
            f"insert{self.inserted}",
        )
        self.inserted += 1
        for k in range(top):
            del self.levels[k]
        self.levels[top] = step.filter("kept").select("h", F.col("low_here").alias("low"), F.coalesce("high_here", "low_here").alias("high"), "many")
        return step.filter("matched").select("h", "low", "high")


def _grid_cells(blocks: DataFrame, length: int) -> DataFrame:
    """The grid steps of every block: ``core`` is the hash of the string that all strings of
    the step contain, ``wide`` that of the bytes they cover together."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, block, cell, core, wide = [], [], [], [], []
            for row in batch.itertuples(index=False):
                for j in range((row.at - row.number + 1) // GRID, row.at // GRID + 1):
                    # Strings that begin d bytes before the suffix, GRID * j <= d < GRID * (j + 1).
                    near, far = _reach(j, row.at, row.number)
                    begin = row.at - GRID * j
                    h.append(row.h)
                    block.append(row.block)
                    cell.append(j)
                    core.append(xxhash.xxh64_intdigest(row.piece[begin : begin + length - GRID], 3))
                    wide.append(xxhash.xxh64_intdigest(row.piece[row.at - far : row.at - near + length], 4 + near + 1000 * far))
            hashes = {k: np.array(v, np.uint64).view(np.int64) for k, v in (("core", core), ("wide", wide))}
            yield pd.DataFrame({"h": h, "block": block, "cell": cell, **hashes})

    return blocks.mapInPandas(cells, "h long, block long, cell int, core long, wide long")


def _reach(cell: int, at: int, number: int) -> tuple[int, int]:
    """The nearest and farthest beginning, before the suffix, of the block's strings in a grid step."""
    return max(GRID * cell, at - number + 1), min(GRID * cell + GRID - 1, at)


def _strings(blocks: DataFrame, length: int) -> DataFrame:
    """Each string of a block in the given ``cells``: its distance before the suffix and its hash."""

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h, block, before, held = [], [], [], []

        def rows() -> pd.DataFrame:
            out = pd.DataFrame({"h": h, "block": block, "before": before, "held": np.array(held, np.uint64).view(np.int64)})
            for column in (h, block, before, held):
                column.clear()
            return out

        for batch in batches:
            for row in batch.itertuples(index=False):
                for j in row.cells:
                    near, far = _reach(j, row.at, row.number)
                    for d in range(near, far + 1):
                        h.append(row.h)
                        block.append(row.block)
                        before.append(d)
                        held.append(xxhash.xxh64_intdigest(row.piece[row.at - d : row.at - d + length], 2))
                if len(h) > 100_000:
                    yield rows()
        yield rows()

    return blocks.mapInPandas(strings, "h long, block long, before int, held long")


def repeated_in_blocks(blocks: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """``h``, ``block`` and ``marks``: the places in the block, from 0, of strings that occur
    elsewhere. ``blocks`` has each distinct block once, with the number ``n`` of its occurrences."""
    plain = blocks.select("h", "block", "at", "number", "piece")
    cells = c.stored(_grid_cells(plain, length), folder, "cells")
    # How many blocks cover the same bytes in this step, one of them, and how many kinds share the core.
    alike = cells.groupBy("h", "cell", "core", "wide").agg(F.count(F.lit(1)).alias("same"), F.min("block").alias("one"))
    alike = c.stored(alike, folder, "alike")
    kinds = alike.groupBy("h", "cell", "core").agg(F.count(F.lit(1)).alias("kinds"))
    shared = c.stored(alike.join(kinds, ["h", "cell", "core"]).filter("same > 1 OR kinds > 1"), folder, "alike_or_akin")
    # Of blocks alike in a step, all strings of the step are repeated, and one is compared with the other kinds.
    unsure = (F.col("kinds") > 1) & ((F.col("same") == 1) | (F.col("one") == F.col("block")))
    steps = c.stored(
        cells.join(shared, ["h", "cell", "core", "wide"])
        .groupBy("h", "block")
        .agg(
            F.collect_list(F.when(F.col("same") > 1, F.col("cell"))).alias("whole"),
            F.collect_list(F.when(unsure, F.col("cell"))).alias("cells"),
        ),
        folder,
        "steps",
    )
    unsure = steps.filter(F.size("cells") > 0).select("h", "block", "cells")
    strings = c.stored(_strings(plain.join(unsure, ["h", "block"]), length), folder, "strings")
    for done in ("cells", "alike", "alike_or_akin"):
        c.discard(blocks.sparkSession, f"{folder}/{done}")
    met = strings.groupBy("h", "before", "held").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    met = c.stored(met, folder, "met")
    few = strings.join(met, ["h", "before", "held"]).groupBy("h", "block").agg(F.collect_list("before").alias("before"))
    found = blocks.select("h", "block", "n", "at", "number").join(steps.select("h", "block", "whole"), ["h", "block"], "left")
    found = found.join(few, ["h", "block"], "left")
    at, number, none = F.col("at"), F.col("number"), F.array().cast("array<int>")
    every = F.sequence(F.lit(0), number - 1)
    in_steps = F.filter(every, lambda p: F.array_contains("whole", F.floor((at - p) / GRID).cast("int")))
    single = F.transform("before", lambda d: at - d)
    marks = F.when(F.col("n") > 1, every).otherwise(
        F.array_union(F.coalesce(F.when(F.size("whole") > 0, in_steps), none), F.coalesce(single, none))
    )
    return found.select("h", "block", marks.alias("marks")).filter(F.size("marks") > 0)


def _cut(length: int):
    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    def cut(texts: pd.Series, whole: pd.Series, marked: pd.Series) -> pd.DataFrame:
        rows = []
        for data, wholes, marks in zip(texts, whole, marked, strict=True):
            step = np.zeros(len(data) + 1, np.int64)
            for w in () if wholes is None else wholes:
                step[w["first"]] += 1
                step[w["first"] + w["number"] + length - 1] -= 1
            for m in () if marks is None else marks:
                at = m["first"] + np.asarray(m["marks"], np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + length, -1)
            gone = np.cumsum(step[:-1]) > 0
            edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((int(gone.sum()), len(edges), hashlib.sha256(kept).hexdigest(), edges.tolist()))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "spans"])

    return cut


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (removed
    bytes as [first, after the last]), one row per document."""
    spark = docs.sparkSession
    folder = c.shared_folder(spark)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.select("doc_id", data.alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("t"), F.crc32("text").alias("u"), "text")

    found = suffixes(texts.filter(F.octet_length("text") >= length).select("t", "u", "text"), length)
    found = found.withColumn("batch", F.pmod("t", F.lit(batches)).cast("int"))
    found.write.partitionBy("batch").parquet(f"{folder}/suffixes")
    # A schema given by hand: with no suffix at all there is no file to ask.
    found = spark.read.schema(f"{_SAMPLED}, batch int").parquet(f"{folder}/suffixes")

    family = IndexFamily(spark, folder)
    matches = [family.insert(found.filter(F.col("batch") == k)) for k in range(batches)]
    shared = reduce(DataFrame.unionByName, matches).groupBy("h").agg((F.min("low") == F.max("high")).alias("alike"))
    # Stored, as this and the joins like it below have a frequent key on the other side, and the engine
    # splits that only between two sides that come straight from a shuffle.
    shared = c.stored(shared, folder, "shared")

    # Only matched suffixes go on, gathered by text; copies of a text add nothing to a set.
    block = F.struct("first", "number", "at", "h", "block")
    by_text = (
        found.drop("batch")
        .join(shared, "h")
        .groupBy("t", "u")
        .agg(
            F.collect_set(F.when(F.col("alike"), F.struct("first", "number"))).alias("whole"),
            F.collect_set(F.when(~F.col("alike"), block)).alias("mixed"),
        )
    )
    by_text = c.stored(by_text, folder, "by_text")
    for done in ("suffixes", "shared", *(f"insert{k}" for k in range(batches))):
        c.discard(spark, f"{folder}/{done}")
    some = c.stored(texts.join(by_text, ["t", "u"]), folder, "matched")
    c.discard(spark, f"{folder}/by_text")

    piece = F.expr(f"substring(text, int(b.first + 1), int(b.number + {length - 1}))")
    blocks = some.select("text", F.explode("mixed").alias("b")).select("b.h", "b.block", "b.at", "b.number", piece.alias("piece"))
    blocks = c.stored(
        blocks.groupBy("h", "block", "at", "number").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("piece")), folder, "blocks"
    )
    marks = c.stored(repeated_in_blocks(blocks, folder, length), folder, "marks")
    for done in ("blocks", "steps", "strings", "met"):
        c.discard(spark, f"{folder}/{done}")
    mixed = some.select("t", "u", F.explode("mixed").alias("b")).select("t", "u", "b.h", "b.block", "b.first").distinct()
    marked = (
        mixed.join(marks, ["h", "block"]).groupBy("t", "u").agg(F.collect_list(F.struct("first", "marks")).alias("marked"))
    )
    touched = (
        some.select("doc_id", "t", "u", "text", "whole")
        .join(marked, ["t", "u"], "left")
        .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), _cut(length)("text", "whole", "marked").alias("r"))
        .select("doc_id", "n_bytes", "r.*")
    )
    untouched = (
        texts.select("doc_id", "t", "u", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("kept_sha256"))
        .join(some.select("t", "u").distinct(), ["t", "u"], "left_anti")
        .select(
            "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
            "kept_sha256", F.array().cast("array<array<long>>").alias("spans"),
        )
    )
    return touched.unionByName(untouched)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
