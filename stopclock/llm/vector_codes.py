"""Vector code compression: product codebooks fitted by Lloyd's rounds with active entries.

A vector becomes whole numbers, floor(``scale`` * x), and is cut into ``parts`` equal
parts. Every part position has a codebook, which starts as that part of the vectors
with the smallest ids. A round assigns each part to the nearest entry of its codebook
(squared distance, ties to the lower index) and moves each entry to the floored mean
of its parts; unused entries stay. After the last round parts are assigned again.

Each part keeps its entry and the exact distance to it. Where that entry did not move in
the last round, the distances to all entries that did not move either are what they were, so
the part looks at the moved entries alone and changes for one that is nearer, or equally
near and lower. All other parts look at the whole codebook. All arithmetic is on
64-bit whole numbers, so the order of summing changes nothing.

The rows with their state are written to the shared folder once a round and the round before
is dropped; a lost executor costs one round's tasks. What reaches the driver are the codebooks
(``entries`` vectors in all) and their sums, whatever the number of rows.

Defined results: rows whose vector is null, or has a null or non-finite component, are
dropped, as are vectors of another length than the commonest (ties: the longer) that is a
multiple of ``parts``; equal ids and rows stay, those among the smallest ids start
entries in the order of their components, and a null id comes after all others; with
fewer rows than ``entries`` the codebooks are that much smaller; no rows, no codes. Columns that clash
with a result column are replaced, all others kept. Components of ``LIMIT`` and more
after scaling end the job with an error, as their distances would not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopclock.llm import _common as c

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: With 2**10 components the squared distances of one vector stay below 2**63.
LIMIT = 1 << 25


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest of the entries ``book`` (entries x width)."""
    code = np.zeros(len(parts), np.int32)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    for k, entry in enumerate(book):
        away = parts - entry
        d = np.einsum("ij,ij->i", away, away)
        closer = d < best
        best[closer], code[closer] = d[closer], k
    return code, best


def reassign(parts: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``nearest`` gives, from the assignment to the book before ``moved`` entries moved."""
    code, dist = code.copy(), dist.copy()
    lost = moved[code]
    code[lost], dist[lost] = nearest(parts[lost], book)
    kept = np.flatnonzero(~lost)
    for k in np.flatnonzero(moved):
        away = parts[kept] - book[k]
        d = np.einsum("ij,ij->i", away, away)
        change = (d < dist[kept]) | ((d == dist[kept]) & (k < code[kept]))
        at = kept[change]
        dist[at], code[at] = d[change], k
    return code, dist


@dataclass(frozen=True)
class Codebooks:
    """``books`` (parts x entries x width), and which entries the last round moved."""

    books: np.ndarray
    moved: np.ndarray  # parts x entries

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def after(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """The books moved to the means; ``sums`` is shaped like them."""
        means = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], self.books)
        return Codebooks(means, (means != self.books).any(2))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


def whole_vectors(vectors: DataFrame, *, column: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """A struct ``row`` of all columns but the vector, and ``v``, the whole numbers."""
    row = F.struct(*(F.col(f"`{x}`") for x in vectors.columns if x != column))
    x = F.col(f"`{column}`")
    usable = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    fits = F.forall(scaled, lambda e: F.abs(e) < LIMIT)
    checked = F.when(fits, scaled).otherwise(F.raise_error(F.lit(f"a component reaches {LIMIT} after scaling")))
    kept = vectors.filter(usable & (F.size(x) > 0) & (F.size(x) % parts == 0))
    return kept.select(row.alias("row"), checked.cast("array<int>").alias("v"))


def _assign(rows: DataFrame, books: Codebooks, fresh: bool) -> DataFrame:
    """Rows with the columns ``code`` and ``dist``, one number for each part."""
    n_parts, _, width = books.books.shape
    schema = rows.select("row", "v").schema.add("code", T.ArrayType(T.IntegerType())).add("dist", T.ArrayType(T.LongType()))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch["v"], n_parts * width).astype(np.int64).reshape(-1, n_parts, width)
            if not fresh:
                code, dist = _matrix(batch["code"], n_parts), _matrix(batch["dist"], n_parts)
            found = [
                nearest(v[:, p], books.books[p]) if fresh else reassign(v[:, p], books.books[p], books.moved[p], code[:, p], dist[:, p])
                for p in range(n_parts)
            ]
            code, dist = (np.stack([f[k] for f in found], 1) for k in (0, 1))
            columns = [batch["row"], batch["v"], _lists(code.astype(np.int32)), _lists(dist)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "v", "code", "dist"])

    return rows.mapInArrow(assign, schema)


def _sums(state: DataFrame, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise sums and numbers of the parts of every entry."""
    n_parts, n_entries, width = books.books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One more component counts the parts.
        total = np.zeros((n_parts * n_entries, width + 1), np.int64)
        for batch in batches:
            v = _matrix(batch["v"], n_parts * width).astype(np.int64).reshape(-1, width)
            slot = (_matrix(batch["code"], n_parts) + np.arange(n_parts) * n_entries).ravel()
            order = np.argsort(slot, kind="stable")
            used, first = np.unique(slot[order], return_index=True)
            if len(used):
                total[used, :width] += np.add.reduceat(v[order], first, axis=0)
                total[:, width] += np.bincount(slot, minlength=len(total))
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at])], ["at", "x"])

    total = np.zeros(n_parts * n_entries * (width + 1), np.int64)
    # The components of the codebooks, whatever the number of rows.
    for r in state.select("v", "code").mapInArrow(add, "at long, x long").groupBy("at").agg(F.sum("x").alias("x")).collect():
        total[r["at"]] = r["x"]
    total = total.reshape(n_parts, n_entries, width + 1)
    return total[..., :width], total[..., width]


def compress(vectors: DataFrame, *, key: str = "vec_id", column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """The rows without their vector, with ``code`` (an entry for each part) and ``error``
    (their squared distances, summed), and the codebooks."""
    spark = vectors.sparkSession
    folder = c.shared_folder(spark)
    rows = c.stored(whole_vectors(vectors, column=column, parts=parts, scale=scale), folder, "rows")
    # A row for each length of a vector, of which the first is wanted.
    lengths = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = lengths["length"] if lengths else parts
    rows = rows.filter(F.size("v") == length)
    first = F.col(f"row.`{key}`")
    seeds = [r.v for r in rows.orderBy(first.asc_nulls_last(), "v").select("v").limit(entries).collect()]
    seeds = np.array(seeds, np.int64).reshape(len(seeds), parts, length // parts).transpose(1, 0, 2)
    books = Codebooks(seeds, np.ones(seeds.shape[:2], bool))
    state = c.stored(_assign(rows, books, True), folder, "round0")
    for k in range(1, rounds + 1):
        books = books.after(*_sums(state, books))
        after = c.stored(_assign(state, books, False), folder, f"round{k}")
        c.discard(spark, f"{folder}/{'rows' if k == 1 else f'round{k - 1}'}")
        if k == 1:
            c.discard(spark, f"{folder}/round0")
        state = after
    kept = [x for x in vectors.columns if x != column and x.lower() not in ("code", "error")]
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, x: a + x)
    return state.select(*(F.col(f"row.`{x}`") for x in kept), "code", error.alias("error")), books


def with_group_error(coded: DataFrame, by: str = "label") -> DataFrame:
    """Add ``label_error``, the error summed over equal values of ``by``, nulls together.

    The sums are joined back, so a frequent value is not one task's.
    """
    of, total = c.fresh(coded, "of"), c.fresh(coded.drop("label_error"), "label_error")
    sums = coded.groupBy(F.col(by).alias(of)).agg(F.sum("error").alias(total))
    return coded.drop("label_error").join(sums, F.col(by).eqNullSafe(F.col(of))).drop(of)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    coded, books = compress(vectors)
    digits = F.transform("code", lambda k: F.lower(F.lpad(F.hex(k), 2, "0")))
    coded = with_group_error(coded.withColumn("code", F.array_join(digits, "")))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql() -> str:
    """Lloyd's rounds written out, each over the whole codebook."""
    width = f"(len(v) // {PARTS})"
    steps = [
        f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), split AS (
  SELECT r, p, d, v[p * {width} + d + 1] AS x FROM kept, unnest(range(0, {PARTS})) AS t(p), unnest(range(0, {width})) AS u(d)
), book0 AS (
  SELECT p, r - 1 AS e, d, x FROM split WHERE r <= {ENTRIES}
)"""
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, min(far) AS far, arg_min(e, far * {ENTRIES} + e) AS e FROM (
    SELECT r, p, e, CAST(sum((s.x - b.x) * (s.x - b.x)) AS BIGINT) AS far FROM split s JOIN book{k} b USING (p, d) GROUP BY r, p, e)
  GROUP BY r, p
)""")
        if k < ROUNDS:
            steps.append(f"""mean{k} AS (
  SELECT p, e, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM split JOIN near{k} USING (r, p) GROUP BY p, e, d
), book{k + 1} AS MATERIALIZED (
  SELECT p, e, d, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM book{k} LEFT JOIN mean{k} USING (p, e, d)
)""")
    return "WITH " + ", ".join(steps) + f""", codes AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r
), labelled AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN codes USING (r) GROUP BY label
)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, d)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN codes USING (r) JOIN labelled l ON l.label IS NOT DISTINCT FROM kept.label"""


OP12_SQL = _sql()
