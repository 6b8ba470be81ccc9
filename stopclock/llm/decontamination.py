"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one
window), seen as its set of word shingles. A document matches where a run of
words of the same length equals the window, so it contains all of its
shingles: at full containment the prefix that any match must share is one
shingle. Shingles are ordered by rarity, counted over the whole corpus, and each
window is found by its rarest one:

1. count, over all documents, the shingles that occur in the benchmark;
2. index every window by its rarest shingle (ties: the smaller hash, then place) and its place;
3. join the shingles of the documents with that index; the place fixes where the
   window would begin, and what would begin before the document or end after it
   is out (positional and length bounds);
4. compare what is left word by word, and mark the words hit.

Windows, shingles, counts and index are tables, and so are what the documents have of them: no part
of the benchmark is on the driver or in every task but a bitmap of at most ``2 ** MAX_BITS``
bits, which keeps shingles that the benchmark lacks out of the shuffles (what it lets pass by
chance finds no partner). A shingle of a document takes the words around it along, so that
the join can compare. Documents are read three times, whatever the size of the benchmark: to
count, to search, and for the result. They are told apart by the digest of their text, so copies are
one, and texts are not shuffled but for joining the result to them where it is too large to send.

Defined results: null or wordless texts have no words and hit nothing; items
without words are left out; equal items count each by its own id; the windows of an item without an
id mark words like all others, but it is not listed; equal document rows stay, each with its
result; a result column that clashes with a document's column replaces it; a text of any
length is read whole, in pieces; no documents, no rows; no benchmark, no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from stopclock.llm import _common as c

WINDOW = 13
SHINGLE = 3
#: Contaminated: at least one word hit, and one in this many.
HIT_SHARE = 20
MAX_BITS = 26
_PIECE = 1 << 20

#: Bytes that are no part of a word become spaces, A-Z become a-z.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: An odd number; byte k of a stretch weighs its k-th power, and the inverse takes a power back.
_ROOT = 0x9E3779B97F4A7C15
_BACK = pow(_ROOT, -1, 1 << 64)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the root and of its inverse, kept for the next time."""
    if len(_POWERS.get(0, ((),))[0]) < n:
        size = max(n, 2 * _PIECE)
        _POWERS[0] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size, x, np.uint64)]) for x in (_ROOT, _BACK))
    return _POWERS[0]


class Stretch:
    """The words of several texts or pieces of texts, which lie in one array of bytes.

    Each piece has leading words, which belong to the piece before, then its own, then following ones.
    """

    def __init__(self, pieces: list[tuple[int, int, int, int, bytes]]):
        """(number of the text, place of the first word in it, leading words, own words, bytes)."""
        data = np.frombuffer(b" ".join(p[4] for p in pieces) + b" ", np.uint8)
        self.data = data
        edges = np.flatnonzero(np.diff(data != 32, prepend=False))
        self.start, self.end = edges[::2], edges[1::2]
        begins = np.cumsum([0] + [len(p[4]) + 1 for p in pieces[:-1]])
        self.piece = np.searchsorted(begins, self.start, side="right") - 1
        self.first = np.searchsorted(self.piece, np.arange(len(pieces)))
        self.text, self.base, self.lead, own = (np.array([p[k] for p in pieces], np.int64) for k in range(4))
        within = np.arange(len(self.start)) - self.first[self.piece]
        self.own = (within >= self.lead[self.piece]) & (within < (self.lead + own)[self.piece])
        self.place = within + self.base[self.piece]
        up, down = _powers(len(data) + 1)
        summed = np.r_[np.uint64(0), np.cumsum((data + np.uint64(1)) * up[: len(data)])]
        self.hash = _mixed((summed[self.end] - summed[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each own shingle the number of its first word, and its hash."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.own[:n] & (self.piece[size - 1 :] == self.piece[:n]))
        h = np.full(len(at), size, np.uint64)
        for k in range(size):
            h = h * np.uint64(_ROOT) + self.hash[at + k]
        return at, _mixed(h)

    def around(self, at: int, reach: int) -> tuple[int, bytes]:
        """Up to ``reach`` words before word ``at`` and after it, and how many there are before."""
        piece = self.piece[at]
        low = max(self.first[piece], at - reach)
        high = min(self.first[piece + 1] if piece + 1 < len(self.first) else len(self.start), at + reach + 1)
        return at - low, self.data[self.start[low] : self.end[high - 1]].tobytes()


def _step(data: bytes, at: int, n: int, forward: bool) -> int:
    """The byte ``n`` words further on, or back."""
    for _ in range(n):
        if forward:
            while data[at : at + 1] == b" ":
                at += 1
            found = data.find(b" ", at)
            at = len(data) if found < 0 else found
        else:
            while at and data[at - 1 : at] == b" ":
                at -= 1
            at = data.rfind(b" ", 0, at) + 1
    return at


def pieces(number: int, data: bytes, reach: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """A text as ``Stretch`` takes it: whole, or in pieces with ``reach`` words more on either side."""
    if len(data) <= _PIECE:
        yield number, 0, 0, len(data), data
        return
    at, before = 0, 0
    while at < len(data):
        end = min(len(data), at + _PIECE)
        if end < len(data):
            cut = data.rfind(b" ", at + 1, end)
            end = cut if cut > 0 else _step(data, end, 1, True)
        low, high = _step(data, at, reach, False), _step(data, end, reach, True)
        lead, own = len(data[low:at].split()), len(data[at:end].split())
        yield number, before - lead, lead, own, data[low:high]
        at, before = end, before + own


def stretches(texts: Iterator[bytes | None], reach: int) -> Iterator[Stretch]:
    held, size = [], 0
    for number, text in enumerate(texts):
        for piece in pieces(number, (text or b"").translate(_TABLE), reach):
            held.append(piece)
            size += len(piece[4]) + 1
            if size >= _PIECE:
                yield Stretch(held)
                held, size = [], 0
    if held:
        yield Stretch(held)


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``words`` (joined by spaces), ``size`` and ``item`` of every window of every item."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"], strict=True):
                found = words(text)
                size = min(window, len(found))
                if size:
                    runs = [b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
                    yield pd.DataFrame({"words": runs, "size": size, "item": [item] * len(runs)})

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInPandas(cut, "words binary, size int, item string")


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``w``, ``at``, ``length`` and ``h`` of the shingles of each window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            for stretch in stretches((x.as_py() for x in batch["words"]), shingle):
                for length in range(1, shingle + 1):
                    at, h = stretch.shingles(length)
                    number = stretch.text[stretch.piece[at]]
                    mine = np.minimum(shingle, sizes[number]) == length
                    columns = batch["w"].to_numpy()[number[mine]], stretch.place[at[mine]], np.full(mine.sum(), length), h[mine].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["w", "at", "length", "h"])

    return windows.select("w", "size", "words").mapInArrow(cut, "w long, at long, length long, h long")


class Bitmap:
    """Marks the hashes of some table; others are marked by chance, one in about 32 unless there are very many."""

    def __init__(self, hashes: DataFrame, rows: int, max_bits: int):
        self.bits = min(max_bits, max(12, (32 * rows).bit_length()))
        slot = F.shiftrightunsigned("h", 64 - self.bits)
        words = hashes.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("bits")
        )
        # 2 ** (bits - 6) rows at most, whatever the size of the benchmark.
        found = words.toArrow()
        table = np.zeros(1 << (self.bits - 6), np.int64)
        table[found["word"].to_numpy()] = found["bits"].to_numpy()
        self.table = table.view(np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h >> np.uint64(64 - self.bits)
        return (self.table[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def shingle_counts(texts: DataFrame, marked: Bitmap, lengths: list[int]) -> DataFrame:
    """``h`` and ``n``, how often each marked shingle occurs in the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for stretch in stretches((x.as_py() for x in batch["data"]), max(lengths)):
                for length in lengths:
                    _, h = stretch.shingles(length)
                    held.append(np.unique(h[marked.has(h)], return_counts=True))
                if sum(len(h) for h, _ in held) > 1_000_000:
                    yield told(held)
                    held = []
        if held:
            yield told(held)

    def told(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, place = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        n = np.bincount(place, np.concatenate([x for _, x in held]), len(h)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return texts.select("data").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def occurrences(texts: DataFrame, marked: Bitmap, lengths: list[int], window: int) -> DataFrame:
    """Where documents have marked shingles: ``digest``, ``place``, ``h``, and the words ``around``,
    of which ``back`` come before it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stretch in stretches((x.as_py() for x in batch["data"]), window):
                number, place, found, back, around = [], [], [], [], []
                for length in lengths:
                    at, h = stretch.shingles(length)
                    mine = marked.has(h)
                    for k in at[mine].tolist():
                        before, text = stretch.around(k, window - 1)
                        back.append(before)
                        around.append(text)
                    number.append(stretch.text[stretch.piece[at[mine]]])
                    place.append(stretch.place[at[mine]])
                    found.append(h[mine].view(np.int64))
                columns = [
                    batch["digest"].take(pa.array(np.concatenate(number))), pa.array(np.concatenate(place)), pa.array(np.concatenate(found)),
                    pa.array(back, pa.int32()), pa.array(around, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "place", "h", "back", "around"])

    return texts.mapInArrow(search, "digest binary, place long, h long, back int, around binary")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``n_items``, ``items``, ``spans`` and ``contaminated``.

    ``items`` are the ids of items with occurring windows, sorted as strings; ``spans``
    the hit runs as [first word, word after the last].
    """
    folder = c.shared_folder(docs.sparkSession)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    digest = F.unhex(F.md5(data))
    texts = docs.select(digest.alias("digest"), data.alias("data"))
    owned = c.stored(benchmark_windows(benchmark, window).distinct(), folder, "owned")
    windows = owned.groupBy("words", "size").agg(F.count(F.lit(1)).alias("owners"))
    windows = c.stored(windows.select(F.monotonically_increasing_id().alias("w"), "words", "size"), folder, "windows")
    owners = owned.filter("item IS NOT NULL").join(windows.select("w", F.col("words").alias("of")), F.col("words") == F.col("of")).select("w", "item")
    shingles = c.stored(window_shingles(windows, shingle), folder, "shingles")
    # As many as a shingle has words at most.
    lengths = sorted(r["length"] for r in shingles.select("length").distinct().collect()) or [1]
    counts = shingle_counts(texts, Bitmap(shingles, shingles.count(), max_bits), lengths)
    rarest = shingles.join(counts.select(F.col("h").alias("counted"), "n"), F.col("h") == F.col("counted"), "left")
    rarest = rarest.groupBy(F.col("w").alias("of")).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "at")).alias("rarest"))
    index = windows.join(rarest, F.col("w") == F.col("of")).select("w", "words", "size", F.col("rarest.h").alias("key"), F.col("rarest.at").alias("at"))
    index = c.stored(index, folder, "index")
    marked = Bitmap(index.select(F.col("key").alias("h")), index.count(), max_bits)
    found = occurrences(texts, marked, lengths, window).join(index, F.col("h") == F.col("key"))
    # Positional and length bounds, then the words themselves.
    around, begin = F.split(F.col("around").cast("string"), " +"), F.col("back") - F.col("at")
    inside = (begin >= 0) & (begin + F.col("size") <= F.size(around))
    run = F.array_join(F.slice(around, F.greatest(begin + 1, F.lit(1)).cast("int"), F.col("size")), " ")
    found = found.filter(inside & (run == F.col("words").cast("string")))
    hits = found.select("digest", (F.col("place") - F.col("at")).alias("first"), (F.col("place") - F.col("at") + F.col("size")).alias("last"), "w")
    hits = c.stored(hits.distinct(), folder, "hits")
    result = c.stored(_spans(hits).join(_items(hits, owners), ["digest"], "left"), folder, "result")
    of, own = c.fresh(docs, "of"), c.fresh(docs, "own")
    result = result.select(F.col("digest").alias(own), *(F.col(x).alias(f"{own}_{x}") for x in ("n_hit", "spans", "items")))
    kept = docs.drop("n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    return (
        kept.withColumns({"n_words": _n_words(data), of: digest})
        .join(result, F.col(of) == F.col(own), "left")
        .withColumn("n_hit", F.coalesce(F.col(f"{own}_n_hit"), F.lit(0).cast("long")))
        .withColumn("items", F.coalesce(F.col(f"{own}_items"), F.array().cast("array<string>")))
        .withColumn("spans", F.coalesce(F.col(f"{own}_spans"), F.array().cast("array<array<int>>")))
        .drop(of, own, f"{own}_n_hit", f"{own}_items", f"{own}_spans")
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words")))
    )


@F.pandas_udf(LongType())
def _n_words(texts: pd.Series) -> pd.Series:
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        data = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
        counts[k] = np.count_nonzero(data[1:] > data[:-1]) + bool(len(data) and data[0])
    return pd.Series(counts)


def _spans(hits: DataFrame) -> DataFrame:
    """``digest``, ``n_hit`` and ``spans``: hits that overlap or touch are one span."""
    runs = hits.groupBy("digest", "first").agg(F.max("last").alias("last"))
    in_text = Window.partitionBy("digest").orderBy("first")
    reached = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce(F.col("first") > reached, F.lit(True)).cast("int"))
    runs = runs.withColumn("span", F.sum("new").over(in_text))
    spans = runs.groupBy("digest", "span").agg(F.min("first").cast("int").alias("first"), F.max("last").cast("int").alias("last"))
    return spans.groupBy("digest").agg(
        F.sum(F.col("last") - F.col("first")).alias("n_hit"), F.array_sort(F.collect_list(F.array("first", "last"))).alias("spans")
    )


def _items(hits: DataFrame, owners: DataFrame) -> DataFrame:
    """``digest`` and ``items``."""
    owned = hits.select("digest", "w").distinct().join(owners, "w").select("digest", "item").distinct()
    return owned.groupBy("digest").agg(F.array_sort(F.collect_list("item")).alias("items"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP5_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least({WINDOW}, len(w)) AS size
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), wanted AS (
  SELECT DISTINCT item, size, w[i : i + size - 1] AS g FROM items, unnest(range(1, len(w) - size + 2)) AS t(i)
), here AS (
  SELECT r, i, size, w[i : i + size - 1] AS g
  FROM docs, (SELECT DISTINCT size FROM wanted) AS s, unnest(range(1, len(w) - size + 2)) AS t(i)
), hits AS (
  SELECT r, i, size, item FROM here JOIN wanted USING (size, g)
), hit_words AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, size)) AS t(k) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""
