"""Source divergence audit: how far the word use of a language's sources lies apart.

The terms of a language are those in at least ``min_docs`` of its documents. They are
range-partitioned and sorted, and every block of at most ``block_terms`` of them becomes a
minimal acyclic transducer in the task that holds it. A transducer gives each of its terms
the ordinal of its place in the order; with the number of terms in the blocks before it, that is
the term's place among all of its language, so comparing ordinals is comparing terms.

The texts are then streamed through the transducers: all words of a stretch of text go in step,
byte by byte, and come out as ordinals or not at all. What a task counts is summed up by
(language, source, ordinal). Transducers go to the tasks in packs of at most ``pack_bytes``;
a larger vocabulary means more passes over the texts, never a larger pack.

Smoothed shares, in whole billionths, are compared between sources (part ``pair``: summed
differences over all terms, for each ordered pair of sources) and with the language
(part ``term``: the ``top`` terms that a source uses more than its language does). Pairs are
summed in tiles of sources and blocks of ordinals, so that no task holds a whole language.

Defined results: null text, lang and source read as ''; a source without terms is a group
like any other; a language without kept terms has pairs of value 0 and no terms; a
language with one source has no pairs; repeated rows count each; ids are not looked at;
other columns may have any name; no documents, no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopclock.llm import _common as c
from stopclock.llm.transducer import Transducer, build

MIN_DOCS = 30
TOP = 50
PRIOR = 5
UNIT = 1_000_000_000
BLOCK_TERMS = 100_000
PACK_BYTES = 64 << 20
#: A task's share of the pairs: sources on either side, and ordinals.
TILE = 256
ORDINALS = 1_024
_FLUSH = 300_000
_STRETCH = 1 << 20

#: Bytes that are no part of a term become spaces, A-Z become a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Block:
    """The transducer of some consecutive terms of a language."""

    lang: str
    first: bytes
    last: bytes
    base: int  # terms of the language before this block
    terms: Transducer


def texts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source`` and ``data``, the bytes of the text."""
    plain = lambda name: F.coalesce(F.col(name), F.lit(""))
    return docs.select(plain("lang").alias("lang"), plain("source").alias("source"), plain("text").cast("binary").alias("data"))


def kept_terms(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang`` and ``term`` (bytes) of the terms in ``min_docs`` documents of their language or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, data in zip(batch["lang"].to_pylist(), batch["data"], strict=True):
                seen[lang].update(set(data.as_py().translate(_TABLE).split()))
                if len(seen[lang]) > _FLUSH:
                    yield told(lang, seen.pop(lang))
        for lang, found in seen.items():
            yield told(lang, found)

    def told(lang: str, found: Counter) -> pa.RecordBatch:
        columns = pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())
        return pa.RecordBatch.from_arrays([*columns], ["lang", "term", "n"])

    counted = rows.select("lang", "data").mapInArrow(count, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("lang", "term")


def transducers(vocabulary: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per block: ``lang``, ``first``, ``last``, ``n`` and the arrays of its transducer."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang, held = None, []
        for batch in batches:
            for new, term in zip(batch["lang"], batch["term"], strict=True):
                if held and (new != lang or len(held) == block_terms):
                    yield packed(lang, held)
                    held = []
                lang = new
                held.append(bytes(term))
        if held:
            yield packed(lang, held)

    def packed(lang: str, held: list[bytes]) -> pd.DataFrame:
        arrays = {name: [data] for name, data in build(held).packed().items()}
        return pd.DataFrame({"lang": [lang], "first": held[:1], "last": held[-1:], "n": [len(held)], **arrays})

    blocks = 1 + vocabulary.count() // block_terms
    ordered = vocabulary.repartitionByRange(blocks, "lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInPandas(pack, f"lang string, first binary, last binary, n long, {', '.join(f'{name} binary' for name in Transducer.DTYPES)}")


def packs(blocks: DataFrame, pack_bytes: int = PACK_BYTES) -> Iterator[list[Block]]:
    """All blocks, in lists of bounded size that can be sent to the tasks."""
    base: dict[str, int] = defaultdict(int)
    bytes_of = sum((F.length(name) for name in Transducer.DTYPES), F.lit(0))
    held, size = [], 0
    # Without the transducers a row is a few bytes for each ``block_terms`` terms.
    for head in blocks.select("lang", "first", "n", bytes_of.alias("size")).orderBy("lang", "first").collect():
        if held and size + head["size"] > pack_bytes:
            yield _fetched(blocks, held)
            held, size = [], 0
        held.append((head["lang"], bytes(head["first"]), base[head["lang"]]))
        base[head["lang"]] += head["n"]
        size += head["size"]
    if held:
        yield _fetched(blocks, held)


def _fetched(blocks: DataFrame, wanted: list[tuple[str, bytes, int]]) -> list[Block]:
    at = {(lang, first): base for lang, first, base in wanted}
    (low_lang, low, _), (high_lang, high, _) = wanted[0], wanted[-1]
    lang, first = F.col("lang"), F.col("first")
    inside = ((lang > low_lang) | ((lang == low_lang) & (first >= low))) & ((lang < high_lang) | ((lang == high_lang) & (first <= high)))
    rows = blocks.filter(inside).collect()  # pack_bytes at most
    return [Block(r["lang"], bytes(r["first"]), bytes(r["last"]), at[r["lang"], bytes(r["first"])], Transducer.unpacked(r.asDict())) for r in rows]


def _heads(strings: list[bytes]) -> np.ndarray:
    """The first eight bytes of each as a number, in the same order."""
    return np.array([int.from_bytes(s[:8].ljust(8, b"\0"), "big") for s in strings], np.uint64)


class Vocabulary:
    """The blocks of a pack, by language."""

    def __init__(self, blocks: list[Block]):
        self.of: dict[str, list[Block]] = defaultdict(list)
        for block in blocks:
            self.of[block.lang].append(block)

    def ordinals(self, lang: str, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``data`` a word begins, and its ordinal or -1. No word may be last in ``data``."""
        inside = data != 32
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        start, length = edges[::2], edges[1::2] - edges[::2]
        out = np.full(len(start), -1, np.int64)
        blocks = self.of.get(lang, [])
        if len(blocks) > 1:
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            head = np.zeros(len(start), np.uint64)
            for k in range(8):
                byte = np.where(length > k, padded[start + k], 0).astype(np.uint64)
                head = (head << np.uint64(8)) | byte
            low, high = _heads([b.first for b in blocks]), _heads([b.last for b in blocks])
        for k, block in enumerate(blocks):
            # Blocks whose ends share eight bytes with a word are both asked.
            mine = np.flatnonzero((head >= low[k]) & (head <= high[k])) if len(blocks) > 1 else np.arange(len(start))
            found = block.terms.ordinals(data, start[mine], length[mine])
            out[mine[found >= 0]] = found[found >= 0] + block.base
        return start, out


def recount(rows: DataFrame, pack: list[Block]) -> DataFrame:
    """``lang``, ``source``, ``ordinal`` and ``n``, what each task has counted."""

    def stretches(batch: pd.DataFrame) -> Iterator[tuple[str, list[str], list[bytes]]]:
        """Texts of one language, of bounded size together; long texts are cut between words."""
        for lang, part in batch.groupby("lang", sort=False):
            sources, held, size = [], [], 0
            for source, data in zip(part["source"], part["data"], strict=True):
                data, at = data.translate(_TABLE), 0
                while at < len(data):
                    end = min(len(data), at + _STRETCH)
                    if end < len(data):
                        cut = data.rfind(b" ", at, end)
                        end = cut + 1 if cut >= 0 else (data.find(b" ", end) + 1 or len(data))
                    sources.append(source)
                    held.append(data[at:end])
                    size, at = size + end - at, end
                    if size >= _STRETCH:
                        yield lang, sources, held
                        sources, held, size = [], [], 0
            if held:
                yield lang, sources, held

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(pack)
        number: dict[str, dict[str, int]] = defaultdict(dict)  # of the sources, as they come
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for batch in batches:
            for lang, sources, texts in stretches(batch):
                if lang not in vocabulary.of:
                    continue
                numbers = number[lang]
                code = np.array([numbers.setdefault(x, len(numbers)) for x in sources])
                data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
                start, ordinal = vocabulary.ordinals(lang, data)
                begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
                owner = code[np.searchsorted(begins, start, side="right") - 1]
                known = ordinal >= 0
                held[lang].append(np.unique(owner[known] << 40 | ordinal[known], return_counts=True))
                if sum(len(key) for key, _ in held[lang]) > _FLUSH:
                    held[lang] = [merged(held[lang])]
                    if len(held[lang][0][0]) > _FLUSH // 2:
                        yield told(lang, numbers, *held.pop(lang)[0])
        for lang, found in held.items():
            yield told(lang, number[lang], *merged(found))

    def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        key, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        return key, np.bincount(place, np.concatenate([n for _, n in found]), len(key)).astype(np.int64)

    def told(lang: str, numbers: dict[str, int], key: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        names = np.array(list(numbers), object)
        columns = np.full(len(key), lang, object), names[key >> 40], key & (1 << 40) - 1, n
        return pd.DataFrame(dict(zip(("lang", "source", "ordinal", "n"), columns, strict=True)))

    return rows.mapInPandas(count, "lang string, source string, ordinal long, n long")


def numbered(vocabulary: DataFrame, pack: list[Block]) -> DataFrame:
    """``lang``, ``ordinal`` and ``term`` (text) of the pack's terms."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Vocabulary(pack)
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=False):
                _, ordinal = known.ordinals(lang, np.frombuffer(b" ".join(part["term"]) + b" ", np.uint8))
                mine = ordinal >= 0
                if mine.any():
                    yield pd.DataFrame({"lang": [lang] * mine.sum(), "ordinal": ordinal[mine], "term": part["term"].to_numpy()[mine]})

    found = vocabulary.mapInPandas(number, "lang string, ordinal long, term binary")
    return found.select("lang", "ordinal", F.col("term").cast("string").alias("term"))


def _share(n: Column, total: Column, terms: Column, prior: int) -> Column:
    """1 + the smoothed share in whole billionths; decimals, as the product may pass 64 bits."""
    above = (n + prior).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = F.greatest(total + prior * terms, F.lit(1)).cast("decimal(19,0)")
    # Without its remainder the product is divided exactly.
    return ((above - above % below) / below).cast("long") + 1


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP, prior: int = PRIOR, block_terms: int = BLOCK_TERMS, pack_bytes: int = PACK_BYTES, tile: int = TILE, ordinals: int = ORDINALS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``."""
    folder = c.shared_folder(docs.sparkSession)
    rows = texts(docs)
    vocabulary = c.stored(kept_terms(rows, min_docs), folder, "vocabulary")
    blocks = c.stored(transducers(vocabulary, block_terms), folder, "transducers")
    partial, names = [], []
    for k, pack in enumerate(packs(blocks, pack_bytes)):
        counted = recount(rows, pack).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        partial.append(c.stored(counted, folder, f"counts{k}"))
        names.append(c.stored(numbered(vocabulary, pack), folder, f"names{k}"))
    if not partial:
        partial = [rows.select("lang", "source", F.lit(0).cast("long").alias("ordinal"), F.lit(0).cast("long").alias("n")).limit(0)]
        names = [rows.select("lang", F.lit(0).cast("long").alias("ordinal"), F.lit("").alias("term")).limit(0)]
    counts, terms = partial[0], names[0]
    for more, named in zip(partial[1:], names[1:], strict=True):
        counts, terms = counts.unionByName(more), terms.unionByName(named)
    groups = c.stored(_groups(rows, vocabulary, counts, prior), folder, "groups")
    return _pairs(groups, counts, prior, tile, ordinals).unionByName(_terms(groups, counts, terms, prior, top))


def _groups(rows: DataFrame, vocabulary: DataFrame, counts: DataFrame, prior: int) -> DataFrame:
    """A row per (lang, source): its number within the language, totals, and the share of an absent term."""
    sizes = vocabulary.groupBy(F.col("lang").alias("lang_v")).agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy(F.col("lang").alias("lang_t"), F.col("source").alias("source_t")).agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct()
    groups = groups.join(totals, (F.col("lang") == F.col("lang_t")) & (F.col("source") == F.col("source_t")), "left")
    groups = groups.join(sizes, F.col("lang") == F.col("lang_v"), "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    by_lang = Window.partitionBy("lang")
    return groups.select(
        "*",
        (F.row_number().over(by_lang.orderBy("source")) - 1).alias("number"),
        F.sum("total").over(by_lang).alias("lang_total"),
        _share(F.lit(0), F.col("total"), F.col("v"), prior).alias("absent"),
    )


def _named(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({x: f"{x}_{suffix}" for x in df.columns})


def _ranked(rows: DataFrame, *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), *order))
    return rows.withColumn("rank", rank)


def _terms(groups: DataFrame, counts: DataFrame, terms: DataFrame, prior: int, top: int) -> DataFrame:
    whole = _named(counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")), "w")
    own = counts.join(_named(groups, "g"), (F.col("lang") == F.col("lang_g")) & (F.col("source") == F.col("source_g")))
    own = own.join(whole, (F.col("lang") == F.col("lang_w")) & (F.col("ordinal") == F.col("ordinal_w")))
    p = _share(F.col("n"), F.col("total_g"), F.col("v_g"), prior)
    q = _share(F.col("n_w"), F.col("lang_total_g"), F.col("v_g"), prior)
    above = own.select("lang", "source", "ordinal", (p - q).alias("value")).filter(F.col("value") > 0)
    best = _ranked(above, F.asc("ordinal")).filter(F.col("rank") <= top)
    best = best.join(_named(terms, "t"), (F.col("lang") == F.col("lang_t")) & (F.col("ordinal") == F.col("ordinal_t")))
    return best.select("lang", "source", F.lit("term").alias("part"), F.col("term_t").alias("item"), "value", "rank")


def _pairs(groups: DataFrame, counts: DataFrame, prior: int, tile: int, ordinals: int) -> DataFrame:
    keys = ("lang", "number", "v", "absent")
    present = counts.join(_named(groups, "g"), (F.col("lang") == F.col("lang_g")) & (F.col("source") == F.col("source_g")))
    share = _share(F.col("n"), F.col("total_g"), F.col("v_g"), prior)
    present = present.select(
        "lang", *(F.col(f"{x}_g").alias(x) for x in keys[1:]), F.floor(F.col("ordinal") / ordinals).alias("block"),
        (F.col("ordinal") % ordinals).cast("int").alias("place"), share.alias("share"),
    )
    # Every source is in every block of its language, if only with absent terms.
    last = F.floor(F.greatest(F.col("v") - 1, F.lit(0)) / ordinals)
    everywhere = groups.select(
        *keys, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), F.lit(-1).alias("place"), F.lit(0).cast("long").alias("share")
    )
    tiles = groups.groupBy(F.col("lang").alias("lang_n")).agg((1 + F.floor(F.max("number") / tile)).cast("int").alias("tiles"))
    rows = present.unionByName(everywhere).join(tiles, F.col("lang") == F.col("lang_n")).drop("lang_n")
    mine = F.floor(F.col("number") / tile).cast("int")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumn("low", F.least(mine, "other")).withColumn("high", F.greatest(mine, "other")).drop("tiles", "other")

    def apart(part: pd.DataFrame) -> pd.DataFrame:
        head = part.iloc[0]
        lang, low, high = head["lang"], int(head["low"]), int(head["high"])
        own = part[part["place"] < 0].sort_values("number")
        number = own["number"].to_numpy(np.int64)
        width = min(ordinals, int(head["v"]) - int(head["block"]) * ordinals)
        table = np.repeat(own["absent"].to_numpy(np.int64)[:, None], max(0, width), axis=1)
        cells = part[part["place"] >= 0]
        table[np.searchsorted(number, cells["number"].to_numpy(np.int64)), cells["place"].to_numpy()] = cells["share"].to_numpy(np.int64)
        a_of, b_of = np.flatnonzero(number // tile == low), np.flatnonzero(number // tile == high)
        found = [(a, b_of[number[b_of] > number[a]]) for a in a_of]
        found = [(a, b) for a, b in found if len(b)]
        if not found:
            return pd.DataFrame(columns=["lang", "a", "b", "value"])
        return pd.DataFrame({
            "lang": [lang] * sum(len(b) for _, b in found),
            "a": np.concatenate([np.full(len(b), number[a]) for a, b in found]),
            "b": np.concatenate([number[b] for _, b in found]),
            "value": np.concatenate([np.abs(table[b] - table[a]).sum(1) for a, b in found]),
        })

    sums = rows.groupBy("lang", "block", "low", "high").applyInPandas(apart, "lang string, a int, b int, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("one"), F.col("b").alias("two")), F.struct(F.col("b").alias("one"), F.col("a").alias("two")))
    sums = sums.select("lang", "value", F.inline(both))
    name = groups.select(F.col("lang").alias("lang_n"), F.col("number").alias("number_n"), F.col("source").alias("name"))
    for end, column in (("one", "source"), ("two", "item")):
        sums = sums.join(name, (F.col("lang") == F.col("lang_n")) & (F.col(end) == F.col("number_n"))).withColumnRenamed("name", column).drop("lang_n", "number_n")
    return _ranked(sums, F.asc("item")).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), uses AS MATERIALIZED (
  SELECT r, lang, source, unnest(w) AS term FROM docs
), kept AS (
  SELECT lang, term FROM uses GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}
), sizes AS (
  SELECT d.lang, coalesce(any_value(k.v), 0) AS v FROM (SELECT DISTINCT lang FROM docs) d
  LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) k USING (lang) GROUP BY d.lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), found AS (
  SELECT lang, source, term, count(*) AS n FROM uses JOIN kept USING (lang, term) GROUP BY lang, source, term
), own AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n, v,
         sum(coalesce(f.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
         sum(coalesce(f.n, 0)) OVER (PARTITION BY g.lang, k.term) AS n_lang,
         sum(coalesce(f.n, 0)) OVER (PARTITION BY g.lang) AS total_lang
  FROM groups g JOIN sizes USING (lang) JOIN kept k ON k.lang = g.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), shares AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + CAST(({UNIT}::HUGEINT * (n + {PRIOR})) // (total + {PRIOR} * v) AS BIGINT) AS p,
         1 + CAST(({UNIT}::HUGEINT * (n_lang + {PRIOR})) // (total_lang + {PRIOR} * v) AS BIGINT) AS q FROM own
), apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
