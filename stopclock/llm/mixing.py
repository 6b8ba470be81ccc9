"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Sources share ``epochs`` times all words by weight, none above ``cap`` times its own
words; what a source can't take is shared among the others by weight until none is
above. Every document of a source then expects the same number of copies,
rate = target / words of the source. Along an order of the source's documents the
expected copies are summed up; with one random offset added, a document is emitted
once for every whole number that its step crosses.

The order is by size, so documents of like size follow each other and the words
taken come near the target (the error is at most about the largest document). As
all documents of a source expect the same, the prefix sum is rate x rank, and the rank
is the number of smaller documents (a prefix sum over the sizes that occur) plus
the place among those of equal size. Equal sizes are dealt out over ``salts``
groups by a hash of id and text, so neither a source nor a size nor an id is one task. A group
that still has more than ``rows_per_salt`` rows (equal ones, then) is dealt out once more by a
column that tells equal rows apart (``spread``), such as a stored row number.

Defined results: a null text has size 0; size 0 documents expect copies like others and
add no words; sources are ordered by code point, null last, and take the weights 3,
1, 2 in turn; a source without words has target 0 and takes nothing; a null id hashes
like an empty one; equal rows take different places, in no stated order; columns that clash
with a result column are replaced, all others kept; words are counted over whole texts; no
documents, no rows. The same rows give the same result in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopclock.llm import _common as c

WEIGHTS = (3, 1, 2)
EPOCHS = 1.5
CAP = 2
SEED = "7"
ROWS_PER_SALT = 20_000


def _md5_below(text: Column, digits: int) -> Column:
    """A number below 16 ** digits, the same in every engine that has MD5."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def targets(sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, epochs: float = EPOCHS, cap: int = CAP) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight``, ``target``.

    Sources are filled in the order in which they reach their cap: with k sources
    at their cap, the others take (budget - words of those k) / (their weights)
    times their weight; the least k at which the next source stays below its cap
    is the answer. Only rows of this small table meet in one task.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight.cast("long"))
    by_cap = Window.orderBy((cap * F.col("source_size")) / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (F.sum("source_size").over(everything) * epochs - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0))) / F.sum("weight").over(rest)
    sources = sources.withColumn("share", share)
    below = F.col("share") * F.col("weight") <= cap * F.col("source_size")
    # Once a source stays below its cap, so do all after it, at the same share.
    first = F.first(F.when(below, F.col("share")), ignorenulls=True).over(everything.orderBy((cap * F.col("source_size")) / F.col("weight"), F.col("source").asc_nulls_last()))
    full = cap * F.col("source_size").cast("double")
    return sources.select("source", "source_size", "weight", F.coalesce(F.least(full, first * F.col("weight")), full).alias("target"))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``, the number of words."""
    return docs.withColumn("size", c.n_words(F.col(text)))


def _text_md5(docs: DataFrame, digest: str | None) -> Column:
    """The digest of the text; that of an empty one where there is no text."""
    if digest:
        return F.col(digest)
    return F.md5(F.coalesce(F.col("text"), F.lit("")) if "text" in docs.columns else F.lit(""))


def _named(df: DataFrame, suffix: str, *names: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{name}_{suffix}" for name in names})


def mix(docs: DataFrame, *, seed: str = SEED, rows_per_salt: int = ROWS_PER_SALT, digest: str | None = None, spread: str | None = None, **shares) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to documents with a ``size``.

    ``digest`` is a column with the MD5 of the text, where it is known already. It and ``spread`` are dropped.

    The only shuffle of the documents is by source, size and salt; the tables joined to
    them have a row per source, or per source, size and salt. ``docs`` is read three
    times, twice of them without its texts.
    """
    salts = 1 + docs.count() // rows_per_salt
    salt = _md5_below(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), _text_md5(docs, digest)), 8) % salts
    # One struct holds the row, so no column of it can clash with the ones used here.
    row = F.struct(*(F.col(f"`{x}`") for x in docs.columns if x.lower() not in ("source_size", "target", "copies") and x not in (spread, digest)))
    apart = F.xxhash64(spread) if spread else F.lit(0).cast("long")
    rows = docs.select(row.alias("row"), "doc_id", "source", "size", salt.alias("salt"), apart.alias("apart"))
    cells = c.stored(rows.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n")))
    if spread:
        # More groups for those that are too large, none for all others.
        large = cells.filter(F.col("n") > rows_per_salt).withColumn("parts", F.ceil(F.col("n") / rows_per_salt))
        large = _named(large.select("source", "size", "salt", "parts"), "l", "source", "size", "salt", "parts")
        if not large.isEmpty():
            of = [F.col(n).eqNullSafe(F.col(f"{n}_l")) for n in ("source", "size", "salt")]
            rows = rows.join(large, of, "left").drop("source_l", "size_l", "salt_l")
            part = F.pmod("apart", F.coalesce("parts_l", F.lit(1)))
            rows = rows.withColumn("salt", F.col("salt") + salts * part).drop("parts_l")
            cells = c.stored(rows.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n")))
    goal = targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size")), **shares)
    # The number of documents before each cell of its source: over sizes first, then over the salts of a size.
    sizes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("source", "size", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("smaller"))
    before = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    same = lambda suffix, *names: [F.col(n).eqNullSafe(F.col(f"{n}_{suffix}")) for n in names]
    cells = (
        cells.join(_named(sizes, "s", "source", "size"), same("s", "source", "size"))
        .join(_named(goal, "g", "source"), same("g", "source"))
        .select("source", "size", "salt", (F.col("smaller") + F.col("before")).alias("before"), "source_size", "target")
    )
    within = Window.partitionBy("source", "size", "salt").orderBy("doc_id", "apart")
    placed = rows.withColumn("place", F.row_number().over(within))
    placed = placed.join(_named(cells, "c", "source", "size", "salt"), same("c", "source", "size", "salt"))
    rank = F.col("before") + F.col("place")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    offset = _md5_below(F.concat(F.lit(f"{seed}:"), name), 5) / float(1 << 20)
    copies = F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)
    # Rounding of a rate just below a whole number must not add a copy.
    return placed.select("row.*", "source_size", "target", F.least(copies, F.ceil(rate)).alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as its ``copies``, without the columns of the mix."""
    columns = [x for x in mixed.columns if x not in ("copies", "size", "source_size", "target")]
    row = F.struct(*(F.col(f"`{x}`") for x in columns))
    return mixed.select(F.explode(F.array_repeat(row, F.col("copies").cast("int"))).alias("row")).select("row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    docs = sized(docs).withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    rows = c.stored(docs.select("doc_id", "source", "size", "digest").withColumn("number", F.monotonically_increasing_id()))
    return mix(rows, digest="digest", spread="number").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


OP9_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), salted AS (
  SELECT *, ('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest), 8))::BIGINT
            % (1 + (SELECT count(*) FROM docs) // {ROWS_PER_SALT}) AS salt FROM docs
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
  FROM docs GROUP BY source
), shares AS (
  SELECT s.source, (any_value(b.total)::DOUBLE * {EPOCHS}::DOUBLE - coalesce(sum({CAP} * o.source_size) FILTER (
             {CAP} * o.source_size / o.weight < {CAP} * s.source_size / s.weight), 0))
         / sum(o.weight) FILTER ({CAP} * o.source_size / o.weight >= {CAP} * s.source_size / s.weight) AS share,
         s.source_size, s.weight
  FROM sources s, sources o, (SELECT sum(source_size) AS total FROM sources) b
  GROUP BY s.source, s.source_size, s.weight
), level AS (
  SELECT arg_min(share, {CAP} * source_size / weight) AS share FROM shares WHERE share * weight <= {CAP} * source_size
), goals AS (
  SELECT source, source_size, CAST(coalesce(least({CAP} * source_size, (SELECT share FROM level) * weight), {CAP} * source_size) AS DOUBLE) AS target
  FROM sources
), ranked AS (
  SELECT d.*, g.source_size, g.target, row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.salt, d.doc_id) AS k,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         ('0x' || left(md5('{SEED}:' || coalesce('s' || d.source, 'null')), 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM salted d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(rate * k + u) - floor(rate * (k - 1) + u), ceil(rate)) AS BIGINT) * size AS taken FROM ranked"""
