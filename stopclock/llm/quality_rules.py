"""Quality rules with host verdicts.

Each document is judged by the base rules (too few words, or too many words in
repeated three-word windows). Failures are counted per host and rule; the
failure rate of a host is shrunk with a beta prior fitted to all hosts by the
method of moments, so a host with three bad pages isn't condemned on three
pages. A host whose shrunk rate of some rule exceeds ``max_rate`` is refused, and
its verdict is joined back to its documents.

Nothing of a host is gathered: failures are pre-aggregated before the shuffle,
and the join back carries one row per host.

Defined results: a null text has no words and fails; a null host is a host of
its own; repeated rows count each; no documents, no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.llm import statistics
from stopclock.llm._common import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5
RULES = ("short", "repetitive")


def base_rules(n_words, n_repeat_words) -> dict:
    return {
        "short": n_words < MIN_WORDS,
        "repetitive": n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT,
    }


def judge_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``host`` and the counts and base rules of every document."""
    counted = docs.select("doc_id", F.col(host).alias("host"), statistics.of_text("text").alias("counts"))
    plain = counted.select("doc_id", "host", *(f"counts.{k}" for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
    rules = base_rules(F.col("n_words"), F.col("n_repeat_words"))
    return plain.withColumns(rules).withColumn("base_failed", F.col("short") | F.col("repetitive"))


def host_verdicts(judged: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: documents, failures and shrunk rate of each rule, ``host_failed``.

    The prior of a rule has the mean m and variance v of the hosts' rates, each host
    counted once: a = m k, b = (1 - m) k with k = m (1 - m) / v - 1. Where v leaves no
    such k (one host, or all alike) the prior weighs one document.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"),
        *(F.sum(F.col(rule).cast("long")).alias(f"{rule}_failures") for rule in RULES),
    )
    moments = []
    for rule in RULES:
        rate = F.col(f"{rule}_failures") / F.col("host_docs")
        moments += [F.avg(rate).alias(f"{rule}_mean"), F.var_pop(rate).alias(f"{rule}_var")]
    prior = hosts.agg(*moments).first()  # a few numbers
    for rule in RULES:
        mean, var = prior[f"{rule}_mean"] or 0.0, prior[f"{rule}_var"] or 0.0
        strength = mean * (1 - mean) / var - 1 if var > 1e-12 and mean * (1 - mean) > var else 1.0
        hosts = hosts.withColumn(
            f"{rule}_rate", (F.col(f"{rule}_failures") + mean * strength) / (F.col("host_docs") + strength)
        )
    failed = F.greatest(*(F.col(f"{rule}_rate") for rule in RULES)) > max_rate
    return hosts.select("host", "host_docs", *(f"{rule}_rate" for rule in RULES), failed.alias("host_failed"))


def keep(judged: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Add the host's verdict and ``kept``. The join has one row per host on one side; a
    frequent host is left to the engine, which splits its documents."""
    v = verdicts.withColumnRenamed("host", "verdict_host")
    return (
        judged.join(v, F.col("host").eqNullSafe(F.col("verdict_host")), "left")
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
        .drop("verdict_host")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = stored(judge_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return keep(judged, host_verdicts(judged)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_failed",
    )


_WORD = r"'[^\x20\x09-\x0D]+'"
OP2_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, doc_id, source, text, regexp_extract_all(text, {_WORD}) AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, {_WORD})) AS lines
  FROM texts
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM words, unnest(range(1, len(w) - 1)) AS t(i)
), again AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS o(k) GROUP BY r
), judged AS (
  SELECT doc_id, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN covered USING (r)
), ruled AS (
  SELECT *, n_words < {MIN_WORDS} AS short, 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS repetitive FROM judged
), hosts AS (
  SELECT source, count(*) AS n, avg(short::INT) AS short_raw, avg(repetitive::INT) AS rep_raw FROM ruled GROUP BY source
), prior AS (
  SELECT avg(short_raw) AS sm, var_pop(short_raw) AS sv, avg(rep_raw) AS rm, var_pop(rep_raw) AS rv FROM hosts
), strength AS (
  SELECT sm, rm, CASE WHEN sv > 1e-12 AND sm * (1 - sm) > sv THEN sm * (1 - sm) / sv - 1 ELSE 1 END AS sk,
         CASE WHEN rv > 1e-12 AND rm * (1 - rm) > rv THEN rm * (1 - rm) / rv - 1 ELSE 1 END AS rk FROM prior
), verdicts AS (
  SELECT source, (short_raw * n + sm * sk) / (n + sk) > {MAX_RATE} OR (rep_raw * n + rm * rk) / (n + rk) > {MAX_RATE} AS host_failed
  FROM hosts, strength
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
       NOT (short OR repetitive) AND NOT host_failed AS kept, host_failed
FROM ruled JOIN verdicts ON ruled.source IS NOT DISTINCT FROM verdicts.source"""
