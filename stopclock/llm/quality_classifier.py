"""Quality classifier: histogram gradient-boosted trees over document statistics,
flattened into arrays and walked by numpy for a whole batch at once.

``learn`` draws at most ``max_rows`` labelled ids by their hash, computes
the statistics of one text of each in Spark, and boosts on the small table of statistics. A
statistic is cut into at most ``bins`` quantile bins; a split is found from the
histograms of gradients; the trees are complete binary trees of fixed depth,
stored as three arrays (feature, threshold, leaf value), so that a step down
all trees is one indexing operation.

Defined results: a null text counts as empty; a null ``doc_id`` is held out; an id
with several labels takes the smallest, one with several texts that with the least statistics;
without labels every score is 0.5; repeated rows stay; columns that clash with a result
column are replaced, all others kept; no documents, no rows; a text of any length is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.llm import _common as c
from stopclock.llm import statistics

MAX_ROWS = 50_000
KEEP_FROM = 0.3


def measures(counts: pd.DataFrame) -> np.ndarray:
    """The inputs of a score: sizes and shares, whatever the language."""
    x = {name: counts[name].to_numpy(float) for name in statistics.COUNTS}
    words, chars = np.maximum(x["n_words"], 1), np.maximum(x["n_chars"], 1)
    return np.stack(
        [
            np.log1p(x["n_words"]),
            x["word_chars"] / words,
            x["n_symbols"] / words,
            x["n_dup_lines"] / np.maximum(x["n_lines"], 1),
            x["n_lines"] / words,
            x["n_repeat_words"] / words,
            x["n_distinct"] / words,
            x["n_top_word"] / words,
            x["n_same_word"] / words,
            x["n_upper"] / chars,
            x["n_digits"] / chars,
            x["n_marks"] / chars,
            x["n_upper_words"] / np.maximum(x["n_distinct"], 1),
        ],
        1,
    )


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: node k has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; right if above
    value: np.ndarray  # trees x leaves
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree = np.arange(len(self.feature))
        rows = np.arange(len(x))[:, None]
        inner = self.feature.shape[1]
        for _ in range(int(np.log2(inner + 1))):
            right = x[rows, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return 1 / (1 + np.exp(-(self.base + self.value[tree, node - inner].sum(1))))


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 20, ridge: float = 1.0) -> Trees:
    """Boost log loss; a leaf keeps at least ``least`` rows."""
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if not len(y):
        return Trees(feature, threshold, value, 0.0)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(cut, column, side="left") for cut, column in zip(cuts, x.T, strict=True)])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = node - first
            best = np.full(width, 1e-6)
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                key = place * (len(cut) + 1) + binned[f]
                size = width * (len(cut) + 1)
                g, h, n = (np.bincount(key, w, size).reshape(width, -1) for w in (grad, hess, None))
                gl, hl, nl = (np.cumsum(a, 1)[:, :-1] for a in (g, h, n))
                gt, ht, nt = g.sum(1)[:, None], h.sum(1)[:, None], n.sum(1)[:, None]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(nl < least) | (nt - nl < least)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[t, first + k], threshold[t, first + k] = top[k], f, cut[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + ridge)
        raw += value[t, leaf]
    return Trees(feature, threshold, value, base)


def learn(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> Trees:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~c.is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(max_rows)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(marks), "doc_id")  # max_rows rows at most
        .select("doc_id", "quality", statistics.of_text("text").alias("counts"))
        .groupBy("doc_id", "quality")  # of an id's texts the one with the least statistics
        .agg(F.min("counts").alias("counts"))
        .select("doc_id", "quality", "counts.*")
        .toPandas()
        .sort_values("doc_id", ignore_index=True)
    )
    return boost(measures(rows), rows["quality"].to_numpy(float))


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``KEEP_FROM`` on: a clean page is kept when in doubt)."""
    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(measures(statistics.table(texts.tolist()))))

    return docs.withColumn("score", rate("text")).withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", c.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
