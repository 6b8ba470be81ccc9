"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

``learn`` fits the model of ``subwords`` on a bounded sample of labelled rows,
toxic and clean rows bounded apart (``max_toxic``, ``max_clean``; within each,
the rows with the smallest hash of their id). Of a text longer than ``LEARNED_CHARS``
pieces from all over it are learned from. ``score`` rates every whole text, however long.

Defined results: a null text scores as the empty text does; a null ``doc_id`` is
held out; several labels of one id count as toxic if any is; null labels don't
count; of several texts of one id the first in order is learned from; without toxic
labels every text is clean; repeated rows stay; columns that clash with a result column
are replaced, all others kept; no documents, no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.llm import _common as c
from stopclock.llm.subwords import Features, SubwordModel, learned_part, train

MAX_TOXIC = 2_500
MAX_CLEAN = 6_000
LEARNED_CHARS = 50_000
FEATURES = Features(sizes=(3, 4, 5), buckets=1 << 17)


def learn(docs: DataFrame, labels: DataFrame, *, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> SubwordModel:
    """Fit on at most ``max_toxic + max_clean`` labelled texts outside the held-out fold."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~c.is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    toxic = marks.filter("toxic = 1").orderBy(*by_hash).limit(max_toxic)
    clean = marks.filter("toxic = 0").orderBy(*by_hash).limit(max_clean)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", learned_part(F.col("text"), LEARNED_CHARS).alias("text"))
    sample = (
        texts.join(F.broadcast(toxic.unionByName(clean)), "doc_id")  # max_toxic + max_clean rows at most
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        y = rows["toxic"].to_numpy(np.int64)
        if not y.any():
            return pd.DataFrame({"weights": [], "bias": [], "temperature": []})
        return train(rows["text"].tolist(), y, 2, features=FEATURES).packed()

    # The bounded sample is one group, learned from in one task; the driver gets the model alone.
    fitted = sample.groupBy().applyInPandas(fit, SubwordModel.SCHEMA).collect()
    if not fitted:
        return SubwordModel(FEATURES, np.zeros((FEATURES.buckets, 2), np.float32), np.array([5.0, -5.0], np.float32))
    return SubwordModel.unpacked(FEATURES, fitted[0])


def score(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """Add ``score`` (0 to 1, higher: likelier toxic) and ``predicted`` (1 from 0.5 on)."""
    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probabilities(texts.tolist())[:, 1])

    docs = docs.withColumn("score", rate("text"))
    return docs.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", c.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
