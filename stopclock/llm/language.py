"""Language identification: averaged hashed subword embeddings under a linear softmax,
trained by stochastic gradient descent in numpy, with calibrated rejection.

``learn`` takes ``per_language`` different rows of every language (all if there are fewer),
those with the smallest hashes of id and text, so neither a repeated id nor a repeated row
crowds out others. Of a text longer than ``LEARNED_CHARS`` pieces from all over it are
learned from. With very many languages each gets fewer rows, ``max_rows`` in all. The model of
``subwords`` is fitted in a task, and its rejection level set on texts kept out of the fit, so
that it accepts ``accept_share`` of the right answers there. ``identify`` answers for every
whole text, however long.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
and where nothing was learned; a language that only has such texts is not learned; a null
``doc_id`` is held out; repeated rows stay; ``accepted`` is false for ``und`` and below the
rejection level; columns that clash with a result column are replaced, all others kept;
no documents, no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopclock.llm import _common as c
from stopclock.llm.subwords import Features, SubwordModel, learned_part, train

PER_LANGUAGE = 1_000
MAX_ROWS = 20_000
LEARNED_CHARS = 20_000
ACCEPT_SHARE = 0.99
FEATURES = Features(sizes=(3, 4), buckets=1 << 16)
_LETTER = r"\p{L}"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    subwords: SubwordModel
    reject_below: float


def learn(docs: DataFrame, *, per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS, accept_share: float = ACCEPT_SHARE) -> LanguageModel:
    """Fit on rows with a language outside the held-out fold."""
    named = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~c.is_held_out(F.col("doc_id")) & F.col("text").rlike(_LETTER)
    ).select("lang", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"))
    keys = c.stored(named.select("lang", "h").distinct())
    # A number for each language, of which the model has a class each.
    languages = tuple(sorted(r.lang for r in keys.select("lang").distinct().collect()))
    if not languages:
        return LanguageModel((), train([], np.zeros(0), 1, features=FEATURES), 0.0)
    most = max(1, min(per_language, max_rows // len(languages)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = keys.withColumn("place", place).filter(F.col("place") <= most).select("lang", "h")
    sample = (
        named.join(F.broadcast(drawn), ["lang", "h"])  # max_rows rows, or one for each language
        .groupBy("lang", "h")
        .agg(F.min("text").alias("text"))
        .select("lang", "h", learned_part(F.col("text"), LEARNED_CHARS).alias("text"))
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(order=[zlib.crc32(str(h).encode()) for h in rows["h"]]).sort_values(["order", "lang", "h"])
        y = np.array([languages.index(x) for x in rows["lang"]], np.int64)
        texts = rows["text"].tolist()
        # A tenth is kept out, but the first row of a language never is.
        first = np.zeros(len(y), bool)
        first[np.unique(y, return_index=True)[1]] = True
        out = np.flatnonzero(~first)[: len(y) // 10]
        kept = np.setdiff1d(np.arange(len(y)), out)
        model = train([texts[i] for i in kept], y[kept], len(languages), features=FEATURES, seen=20_000)
        p = model.probabilities([texts[i] for i in out])
        right = p.max(1)[p.argmax(1) == y[out]] if len(out) else np.zeros(0)
        return model.packed().assign(reject_below=float(np.quantile(right, 1 - accept_share)) if len(right) else 0.0)

    # The bounded sample is one group, learned from in one task; the driver gets the model alone.
    fitted = sample.groupBy().applyInPandas(fit, f"{SubwordModel.SCHEMA}, reject_below double").first()
    return LanguageModel(languages, SubwordModel.unpacked(FEATURES, fitted), fitted.reject_below)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``accepted``."""
    @F.pandas_udf("lang string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        m = model
        p = m.subwords.probabilities(texts.tolist())
        top = p.argmax(1)
        return pd.DataFrame({"lang": [m.languages[k] if m.languages else None for k in top], "score": p[np.arange(len(p)), top]})

    answer = c.fresh(docs, "answer")
    has_letter = F.coalesce(F.col("text"), F.lit("")).rlike(_LETTER) & F.lit(bool(model.languages))
    return (
        docs.withColumn(answer, best("text"))
        .withColumn("lang_pred", F.when(has_letter, F.col(f"{answer}.lang")).otherwise("und"))
        .withColumn("score", F.when(has_letter, F.col(f"{answer}.score")).otherwise(0.0))
        .withColumn("accepted", has_letter & (F.col("score") >= model.reject_below))
        .drop(answer)
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs.select("doc_id", "text"), learn(docs)).select(
        "doc_id", c.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted"
    )
