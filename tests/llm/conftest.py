import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their results or on the way.
CLASHING = (
    "score", "predicted", "size", "target", "source_size", "copies", "shard", "slot", "fp", "root", "component_id",
    "n_words", "hit", "items", "found", "row", "rank", "n", "salt", "before", "chosen_id", "answer", "lang_pred",
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or whole rows; ``clash`` adds columns of other meaning."""

    def make(rows, clash=False):
        rows = [(*r, "en", "s1", 0)[:5] if len(r) == 2 else r for r in rows]
        docs = spark.createDataFrame(rows, SCHEMA)
        if clash:
            from pyspark.sql import functions as F

            docs = docs.withColumns({name: F.lit("mine") for name in CLASHING})
        return docs

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = "word " * 60_000
    return [
        (1, "a plain text of a few words that says nothing", "en", "s1", 45),
        (1, "a plain text of a few words that says nothing", "en", "s1", 45),
        (2, "a plain text of a few words that says nothing", "en", "s1", 45),
        (3, None, "en", "s2", None),
        (4, "", None, None, 0),
        (5, " \n\t ", "de", "s2", 4),
        (6, long, "en", None, len(long)),
        (None, "no id here but some words to look at", "fr", "s3", 36),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (7, "ünï cödé ßtraße \U0001f600 " * 40, "de", "s3", 800),
    ]
