"""The registered queries against their SQL, and the pipeline stage by stage."""

import re

import duckdb
import pytest

import corpus_pipeline
from stopclock.llm import decontamination, mixing, registry, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "embeddings"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours, theirs = registry.QUERIES[name](spark, SF), duck.sql(registry.ORACLE_SQL[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    expected = sorted((tuple(r) for r in theirs.select(*ours.columns).fetchall()), key=str)
    assert sorted((tuple(r) for r in ours.collect()), key=str) == expected


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLE_SQL])
def test_query_gives_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.QUERIES[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = {r.doc_id: r for r in docs.collect()}
    # By hand: each stage's rule on what the one before it kept.
    model = toxicity.learn(docs, labels)
    ids = [i for i in sorted(rows) if model.probabilities([rows[i].text])[0, 1] < 0.5]
    fps = {i: simhash.fingerprint(rows[i].text) for i in ids}
    root = {i: i for i in ids}
    for _ in ids:
        new = {i: min(root[j] for j in ids if (fps[i] ^ fps[j]).bit_count() <= 4) for i in ids}
        if new == root:
            break
        root = new
    ids = [i for i in ids if root[i] == i]
    left = spark.createDataFrame([rows[i] for i in ids], docs.schema)
    dirty = {r.doc_id for r in decontamination.decontaminate(left, benchmark).filter("contaminated").collect()}
    left = left.filter(~left.doc_id.isin([*dirty, -1]))
    copies = {r.doc_id: r.copies for r in mixing.mix(mixing.sized(left)).collect() if r.copies}

    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*corpus_pipeline.COLUMNS, "shard", "slot"]
    got = got.collect()
    count = {}
    for r in got:
        assert (r.text, r.lang, r.source, r.n_chars) == tuple(rows[r.doc_id])[1:]
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == copies
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(24)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1


def test_stages_take_odd_rows_and_empty_tables(spark, make_docs, odd_rows):
    for rows in (odd_rows, []):
        docs = make_docs(rows, clash=True)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.columns[:5] == list(corpus_pipeline.COLUMNS)
        assert docs.count() >= 0
