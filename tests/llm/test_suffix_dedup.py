"""Suffix dedup against counting every string of every text."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stopclock.llm import suffix_dedup


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(docs, **how):
    found = suffix_dedup.remove_repeats(docs, **how).drop("spans").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute(rows, suffix_dedup.LENGTH)
    assert sum(r[2] for r in expected) > 0
    got = suffix_dedup.op1_suffix_dedup(spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_pasted_pieces(make_docs, seed):
    rng = random.Random(seed)
    letters = "ab" if seed == 1 else "abcdefgh é"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    pool = [make(n) for n in (63, 64, 65, 90, 150, 400)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(pool)[rng.randrange(20) :] if rng.random() < 0.5 else make(rng.randrange(60)) for _ in range(rng.randrange(6)))
        rows.append((i, text))
    rows += [(100, "x" * 64), (101, "y" * 65), (102, "z" * 500), (103, make(64) * 2), (0, rows[1][1])]
    assert ours(make_docs(rows), length=64, batches=3) == brute(rows, 64)


def test_odd_rows(make_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows if r[0] != 6]
    assert ours(make_docs([r for r in odd_rows if r[0] != 6], clash=True), length=200) == brute(rows, 200)
    long = [r for r in odd_rows if r[0] == 6]
    [row] = suffix_dedup.remove_repeats(make_docs(long)).collect()
    assert (row.n_removed, row.n_spans, row.kept_sha256) == (300_000, 1, hashlib.sha256(b"").hexdigest())
    assert [[int(x) for x in s] for s in row.spans] == [[0, 300_000]]


def test_empty_table(make_docs):
    assert ours(make_docs([])) == []


def test_levels_hold_powers_of_two(spark):
    from stopclock.llm._common import shared_folder

    family = suffix_dedup.IndexFamily(spark, shared_folder(spark))
    batch = lambda *rows: spark.createDataFrame(rows, "h long, block long")
    assert family.insert(batch((1, 10), (2, 20))).collect() == []
    assert [tuple(r) for r in family.insert(batch((1, 10), (3, 30))).collect()] == [(1, 10, 10)]
    assert list(family.levels) == [1]
    assert [tuple(r) for r in family.insert(batch((3, 31), (4, 40), (4, 40))).orderBy("h").collect()] == [(3, 30, 31), (4, 40, 40)]
    assert sorted(family.levels) == [0, 1]
    family.insert(batch((9, 90)))
    assert list(family.levels) == [2]
    top = {r.h: (r.low, r.high, r.many) for r in family.levels[2].collect()}
    assert top == {1: (10, 10, True), 2: (20, 20, False), 3: (30, 31, True), 4: (40, 40, True), 9: (90, 90, False)}
