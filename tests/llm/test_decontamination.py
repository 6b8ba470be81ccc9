"""Decontamination against looking for every window in every text."""

import hashlib
import random
import re

import pytest

from stopclock.llm import decontamination as dc


def plain_words(text):
    text = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        if w:
            for i in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[i : i + window]), set()).update(() if item is None else (str(item),))
    out = []
    for i, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for k, owners in windows.items():
            for p in range(len(w) - len(k) + 1):
                if tuple(w[p : p + len(k)]) == k:
                    hit |= set(range(p, p + len(k)))
                    found |= owners
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def ours(docs, items, **how):
    found = dc.decontaminate(docs, items, **how)
    rows = found.select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
    return sorted(((r[0], r[1], r[2], r[3], hashlib.sha256(",".join(r[4]).encode()).hexdigest(), r[5]) for r in rows), key=str)


@pytest.mark.parametrize(("window", "bits", "piece"), [(13, 26, 1 << 20), (4, 12, 20), (3, 8, 50), (5, 6, 1 << 20), (5, 26, 1)])
def test_random_texts(spark, make_docs, window, bits, piece, monkeypatch):
    monkeypatch.setattr(dc, "_PIECE", piece)
    rng = random.Random(window)
    some = lambda n: " ".join(rng.choice(["The", "of", "a-b", "Öl", "x1", "it's", "no"]) for _ in range(n))
    items = [(k, some(rng.randrange(0, 20))) for k in range(12)] + [(100, "The"), (11, ""), (None, some(20)), (101, None)]
    docs = [(k, some(rng.randrange(0, 40)) + " " + (rng.choice(items)[1] or "") + " " + some(3)) for k in range(40)]
    docs += [(900, None), (901, ""), (902, items[1][1]), (902, items[1][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert ours(make_docs(docs), table, window=window, max_bits=bits) == brute(docs, items, window)


def test_a_full_bitmap_changes_nothing(spark):
    path = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = ours(docs, items)
    assert whole == ours(docs, items, max_bits=8) and sum(r[5] for r in whole) > 0


def test_an_item_without_an_id_marks_words(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(13))
    items = spark.createDataFrame([(None, text), ("b", "w1 w2")], "item_id string, text string")
    found = {r.doc_id: r for r in dc.decontaminate(make_docs([(1, text), (2, text[3:])]), items).collect()}
    assert (found[1].n_hit, found[1]["items"], found[1].contaminated) == (13, ["b"], True)
    assert (found[2].n_hit, found[2]["items"], found[2].spans) == (2, ["b"], [[0, 2]])


def test_long_texts_and_hot_shingles(spark, make_docs):
    """A text of many pieces whose shingles are all alike, and windows that only differ at their end."""
    rng = random.Random(9)
    base = ["the"] * 12
    items = [(f"i{k:03}", " ".join([*base, f"end{k}"])) for k in range(150)]
    long = " ".join(rng.choice(["the", "the", "the", "x", f"end{rng.randrange(300)}"]) for _ in range(30_000))
    planted = long[: len(long) // 2] + " " + items[7][1] + " " + long[len(long) // 2 :]
    docs = [(1, planted), (2, " ".join(["The"] * 5_000)), (3, planted), (4, items[9][1].upper())]
    table = spark.createDataFrame(items, "item_id string, text string")
    assert ours(make_docs(docs), table) == brute(docs, items, 13)


def test_a_large_benchmark_stays_off_the_driver(spark, make_docs, monkeypatch):
    """Neither windows nor shingles are collected: only lengths and the words of bitmaps are."""
    from pyspark.sql import classic

    collected, collect = [], classic.dataframe.DataFrame.collect
    monkeypatch.setattr(classic.dataframe.DataFrame, "collect", lambda self: collected.append(len(rows := collect(self))) or rows)
    items = spark.range(2_000).selectExpr("cast(id as string) AS item_id", "concat_ws(' ', transform(sequence(0, 29), i -> hash(id, i))) AS text")
    found = dc.decontaminate(make_docs([(1, "a b c")]), items)
    assert max(collected) <= 3 and found.count() == 1


def test_odd_rows(spark, make_docs, odd_rows):
    items = spark.createDataFrame([("b", "few words that says nothing"), ("a", "A plain text!")], "item_id string, text string")
    docs = make_docs(odd_rows, clash=True)
    found = dc.decontaminate(docs, items)
    assert {*docs.columns} <= {*found.columns}
    rows = {r.doc_id: r for r in found.collect()}
    assert (rows[1].n_hit, rows[1]["items"], rows[1].spans, rows[1].hit) == (8, ["a", "b"], [[0, 3], [5, 10]], "mine")
    assert not rows[3].contaminated and rows[3].n_words == 0
    assert found.count() == len(odd_rows)
    assert ours(make_docs([]), items) == []
    assert all(not r[5] for r in ours(make_docs(odd_rows), items.limit(0)))
