"""Mixing against systematic sampling along a sorted list."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from stopclock.llm import mixing


def targets_by_hand(sizes):
    """Share by weight, cut what is above its cap, share the rest, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    budget, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if budget * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: budget * weight[s] / total for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
        budget -= sum(target[s] for s in above)
        open_ -= above
    return target


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _check(docs, rows, **how):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + _size(r[1])
    target = targets_by_hand(sizes)
    got = mixing.mix(mixing.sized(docs), **how).collect()
    assert len(got) == len(rows)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(target[source]) for r in own)
        rate = own[0].target / size if size else 0.0
        assert all(math.floor(rate) <= r.copies <= math.ceil(rate) for r in own)
        name = "7:null" if source is None else f"7:s{source}"
        u = int(hashlib.md5(name.encode()).hexdigest()[:5], 16) / (1 << 20)
        assert sum(r.copies for r in own) == math.floor(rate * len(own) + u)
        # In the order of sizes, the copies of the first k documents are known for every size that ends at k.
        own.sort(key=lambda r: r.size)
        for k in range(1, len(own) + 1):
            if k == len(own) or own[k].size > own[k - 1].size:
                assert sum(r.copies for r in own[:k]) == math.floor(rate * k + u)
        taken = sum(r.copies * r.size for r in own)
        assert abs(taken - own[0].target) <= 2 * max(r.size for r in own) + 1
    return got


@pytest.mark.parametrize("per_salt", [20_000, 7])
def test_random_sources(make_docs, per_salt):
    rng = random.Random(5)
    rows = []
    for k in range(900):
        source = rng.choice(["a", "B", "é", "c1", None, "hot", "hot", "hot"])
        rows.append((k, " ".join(["w"] * rng.choice([0, 1, 5, 5, 5, 80])), "en", source, 0))
    _check(make_docs(rows), rows, rows_per_salt=per_salt)


def test_reruns_agree_whatever_the_partitions(make_docs):
    rows = [(k, "w " * (k % 17), "en", f"s{k % 4}", 0) for k in range(500)]
    first = {r.doc_id: r.copies for r in mixing.mix(mixing.sized(make_docs(rows))).collect()}
    again = {r.doc_id: r.copies for r in mixing.mix(mixing.sized(make_docs(rows[::-1]).repartition(13))).collect()}
    assert first == again


def test_no_python_in_the_plan(spark):
    df = mixing.op9_mixing(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, clash=True)
    got = _check(docs, odd_rows)
    emitted = mixing.emit(mixing.mix(mixing.sized(docs)))
    assert emitted.count() == sum(r.copies for r in got)
    assert {"doc_id", "text", "row", "rank"} <= {*emitted.columns}
    assert mixing.mix(mixing.sized(make_docs([]))).collect() == []
    assert mixing.mix(mixing.sized(make_docs([(1, None), (2, "")]))).agg(F.sum("copies")).first()[0] == 0


@pytest.mark.parametrize("equal", [False, True])
def test_a_third_of_the_rows_under_one_id_is_many_tasks(spark, make_docs, equal):
    """All of one source and size, a third of them under one id, with one text or many."""
    rows = [(None if k % 3 == 0 else k, "same text" if equal else f"text {k}", "en", "s", 0) for k in range(12_000)]
    docs = mixing.sized(make_docs(rows)).withColumn("number", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        mixed = mixing.mix(docs, rows_per_salt=100, spread="number")
        sizes = mixed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 12_000 and max(sizes) < 1.5 * 12_000 / len(sizes)
    got = mixed.collect()
    # Its target is one and a half times its words.
    assert abs(sum(r.copies * r.size for r in got) - 36_000) <= 4 and max(r.copies for r in got) == 2
