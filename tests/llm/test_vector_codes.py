"""Vector codes against Lloyd's rounds over whole codebooks, in plain Python."""

import hashlib
import random

import numpy as np
import pytest

from stopclock.llm import vector_codes as vc

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, parts, entries, rounds):
    """(vec_id, codes, error) and the codebooks."""
    rows = [(i, [int(np.floor(4096 * np.float32(x).item())) for x in v]) for i, _, v in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in rows[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [[min((far(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(parts)] for _, v in rows]
    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v), n in zip(rows, near, strict=True) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, [k for _, k in n], sum(d for d, _ in n)) for (i, _), n in zip(rows, assign(), strict=True)), key=str), books


@pytest.mark.parametrize(("parts", "entries", "rounds", "grid"), [(8, 16, 6, 0), (2, 5, 3, 3), (4, 3, 8, 2)])
def test_same_as_whole_rounds(spark, parts, entries, rounds, grid):
    rng = random.Random(entries)
    # On a coarse grid distances tie all the time, and entries coincide.
    number = lambda: rng.randrange(-grid, grid + 1) / 4096 if grid else rng.gauss(0, 1)
    rows = [(k, k % 3, [number() for _ in range(parts * 2)]) for k in range(150)]
    rows += [rows[3], rows[40], (2, 0, [number() for _ in range(parts * 2)]), (None, 1, [0.0] * parts * 2)]
    coded, books = vc.compress(spark.createDataFrame(rows, SCHEMA), parts=parts, entries=entries, rounds=rounds)
    expected, plain = brute(rows, parts, entries, rounds)
    assert books.books.tolist() == plain
    assert books.sha256() == hashlib.sha256(",".join(str(x) for p in plain for e in p for x in e).encode()).hexdigest()
    assert sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=str) == expected


def test_active_entries_give_what_all_entries_give():
    rng = np.random.default_rng(5)
    for _ in range(50):
        parts, old = rng.integers(-3, 4, (60, 2)), rng.integers(-3, 4, (9, 2))
        new = np.where(rng.random((9, 1)) < 0.4, rng.integers(-3, 4, (9, 2)), old)
        moved = (new != old).any(1)
        for got, expected in zip(vc.reassign(parts, new, moved, *vc.nearest(parts, old)), vc.nearest(parts, new), strict=True):
            assert (got == expected).all()


def test_odd_rows(spark):
    good = [(k, None if k % 2 else 7, [0.1 * k] * 8) for k in range(5)]
    bad = [
        (90, 1, None), (91, 1, [0.5] * 7 + [None]), (92, 1, [float("nan")] * 8), (93, 1, [float("-inf")] + [0.0] * 7),
        (94, 1, []), (95, 1, [1.0] * 16), (96, 1, [1.0] * 9),
    ]
    table = spark.createDataFrame(good + good[:1] + bad, SCHEMA).selectExpr("*", "'mine' AS v", "'mine' AS row", "1 AS `of`", "'x' AS code")
    coded, books = vc.compress(table)
    found = vc.with_group_error(coded).collect()
    assert sorted(r.vec_id for r in found) == [0, 0, 1, 2, 3, 4] and books.books.shape == (8, 6, 1)
    assert {(r.error, r.label_error, r.v, r.row, r.of) for r in found} == {(0, 0, "mine", "mine", 1)}
    coded, books = vc.compress(spark.createDataFrame(bad[:4], SCHEMA))
    assert coded.collect() == [] and books.sha256() == hashlib.sha256(b"").hexdigest()
    far, _ = vc.compress(spark.createDataFrame([(1, 1, [1.0] * 8), (2, None, [3.0] * 8), (3, None, [5.0] * 8)], SCHEMA), entries=1, rounds=0)
    assert {(r.vec_id, r.label_error) for r in vc.with_group_error(far).collect()} == {(1, 0), (2, 8 * 4 * 5 << 24), (3, 8 * 4 * 5 << 24)}
    with pytest.raises(Exception, match="reaches"):
        vc.compress(spark.createDataFrame([(1, 1, [1e30] * 8)], SCHEMA))
