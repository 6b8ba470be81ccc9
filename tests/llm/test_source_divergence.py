"""Source divergence: the transducer against a sorted list, the audit against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stopclock.llm import source_divergence as sd
from stopclock.llm import transducer
from stopclock.llm.transducer import Transducer, build


def plain_terms(text):
    text = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(rows, min_docs, top):
    rows = [(lang or "", source or "", plain_terms(text)) for lang, source, text in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, _, w in rows:
        docs[lang].update(set(w))
    kept = {lang: sorted((t for t, n in found.items() if n >= min_docs), key=str.encode) for lang, found in docs.items()}
    for lang, source, w in rows:
        for of in ((lang, source), lang):
            counts[of].update(t for t in w if t in set(kept[lang]))
    share = lambda of, t, v: 1 + 10**9 * (counts[of][t] + 5) // (sum(counts[of].values()) + 5 * v)
    out = []
    for lang, source in sorted({r[:2] for r in rows}):
        terms = kept.get(lang, [])
        own = {t: share((lang, source), t, len(terms)) for t in terms}
        others = {s for at, s, _ in rows if at == lang and s != source}
        pairs = [(s, sum(abs(own[t] - share((lang, s), t, len(terms))) for t in terms)) for s in others]
        above = [(t, own[t] - share(lang, t, len(terms))) for t in terms if counts[lang, source][t]]
        for part, found, most in (("pair", pairs, None), ("term", [f for f in above if f[1] > 0], top)):
            found.sort(key=lambda f: (-f[1], f[0].encode()))
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def some_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "THEN", "öl", "Öl", "x", "a-b", "日本", "thenceforward", "then", "of", "off", "naïve", "thenceforth"]
    text = lambda: " ".join(rng.choice(words[: rng.randrange(1, 15)]) for _ in range(rng.randrange(12)))
    rows = [(rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "Ä", None, "s10", "z"]), rng.choice([text(), text(), None])) for _ in range(n)]
    return rows + [("xx", "only", "1 2 3"), ("xx", "other", None), ("yy", "alone", "the the")]


@pytest.mark.parametrize(("seed", "how"), [(1, {}), (2, {"block_terms": 2, "pack_bytes": 1}), (3, {"block_terms": 3, "tile": 2, "ordinals": 2}), (4, {"pack_bytes": 300, "block_terms": 1, "tile": 1, "ordinals": 3})])
def test_same_as_counting(spark, seed, how, monkeypatch):
    rows = some_rows(seed)
    monkeypatch.setattr(sd, "_FLUSH", 5)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "'mine' AS data", "1 AS n", "2 AS number")
    got = sd.audit(docs, min_docs=5, top=3, **how)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 3)


def test_odd_tables(spark, make_docs, odd_rows):
    assert sd.audit(make_docs([])).collect() == []
    long = " ".join(["lorem", "ipsum", "y" * 300] * 200_000)  # cut into several stretches, at words
    rows = [*odd_rows, (20, long, "en", "s1", 0), (20, long, "en", "s1", 0), (21, "z" * (3 << 20) + " lorem", "en", "s9", 0)]
    got = sorted(map(tuple, sd.audit(make_docs(rows, clash=True), min_docs=2).collect()))
    assert got == brute([(r[2], r[3], r[1]) for r in rows], 2, 50)


@pytest.mark.parametrize("cells", [transducer.MAX_CELLS, 0])
def test_transducer_gives_places_in_order(cells, monkeypatch):
    monkeypatch.setattr(transducer, "MAX_CELLS", cells)
    rng = random.Random(7)
    strings = sorted({bytes(rng.choice(b"abcd\xc3\xa4") for _ in range(rng.randrange(1, 9))) for _ in range(900)})
    known = Transducer.unpacked(build(strings).packed())
    asked = strings + [s + b"a" for s in strings] + [s[:-1] for s in strings] + [b"", b"zz"]
    data = np.frombuffer(b"".join(asked) + b"!", np.uint8)
    length = np.array([len(s) for s in asked])
    got = known.ordinals(data, np.cumsum(length) - length, length)
    place = {s: k for k, s in enumerate(strings)}
    assert got.tolist() == [place.get(s, -1) for s in asked]
    with pytest.raises(ValueError):
        build([b"b", b"a"])
    assert build([]).ordinals(data, np.array([0]), np.array([1])).tolist() == [-1]


def test_transducer_is_minimal():
    strings = sorted(p + m + s for p in (b"un", b"re", b"") for m in (b"do", b"tie", b"plug") for s in (b"", b"s", b"ing", b"ings"))
    known = build(strings)
    # As many states as there are different sets of continuations.
    prefixes = {s[:k] for s in strings for k in range(len(s) + 1)}
    assert len(known.final) == len({frozenset(s[len(p) :] for s in strings if s.startswith(p)) for p in prefixes})
