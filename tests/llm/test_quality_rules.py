"""Quality rules: counts against plain Python, host verdicts against the formulas."""

import re
from collections import Counter

import pytest

from stopclock.llm import quality_rules, statistics


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = ["", None, "a", "a b a b a b", "x\ny\nx\n \n \n", "a  b\ta b a b", "é# *$ é# *$ é#", "w " * 100, "a b c d\x0ba b c\x0c\r\n\na b c"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    got = dict(zip(statistics.COUNTS, statistics.counts(text), strict=True))
    assert tuple(got[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain_counts(text)


def test_odd_rows(make_docs, odd_rows):
    judged = quality_rules.judge_documents(make_docs(odd_rows, clash=True))
    kept = quality_rules.keep(judged, quality_rules.host_verdicts(judged)).collect()
    assert len(kept) == len(odd_rows)
    by_id = {r.doc_id: r for r in kept}
    assert by_id[6].n_words == 60_000 and by_id[6].base_failed and not by_id[6].kept
    assert by_id[3].n_words == 0 and by_id[3].base_failed
    empty = quality_rules.judge_documents(make_docs([]))
    assert quality_rules.keep(empty, quality_rules.host_verdicts(empty)).collect() == []


def test_small_bad_host_is_pulled_to_the_others_and_large_one_is_not(make_docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "en", f"good{i % 20}", 0) for i in range(200)]
    rows += [(1000 + i, "short", "en", f"tiny{i}", 0) for i in range(2)] + [(1010, good, "en", "tiny0", 0)]
    rows += [(2000 + i, good if i % 4 == 0 else "short", "en", "bad", 0) for i in range(400)]
    judged = quality_rules.judge_documents(make_docs(rows))
    verdicts = {r.host: r for r in quality_rules.host_verdicts(judged).collect()}
    rates = [0.0] * 20 + [0.5, 1.0, 0.75]
    mean = sum(rates) / len(rates)
    var = sum((r - mean) ** 2 for r in rates) / len(rates)
    k = mean * (1 - mean) / var - 1
    assert verdicts["bad"].short_rate == pytest.approx((300 + mean * k) / (400 + k))
    assert verdicts["bad"].host_failed and not verdicts["tiny0"].host_failed and not verdicts["good1"].host_failed
    kept = {r.doc_id: r.kept for r in quality_rules.keep(judged, quality_rules.host_verdicts(judged)).collect()}
    assert kept[0] and kept[1010] and not kept[2000] and not kept[2001]
