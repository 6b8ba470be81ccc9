"""Counts over one whole text, for the quality rules and the quality classifier."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
COUNTS = (
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct", "n_top_word", "n_same_word", "n_upper", "n_digits", "n_marks", "n_upper_words",
)
SCHEMA = ", ".join(f"{name} long" for name in COUNTS)


def _in_repeated_windows(ids: np.ndarray, n_distinct: int) -> int:
    """Words inside a three-word window that occurs twice or more."""
    if len(ids) < 3:
        return 0
    pairs = ids[:-1] * n_distinct + ids[1:]
    if n_distinct > 1 << 20:  # three ids no longer fit in one number
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * max(n_distinct, 1) + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """One number for each of ``COUNTS``; all 0 for a null or empty text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "replace")
    words = data.split()  # at ASCII white space, the six characters of WHITE
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    seen = np.frombuffer(data, np.uint8)
    upper = (seen >= 65) & (seen <= 90)
    digits = (seen >= 48) & (seen <= 57)
    other = (seen > 32) & (seen < 127) & ~upper & ~digits & ~((seen >= 97) & (seen <= 122))
    return (
        len(text),
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _in_repeated_windows(ids, len(number)),
        len(number),
        int(np.bincount(ids).max()) if len(ids) else 0,
        int((ids[1:] == ids[:-1]).sum()),
        int(upper.sum()),
        int(digits.sum()),
        int(other.sum()),
        sum(w.isupper() for w in number),
    )


def table(texts: Sequence[str | None]) -> pd.DataFrame:
    return pd.DataFrame([counts(t) for t in texts], columns=list(COUNTS), dtype="int64")


def of_text(column: str) -> Column:
    """A struct of the counts of each whole text."""

    @F.pandas_udf(SCHEMA)
    def text_counts(texts: pd.Series) -> pd.DataFrame:
        return table(texts.tolist())

    return text_counts(column)
