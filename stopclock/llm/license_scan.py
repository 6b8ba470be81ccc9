"""License scans by conditional compression.

Sentences with a licensing cue, however their lines are wrapped and commented, are candidate
blocks. In each, every template is aligned
with the words that it explains best, wherever they stand in the block; only what the block lacks or
adds within that span is a difference. Names of licenses (``PHRASES``) and numbers must be there as
they are, no other name or number may come between, and the other differences may
be ``max_difference`` of the template's words at most. So ``version 2`` is never taken for
``version 3``, nor ``GNU Lesser General`` for ``GNU General``. The span is compressed alone, and with
the template as a raw zstandard dictionary; the share of its size that this saves must
be ``min_gain`` at least. Of overlapping spans the one stays that explains the most words, then the
one that saves most; so a block that names several licenses has them all.

A task remembers the answers for the last blocks, as license lines repeat; blocks
are never gathered, so a line in a third of all documents costs no shuffle.

Defined results: a null or empty text has no candidates; equal rows stay; a text of
any length is read to its end; a candidate that no template explains is
counted, without a license; one that names several licenses counts once for each.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# License identifiers, and the sentences by which works name them, by which
# headers and short licenses grant, and titles of the longer texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
#: Names of licenses, word for word and nothing between.
PHRASES = (
    "apache license", "cc by", "cc by-nc", "cc by-sa", "cc0", "creative commons attribution", "creative commons attribution-noncommercial",
    "creative commons attribution-sharealike", "gnu general public license", "gnu lesser general public license", "mit license", "mozilla public license",
)
#: Words by which a license is told from another; none may be added.
NAMES = frozenset("affero apache bsd by-nc by-nc-nd by-nc-sa by-nd by-sa cc cc0 gnu lesser mit mozilla non-commercial no-derivatives noderivatives noncommercial share-alike sharealike".split())
CUE = r"(?i)\b(licen[sc]e[ds]?|licensing|copyright|permission|redistribut\w*|CC[ -]BY\S*|CC0|waived)\b"
MAY_HAVE = r"(?i)\b(licen[sc]|copyright|permission|redistribut|CC\b|CC0|waived)"
#: Marks of comments and quotes at the beginning and end of lines.
MARKS = (
    r"(?m)^[ \t]*(?:(?:/{2,}|/\*+|\*+/?|#+|--+|;+|%+|<!--|\(\*|\{-|>+|\|+|'{3}|\x22{3}|(?:@?REM|dnl)\b|['!](?=[ \t]))[ \t]*)+",
    r"(?m)[ \t]*(?:\*+/|-->|\*+\)|-\}|\|+|\*+|#+)[ \t]*$",
)
MIN_GAIN = 0.2
MAX_DIFFERENCE = 0.25
REMEMBERED = 10_000
REMEMBERED_CHARS = 4_096


def candidates(text: Column) -> Column:
    """Sentences with a cue, in order. Comment marks are taken off; lines up to a blank one are
    one paragraph (a word cut at its hyphen is whole again), which is cut after a full stop, exclamation or question mark that a space and
    a capital or digit follow (but not in ``v. 2.0``)."""
    plain = F.regexp_replace(text, r"\r\n?", "\n")
    for marks in MARKS:
        plain = F.regexp_replace(plain, marks, "")
    plain = F.regexp_replace(plain, r"(?<=\p{L}-)[ \t]*\n[ \t]*(?=\p{L})", "")
    pieces = F.split(plain, r"\n\s*\n|(?<=[.!?])(?<!\b[vV]\.)\s+(?=[A-Z0-9])")
    pieces = F.transform(pieces, lambda piece: F.trim(F.regexp_replace(piece, r"\s+", " ")))
    found = F.filter(pieces, lambda piece: piece.rlike(CUE))
    # A cue has no line break but that of "CC BY", which may be wrapped and commented.
    return F.when(text.rlike(MAY_HAVE), found).otherwise(F.array().cast("array<string>"))


_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def spoken(block: str) -> list[str]:
    """Words in lower case; a number keeps its inner points."""
    return [w.lower() for w in _WORD.findall(block)]


class Template:
    """A license's wording: what its words cost where they lack, what more words cost."""

    def __init__(self, name: str, text: str, max_difference: float):
        self.name, self.words = name, spoken(text)
        n = len(self.words)
        self.most = int(max_difference * n)
        self.lack, self.add = [1] * n, [1] * (n + 1)  # self.add[i]: before word i
        for i, w in enumerate(self.words):
            if any(ch.isdigit() for ch in w):
                self.lack[i] = self.most + 1
        for phrase in map(str.split, PHRASES):
            for i in range(n - len(phrase) + 1):
                if self.words[i : i + len(phrase)] == phrase:
                    self.lack[i : i + len(phrase)] = [self.most + 1] * len(phrase)
                    self.add[i + 1 : i + len(phrase)] = [self.most + 1] * (len(phrase) - 1)
        # With ``most`` differences, one of most + 1 pieces at least is there unchanged.
        cuts = [n * k // (self.most + 1) for k in range(self.most + 2)]
        self.pieces = [(i, self.words[i:j]) for i, j in zip(cuts, cuts[1:]) if i < j]  # noqa: B905
        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False)

    def align(self, words: Sequence[str], never: frozenset[str]) -> tuple[int, int, int, tuple[str, ...]]:
        """Least cost, first word and end of the span that has it, its differences."""
        rows = [[0] * (len(words) + 1)]
        for i, expected in enumerate(self.words, 1):
            above, row, lack, add = rows[-1], [rows[-1][0] + self.lack[i - 1]], self.lack[i - 1], self.add[i]
            for j, w in enumerate(words, 1):
                cost = min(above[j] + lack, row[-1] + (self.most + 1 if w in never else add))
                row.append(min(cost, above[j - 1]) if w == expected else cost)
            rows.append(row)
        i, cost = len(self.words), min(rows[-1])
        j = end = rows[-1].index(cost)
        differences = []
        while i:
            if j and words[j - 1] == self.words[i - 1] and rows[i][j] == rows[i - 1][j - 1]:
                i, j = i - 1, j - 1
            elif j and rows[i][j] == rows[i][j - 1] + (self.most + 1 if words[j - 1] in never else self.add[i]):
                differences.append(f"+{words[j - 1]}")
                j -= 1
            else:
                differences.append(f"-{self.words[i - 1]}")
                i -= 1
        return cost, j, end, tuple(reversed(differences))

    def spans(self, words: Sequence[str], places: dict[str, list[int]], never: frozenset[str]) -> set[tuple[int, int, tuple[str, ...]]]:
        """(first word, end, differences) of the spans that this template explains."""
        begins = sorted({at - i for i, piece in self.pieces for at in places.get(piece[0], ()) if words[at : at + len(piece)] == piece})
        found, n, at = set(), len(self.words), 0
        while at < len(begins):
            first, at = begins[at], bisect.bisect(begins, begins[at] + n)
            parts = [(max(0, first - self.most), min(len(words), begins[at - 1] + n + self.most))]
            while parts:
                low, high = parts.pop()
                cost, first, end, differences = self.align(words[low:high], never)
                if cost <= self.most and first < end:
                    found.add((low + first, low + end, differences))
                    parts += [p for p in ((low, low + first), (low + end, high)) if p[1] - p[0] >= n - self.most]
        return found


class Scanner:
    """Templates, ready to align and compress with."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, *, min_gain: float = MIN_GAIN, max_difference: float = MAX_DIFFERENCE):
        self.min_gain = min_gain
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.templates = [Template(name, text, max_difference) for name, text in templates]
        self.never = NAMES | {w for t in self.templates for w in t.words if any(ch.isdigit() for ch in w)}
        self.remembered = lru_cache(REMEMBERED)(self._explain_all)

    def gain(self, span: str, template: Template) -> float:
        """Share of its compressed size that the template saves."""
        data = span.encode("utf-8", "replace")
        return 1 - len(template.compressor.compress(data)) / max(1, len(self.plain.compress(data)))

    def explain(self, block: str) -> tuple[str | None, float, tuple[str, ...]]:
        """License or None, share saved, wording differences (``-lacks``, ``+adds``) of the
        span that explains most."""
        best = max(self.explain_all(block), key=lambda found: len(found[0]))
        return best[1:]

    def explain_all(self, block: str) -> Sequence[tuple[str, str | None, float, tuple[str, ...]]]:
        """The same with the text of its span, for each span that a template explains, in
        order; without any, the block, no license and the best share saved."""
        return (self.remembered if len(block) <= REMEMBERED_CHARS else self._explain_all)(block)

    def _explain_all(self, block: str) -> list[tuple[str, str | None, float, tuple[str, ...]]]:
        where = [m.span() for m in _WORD.finditer(block)]
        words = [block[a:b].lower() for a, b in where]
        places: dict[str, list[int]] = {}
        for at, w in enumerate(words):
            places.setdefault(w, []).append(at)
        spans = []
        for k, template in enumerate(self.templates):
            for first, end, differences in template.spans(words, places, self.never):
                gain = self.gain(block[where[first][0] : where[end - 1][1]], template)
                if gain >= self.min_gain:
                    lacks = sum(d[0] == "-" for d in differences)
                    spans.append((lacks - len(template.words), -gain, k, first, end, differences))
        taken: list[tuple] = []
        for span in sorted(spans):
            if all(span[4] <= t[3] or t[4] <= span[3] for t in taken):
                taken.append(span)
        if not taken:
            return [(block, None, max((self.gain(block, t) for t in self.templates), default=0.0), ())]
        if len(taken) == 1:  # the whole block, with the stops around its words
            _, gain, k, _, _, differences = taken[0]
            return [(block, self.templates[k].name, -gain, differences)]
        return [
            (block[where[first][0] : where[end - 1][1]], self.templates[k].name, -gain, differences)
            for _, gain, k, first, end, differences in sorted(taken, key=lambda t: t[3])
        ]


_FOUND = "array<struct<block: string, license: string, gain: double, differences: array<string>>>"


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, **limits) -> DataFrame:
    """Add ``found``: each candidate block (or, where it names several licenses, each span) with its
    license (null: none), the share saved by the template, and the wording differences."""
    templates = list(templates)

    @F.pandas_udf(_FOUND)
    def explain(blocks: pd.Series) -> pd.Series:
        scanner = Scanner(templates, **limits)
        rows = []
        for some in blocks:
            found = [f for b in some for f in scanner.explain_all(b)]
            rows.append([{"block": b, "license": n, "gain": g, "differences": list(d)} for b, n, g, d in found])
        return pd.Series(rows)

    return docs.withColumn("found", explain(candidates(F.col("text"))))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    confirmed = F.filter("found", lambda f: f["license"].isNotNull())
    return docs.select(
        "doc_id",
        F.size("found").cast("long").alias("n_candidates"),
        F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda f: f["license"]))), ",").alias("licenses"),
        F.coalesce(F.aggregate(confirmed, F.lit(0), lambda n, f: n + F.size(f["differences"])), F.lit(0)).cast("long").alias("n_differences"),
        F.round(F.coalesce(F.array_max(F.transform("found", lambda f: f["gain"])), F.lit(0.0)), 6).alias("best_gain"),
    )
