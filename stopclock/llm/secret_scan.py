"""Secret scans: patterns, and a battery of randomness tests for strings that fit none.

Patterns give the spans of kind ``assign``, ``access`` and ``hex``. Every other unbroken run
of at least ``MIN_LENGTH`` characters that occur in encoded keys is tested. Its encoding is the
smallest alphabet that holds all of its characters, and three statistics are taken:

* chi-squared of its characters against uniform use of that alphabet;
* runs: how often neighbours differ in kind (lower case, upper case, digit, mark);
* serial correlation of neighbouring places in the alphabet.

Each has known moments for a random string of that length and alphabet. Squared and summed, the
three deviations say whether the string passes for random (``pass_level``). As a short
string passes easily, that isn't enough: uniformity and runs also have moments for ordinary words
of the corpus strung together to that length, taken from a table of neighbouring characters
counted over all documents. How likely such words come as near to randomness is a p-value
for either test, and twice the lesser one is that of the string, which holds however the tests
depend on each other. Within each encoding and class of length (half an octave) Benjamini
and Hochberg's step-up rule then controls the share of ordinary strings among those reported, at
``FALSE_SHARE``; many short candidates don't raise the bar for long ones, nor long ones lower it
for short. What passes for random and not for words is reported as ``random``, unless a
pattern's span holds all of it.

``learn`` reads the texts twice: characters first, then p-values by class and tenth of a power of
ten; the tables that reach the driver have a bounded number of rows. ``scan`` reads them once.

Defined results: a null text is empty and has no spans; positions are code points, ends are
exclusive; strings of digits alone have no encoding and are not tested, nor are those with
marks of two encodings; equal rows stay, ids are not looked at; no documents, no rows;
a column ``secrets`` is replaced, all others kept. A text of any length is read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.llm import _common as c

MIN_LENGTH = 20
FALSE_SHARE = 0.01
PASS_LEVEL = 0.001
#: In the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "random")

# The patterns of known secrets, and the least length of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# The alphabets of usual encodings in their order of value, smallest first.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
CHARACTERS = _UPPER + _LOWER + _DIGITS + "+/-_"
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}")
_PIECE = 1 << 20


def _places(alphabet: str) -> np.ndarray:
    """The place of each byte in the alphabet, or -1."""
    table = np.full(256, -1, np.int16)
    table[list(alphabet.encode())] = np.arange(len(alphabet))
    return table


def _kind_of(alphabet: str) -> np.ndarray:
    return np.array([0 if ch in _LOWER else 1 if ch in _UPPER else 2 if ch in _DIGITS else 3 for ch in alphabet])


_TABLES = {name: _places(alphabet) for name, alphabet in ALPHABETS.items()}
_KINDS = {name: _kind_of(alphabet) for name, alphabet in ALPHABETS.items()}
_ANY = _places(CHARACTERS)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the patterns find."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return spans + [(*m.span(), "hex") for m in HEX.finditer(text)]


def _may_assign(text: str) -> bool:
    low = text.encode("utf-8", "replace").lower()  # A-Z alone
    return any(word in low for word in (b"passw", b"secret", b"token", b"api"))


def inferred(token: bytes) -> str | None:
    """The encoding with the smallest alphabet that has all characters."""
    if token.isdigit():
        return None
    data = np.frombuffer(token, np.uint8)
    return next((name for name, table in _TABLES.items() if (table[data] >= 0).all()), None)


@dataclass(frozen=True)
class Statistics:
    """Of one string: its length and what the three tests look at."""

    encoding: str
    n: int
    chi2: float
    changes: int
    serial: float


def measured(token: bytes, encoding: str) -> Statistics:
    place = _TABLES[encoding][np.frombuffer(token, np.uint8)].astype(np.int64)
    n, k = len(place), len(ALPHABETS[encoding])
    chi2 = float((np.bincount(place, minlength=k) ** 2).sum()) * k / n - n
    kinds = _KINDS[encoding][place]
    x = (place - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
    return Statistics(encoding, n, chi2, int(np.count_nonzero(kinds[1:] != kinds[:-1])), float((x[1:] * x[:-1]).mean()))


def random_level(s: Statistics) -> float:
    """How likely a random string deviates that much, the three tests together."""
    k = len(ALPHABETS[s.encoding])
    shares = np.bincount(_KINDS[s.encoding]) / k
    same, thrice = float((shares**2).sum()), float((shares**3).sum())
    spread = (s.n - 1) * (same - same**2) + 2 * (s.n - 2) * (thrice - same**2)
    # Wilson and Hilferty: the cube root has no skew to speak of.
    small = 2 * (s.n - 1) / (9 * (k - 1) * s.n)
    z = (
        ((s.chi2 / (k - 1)) ** (1 / 3) - (1 - small)) / math.sqrt(small),
        (s.changes - (s.n - 1) * (1 - same)) / math.sqrt(spread),
        s.serial * math.sqrt(s.n - 1),
    )
    q = sum(x * x for x in z)
    # Upper tail of chi-squared with three degrees of freedom.
    return math.erfc(math.sqrt(q / 2)) + math.sqrt(2 * q / math.pi) * math.exp(-q / 2)


def _log_tail(z: float) -> float:
    """log P(Z < z)."""
    if z > -30:
        return math.log(max(0.5 * math.erfc(-z / math.sqrt(2)), 1e-300))
    return -z * z / 2 - math.log(-z * math.sqrt(2 * math.pi))


@dataclass(frozen=True)
class Words:
    """The characters of ordinary words, as far as one encoding has them."""

    square: float  # sums of squared and cubed shares of the characters
    cube: float
    change: float  # chance that neighbours differ in kind

    @classmethod
    def of(cls, pairs: np.ndarray, encoding: str) -> Words:
        """From a table of neighbours over ``CHARACTERS``."""
        alphabet = ALPHABETS[encoding]
        at = [CHARACTERS.index(ch) for ch in alphabet]
        # A little of every pair: nothing is impossible that wasn't seen.
        table = pairs[np.ix_(at, at)] + 0.01
        table = table / table.sum()
        share, kinds = table.sum(1), _KINDS[encoding]
        return cls(float((share**2).sum()), float((share**3).sum()), float(table[kinds[:, None] != kinds].sum()))

    def log_level(self, s: Statistics) -> float:
        """Natural logarithm of the chance that words come as near to randomness."""
        n, k = s.n, len(ALPHABETS[s.encoding])
        mean = k * (1 - self.square) + n * k * self.square - n
        spread = k / n * math.sqrt(4 * n**3 * max(0.0, self.cube - self.square**2) + 2 * n**2 * self.square**2)
        uniform = _log_tail((s.chi2 - mean) / spread)
        rate = s.changes / (n - 1)
        changes = 0.0
        if rate > self.change:  # Chernoff's bound; words change in pairs, into a number or capital and out of it
            changes = -(n - 1) / 2 * (rate * math.log(rate / self.change) + (0 if rate == 1 else (1 - rate) * math.log((1 - rate) / (1 - self.change))))
        return min(0.0, math.log(2) + min(uniform, changes))


def _class(s: Statistics) -> tuple[str, int]:
    return s.encoding, int(2 * math.log2(s.n))


def _bin(log_level: float) -> int:
    """Tenths of a power of ten; bin b holds levels of at most 10 ** (-b / 10)."""
    return min(5_000, int(-log_level / math.log(10) * 10))


def candidates(text: str) -> Iterator[tuple[int, int, Statistics]]:
    """(start, end, statistics) of the strings with an encoding."""
    for m in _RUN.finditer(text):
        token = m[0].encode()
        if encoding := inferred(token):
            yield m.start(), m.end(), measured(token, encoding)


@dataclass(frozen=True)
class Battery:
    """The words of the corpus by encoding, and the first bin reported of each class."""

    words: Mapping[str, Words]
    least_bin: Mapping[tuple[str, int], int] = field(default_factory=dict)
    pass_level: float = PASS_LEVEL

    def spans(self, text: str | None) -> list[tuple[str, int, int, str | None, float | None]]:
        """(kind, start, end, encoding, logarithm of the level) in the order of listing."""
        text = text or ""
        if not _RUN.search(text) and not _may_assign(text):
            return []  # what all patterns but the first find is part of a run
        found = [(kind, start, end, None, None) for start, end, kind in base_spans(text)]
        for start, end, s in candidates(text):
            log_level = self.words[s.encoding].log_level(s)
            least = self.least_bin.get(_class(s))
            if least is None or _bin(log_level) < least or random_level(s) < self.pass_level:
                continue
            if not any(b <= start and end <= e for _, b, e, _, level in found if level is None):
                found.append(("random", start, end, s.encoding, log_level))
        return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def step_up(counts: Mapping[int, int], false_share: float) -> int | None:
    """Benjamini and Hochberg: the lowest bin whose levels are all small enough for their rank."""
    total, rank, least = sum(counts.values()), 0, None
    for b in sorted(counts, reverse=True):
        rank += counts[b]
        if 10 ** (-b / 10) <= false_share * rank / total:
            least = b
    return least


def neighbours(texts: DataFrame) -> np.ndarray:
    """Over all texts, how often characters follow each other in words too short to be tested, which
    are strung together within each piece of a text."""
    k = len(CHARACTERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for batch in batches:
            for text in batch[0]:
                data = text.as_py() or b""
                for at in range(0, len(data), _PIECE):
                    place = _ANY[np.frombuffer(data[at : at + _PIECE], np.uint8)].astype(np.int64)
                    edges = np.flatnonzero(np.diff(place >= 0, prepend=False, append=False))
                    start, end = edges[::2], edges[1::2]
                    for long in np.flatnonzero(end - start >= MIN_LENGTH):
                        place[start[long] : end[long]] = -1
                    place = place[place >= 0]
                    total += np.bincount(place[:-1] * k + place[1:], minlength=k * k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["pair", "n"])

    counted = texts.select(F.col("text").cast("binary")).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.zeros(k * k)
    for r in counted.collect():  # one number for each pair of characters
        table[r["pair"]] = r["n"]
    return table.reshape(k, k)


def learn(docs: DataFrame, *, false_share: float = FALSE_SHARE, pass_level: float = PASS_LEVEL) -> Battery:
    """Words and limits, from all texts of ``docs``."""
    pairs = neighbours(docs)
    words = {name: Words.of(pairs, name) for name in ALPHABETS}

    def levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update((*_class(s), _bin(words[s.encoding].log_level(s))) for _, _, s in candidates(text or ""))
        rows = [(*key, n) for key, n in seen.items()]
        yield pd.DataFrame(rows, columns=["encoding", "length", "bin", "n"])

    counted = docs.select("text").mapInPandas(levels, "encoding string, length int, bin int, n long")
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for r in counted.groupBy("encoding", "length", "bin").agg(F.sum("n").alias("n")).collect():  # encodings x classes x bins
        counts.setdefault((r["encoding"], r["length"]), {})[r["bin"]] = r["n"]
    least = {of: b for of, found in counts.items() if (b := step_up(found, false_share)) is not None}
    return Battery(words, least, pass_level)


_SPANS = "array<struct<kind: string, start: int, `end`: int, encoding: string, log_level: double>>"


def scan(docs: DataFrame, battery: Battery) -> DataFrame:
    """Add ``secrets``, all spans in the order of their start."""

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "encoding", "log_level")
        return pd.Series([[dict(zip(names, s, strict=True)) for s in battery.spans(t)] for t in texts], dtype=object)

    return docs.withColumn("secrets", spans("text"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, learn(docs))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"),
    )
