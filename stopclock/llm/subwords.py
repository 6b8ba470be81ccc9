"""Hashed character n-grams, averaged embeddings and a linear softmax, in numpy.

A text is lower-cased and read as UTF-8 bytes. Everything but letters, digits
and bytes of other alphabets separates words; a symbol between two letters
(``id!ot``) stays in its word. The n-grams of a word include the separator
before and after it. Each n-gram is hashed to one of ``buckets`` vectors; the
text is the mean of its vectors, and a softmax over the classes is trained
together with them. As no n-gram has an entry of its own, a misspelling that
was never seen still shares most of its n-grams with the word it hides.

After training, embedding and softmax fold into one number per bucket and
class, so a text is scored by looking numbers up and averaging them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = 32
CHUNK_BYTES = 1 << 20
PIECES = 8


def learned_part(text: Column, most_chars: int) -> Column:
    """What a model learns from a text: all of it, or of a longer one ``PIECES`` pieces of
    ``most_chars`` characters in all, each somewhere in its own eighth of the text by hash."""
    piece, stretch = most_chars // PIECES, F.floor(F.length(text) / PIECES)
    begin = lambda k: k * stretch + F.pmod(F.xxhash64(text, k), F.greatest(stretch - piece, F.lit(1)))
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.substr(text, (begin(k) + 1).cast("int"), F.lit(piece)))
    return F.when(F.length(text) > most_chars, F.array_join(pieces, " ")).otherwise(text)


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    letter = np.zeros(256, bool)
    letter[ord("0") : ord("9") + 1] = letter[ord("a") : ord("z") + 1] = letter[128:] = True
    symbol = np.zeros(256, bool)
    symbol[list(b"!$*@")] = True
    return letter, symbol


_LETTER, _SYMBOL = _byte_classes()


def normalized(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


@dataclass(frozen=True)
class Features:
    """The n-gram sizes in bytes and the number of buckets, a power of two."""

    sizes: tuple[int, ...] = (3, 4, 5)
    buckets: int = 1 << 17

    def of(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each size: the places in ``data`` where an n-gram begins, and their buckets."""
        letter = _LETTER[data]
        inside = _SYMBOL[data]
        inside[1:-1] &= letter[:-2] & letter[2:]
        inside[[0, -1]] = False
        letter |= inside
        data = np.where(letter, data, SEPARATOR).astype(np.uint32)
        hashed = np.zeros(len(data), np.uint32)
        inner = np.ones(len(data), bool)  # all but the first and last byte are letters
        for n in range(1, max(self.sizes) + 1):
            reach = len(data) - n + 1
            if reach <= 0:
                return
            hashed = (hashed[:reach] * np.uint32(16777619)) ^ (data[n - 1 :] + np.uint32(1))
            inner = inner[:reach]
            if n > 2:
                inner = inner & letter[n - 2 : n - 2 + reach]
            if n in self.sizes:
                at = np.flatnonzero(inner)
                h = hashed[at]
                h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519 + 2 * n)
                yield at, (h >> np.uint32(7)) & np.uint32(self.buckets - 1)

    def chunks(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row of each piece, first byte of each piece, bytes), of bounded size.

        Long texts come in several pieces, cut at a separator where there is one, so
        memory does not grow with a text.
        """
        rows, starts, parts, size = [], [], [], 0
        for row, text in enumerate(texts):
            data = normalized(text)
            at = 0
            while at < len(data):
                end = min(len(data), at + CHUNK_BYTES)
                if end < len(data):
                    cut = data.rfind(b" ", at + 1, end)
                    end = cut if cut > 0 else end
                rows.append(row)
                starts.append(size)
                parts += [b" ", data[at:end], b" "]
                size += end - at + 2
                at = end
                if size >= CHUNK_BYTES:
                    yield np.array(rows), np.array(starts), np.frombuffer(b"".join(parts), np.uint8)
                    rows, starts, parts, size = [], [], [], 0
        if rows:
            yield np.array(rows), np.array(starts), np.frombuffer(b"".join(parts), np.uint8)

    def bags(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Distinct buckets and their shares of the text's n-grams, for each text."""
        # A few texts at a time, as their n-grams take far more room than the bags.
        return [bag for at in range(0, len(texts), 64) for bag in self._bags(texts[at : at + 64])]

    def _bags(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for rows, starts, data in self.chunks(texts):
            for at, bucket in self.of(data):
                cuts = np.searchsorted(at, starts)
                for row, piece in zip(rows, np.split(bucket, cuts[1:]), strict=True):
                    found[row].append(piece)
        bags = []
        for pieces in found:
            ids, counts = np.unique(np.concatenate(pieces) if pieces else np.zeros(0, np.uint32), return_counts=True)
            bags.append((ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
        return bags


@dataclass(frozen=True)
class SubwordModel:
    """One number per bucket and class, and one per class."""

    features: Features
    weights: np.ndarray  # buckets x classes
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: Sequence[str | None]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.bias)))
        count = np.zeros(len(texts))
        for rows, starts, data in self.features.chunks(texts):
            for at, bucket in self.features.of(data):
                if not len(at):
                    continue
                owner = rows[np.searchsorted(starts, at, side="right") - 1]
                np.add.at(count, rows, np.diff(np.append(np.searchsorted(at, starts), len(at))))
                for k in range(len(self.bias)):
                    total[:, k] += np.bincount(owner, self.weights[:, k][bucket], len(texts))
        return (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        return softmax(self.logits(texts))

    SCHEMA = "weights binary, bias binary, temperature double"

    def packed(self) -> pd.DataFrame:
        """One row of ``SCHEMA``, in which the model leaves the task that has fitted it."""
        weights, bias = ([x.astype(np.float32).tobytes()] for x in (self.weights, self.bias))
        return pd.DataFrame({"weights": weights, "bias": bias, "temperature": [float(self.temperature)]})

    @classmethod
    def unpacked(cls, features: Features, row) -> SubwordModel:
        weights, bias = (np.frombuffer(x, np.float32) for x in (row.weights, row.bias))
        return cls(features, weights.reshape(-1, len(bias)), bias, row.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(
    texts: Sequence[str | None],
    labels: np.ndarray,
    n_classes: int,
    *,
    features: Features = Features(),
    dim: int = 8,
    seen: int = 50_000,
    rate: float = 0.5,
    batch: int = 128,
    init: float = 1.0,
    seed: int = 7,
) -> SubwordModel:
    """Stochastic gradient descent with per-coordinate step sizes over shuffled batches.

    About ``seen`` texts are gone through in all, so a smaller sample is gone through more
    often (30 times at most). A tenth of the texts is kept out and sets the softmax
    temperature.
    With no texts the model answers the same for everything.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.int64)
    table = (rng.standard_normal((features.buckets, dim)) * init / dim).astype(np.float32)
    head = (rng.standard_normal((dim, n_classes)) * init).astype(np.float32)
    bias = np.zeros(n_classes, np.float32)
    if not len(texts):
        return SubwordModel(features, np.zeros((features.buckets, n_classes), np.float32), bias)
    bags = features.bags(texts)
    tune = max(1, len(texts) // 10) if len(texts) >= 50 else 0
    order = rng.permutation(len(texts))
    fit = order[tune:]
    seen_table = np.full(table.shape, 1e-8, np.float32)
    seen_head, seen_bias = np.full(head.shape, 1e-8, np.float32), np.full(bias.shape, 1e-8, np.float32)
    epochs = max(2, min(30, seen // len(texts)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for chosen in np.array_split(rng.permutation(fit), max(1, len(fit) // batch)):
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] for i in chosen])
            sizes = np.array([len(bags[i][0]) for i in chosen])
            row = np.repeat(np.arange(len(chosen)), sizes)
            used, place = np.unique(ids, return_inverse=True)
            vectors = table[used]
            mean = np.stack([np.bincount(row, share * vectors[place, k], len(chosen)) for k in range(dim)], 1)
            off = softmax(mean @ head + bias)
            off[np.arange(len(chosen)), labels[chosen]] -= 1
            off /= len(chosen)
            back = off @ head.T
            for value, grad, seen in ((head, mean.T @ off, seen_head), (bias, off.sum(0), seen_bias)):
                seen += grad**2
                value -= step * grad / np.sqrt(seen)
            grad = np.stack([np.bincount(place, share * back[row, k], len(used)) for k in range(dim)], 1)
            seen_table[used] += grad**2
            table[used] = vectors - step * grad / np.sqrt(seen_table[used])
    model = SubwordModel(features, table @ head, bias)
    if tune:
        held = model.logits([texts[i] for i in order[:tune]])
        truth = labels[order[:tune]]
        grid = np.geomspace(0.25, 8, 21)
        loss = [-np.log(softmax(held / t)[np.arange(tune), truth] + 1e-12).mean() for t in grid]
        model = SubwordModel(features, model.weights, bias, float(grid[int(np.argmin(loss))]))
    return model
