"""Quality rules: plain text statistics, and a logistic regression over hashed word and character
n-grams, trained on labelled rows, probability-calibrated, scored in Arrow batches against fixed thresholds.

Features of a text are the shares of its hashed byte trigrams (``DIM`` buckets) and of its hashed
words and word pairs (``DIM`` more each), taken with numpy over the whole text. Training sees a
bounded sample of labelled rows (``labelled.sample``; ``rows_per_class``); their sparse
features are made on the executors. A fifth of them is kept apart to fit the
calibration (Platt's), each row weighted by the labelled rows of its class that it stands for, so that probabilities
have the labels' own shares of the classes, whatever the sample's. The model, less than 1 MB, goes to the executors with the tasks; scoring is one
pass without a shuffle.

Defined cases: null texts count as empty; a text without words fails the base rules; labels that are
null or repeat are left out or used as they come, one vote a row; without labels of both
classes the model gives every text the share of class 1 (1 if there are none), and base rules decide;
repeated rows and null ids are scored row by row; a probability equal to the threshold is good; very long texts are
taken whole, in some tens of bytes of memory a byte; an empty table gives none. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import labelled
from .common import column

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
DIM_BITS = 16
DIM = 1 << DIM_BITS
#: Base rules: fewest words, most percent of words in repeated windows, and the window.
MIN_WORDS, MOST_REPEATED, REPEAT_WINDOW = 10, 20, 5
#: A text stays if its probability of good quality, among texts as they are labelled, is at least this: it goes where
#: more than four in five of its like are bad.
THRESHOLD = 0.2
ROWS_PER_CLASS = 2000
#: Rows of the sample whose features a task holds.
SAMPLED_AT_ONCE = 64
_BASE, _SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    first: dict[tuple[bytes, ...], int] = {}
    repeated = bytearray(len(grams))
    for i, g in enumerate(grams):
        j = first.setdefault(g, i)
        if j != i:
            repeated[i] = repeated[j] = 1
    total = until = 0
    for i in np.flatnonzero(np.frombuffer(repeated, dtype=np.uint8)).tolist():
        total += i + window - max(i, until)
        until = i + window
    return total


def base_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()  # bytes.split: blanks are 20 and 09-0D
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = len(text) - sum(map(text.count, BLANKS))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


class Hasher:
    """Hashed features of texts; ``parts`` are their buckets by kind: trigrams, words, word pairs."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = 1 << n.bit_length()
            for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                factors = np.full(n, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))

    def parts(self, text: str) -> list[np.ndarray]:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        n = len(data)
        self._grow(n + 1)
        none = np.empty(0, dtype=np.int64)
        wide = data.astype(np.uint32)
        tri = ((wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16) * np.uint32(2654435761) >> np.uint32(32 - DIM_BITS)) if n >= 3 else none
        inside = np.zeros(n + 2, dtype=np.int8)
        inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if not len(starts):
            return [tri, none, none]
        # sums of byte * base^place, each word's moved to place 0
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n])])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        pair = (h[:-1] * np.uint64(3) + h[1:]) * np.uint64(_BASE)
        down = np.uint64(64 - DIM_BITS)
        return [tri, h * np.uint64(_SPREAD) >> down, pair * np.uint64(_SPREAD) >> down]


@dataclass
class Model:
    """One weight a bucket and kind; ``scale`` and ``shift`` turn the sum into a calibrated logit."""

    weights: np.ndarray
    bias: float
    scale: float
    shift: float

    def probability(self, parts: list[np.ndarray]) -> float:
        z = self.bias + sum(float(w[p].mean()) for w, p in zip(self.weights, parts, strict=True) if len(p))
        return float(1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -50, 50))))


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows_per_class: int) -> tuple[list, dict[int, float]]:
    """Rows (label, at, value): sparse features of the bounded sample, as bytes of int32 and float32; and
    how many labelled rows each sampled row of a class stands for."""
    chosen, totals = labelled.sample(docs, labels, id_col, text_col, label_col, rows_per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        # a few rows at a time: features are some times the size of the texts
        for b in (b.slice(i, SAMPLED_AT_ONCE) for b in batches for i in range(0, b.num_rows, SAMPLED_AT_ONCE)):
            at, value = [], []
            for t in b.column(1):
                found = [np.unique(p.astype(np.int64) + i * DIM, return_counts=True) for i, p in enumerate(hasher.parts(t.as_py()))]
                at.append(np.concatenate([f[0] for f in found]).astype("<i4").tobytes())
                value.append(np.concatenate([f[1] / max(1, f[1].sum()) for f in found]).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.binary()), pa.array(value, pa.binary())], names=["label", "at", "value"])

    # the sample's order has put each class into one task; they are dealt out again
    dealt = chosen.repartition(16, "t").select("label", "text")
    rows = sorted(dealt.mapInArrow(run, "label int, at binary, value binary").collect(), key=lambda r: (r["label"], len(r["at"]), bytes(r["at"])))
    sampled = Counter(r["label"] for r in rows)
    return rows, {c: n / sampled[c] for c, n in totals.items() if sampled[c]}


#: Rows whose features are worked on at a time.
CHUNK = 256


def chunks(rows: list) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets, values and numbers of features of runs of rows."""
    out = []
    for i in range(0, len(rows), CHUNK):
        at, value = ([np.frombuffer(r[c], dtype=kind) for r in rows[i : i + CHUNK]] for c, kind in (("at", "<i4"), ("value", "<f4")))
        out.append((np.concatenate(at), np.concatenate(value), np.array([len(a) for a in at])))
    return out


def logits(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], weights: np.ndarray, bias: float) -> np.ndarray:
    return bias + np.concatenate([np.add.reduceat(v * weights[a], np.cumsum(n) - n) for a, v, n in parts])


def fit(rows: list, stands: dict[int, float] | None = None, rounds: int = 150, rate: float = 1.0, decay: float = 1e-6) -> Model:
    """Adam over all rows with features at once, then Platt's calibration on every fifth of them. ``stands``: labelled
    rows that a row of each class stands for."""
    rows = [r for r in rows if len(r["at"])]
    weights, y_all = np.zeros(3 * DIM, dtype=np.float32), np.array([r["label"] for r in rows], dtype=float)
    if len(set(y_all)) < 2:
        share = float(np.clip(y_all.mean() if len(y_all) else 1.0, 1e-6, 1 - 1e-6))
        return Model(weights.reshape(3, DIM), 0.0, 0.0, float(np.log(share / (1 - share))))
    apart = np.arange(len(rows)) % 5 == 4
    parts, y = chunks([r for r, out in zip(rows, apart, strict=True) if not out]), y_all[~apart]
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    bias = 0.0
    m, s, mb, sb = np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0
    for k in range(1, rounds + 1):
        g = ((1 / (1 + np.exp(-np.clip(logits(parts, weights, bias), -50, 50))) - y) * balance).astype(np.float32)
        grad, row = decay * weights, 0
        for a, v, n in parts:
            grad += np.bincount(a, v * np.repeat(g[row : row + len(n)], n), minlength=len(weights)).astype(np.float32)
            row += len(n)
        gb = float(g.sum())
        m, s, mb, sb = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2, 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb**2
        weights -= (rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
        bias -= 0.1 * rate * (mb / (1 - 0.9**k)) / (np.sqrt(sb / (1 - 0.99**k)) + 1e-8)
    held = [r for r, out in zip(rows, apart, strict=True) if out]
    if not held:
        return Model(weights.reshape(3, DIM), bias, 1.0, 0.0)
    each = np.where(y_all == 1, *((stands or {}).get(c, 1.0) for c in (1, 0)))
    scale, shift = platt(logits(chunks(held), weights, bias), y_all[apart], each[apart])
    return Model(weights.reshape(3, DIM), bias, scale, shift)


def platt(z: np.ndarray, y: np.ndarray, each: np.ndarray | None = None, rounds: int = 100) -> tuple[float, float]:
    """scale and shift of the logit, by Newton steps, with Platt's smoothed targets; ``each``: the rows' weights."""
    each = np.ones(len(y)) if each is None else each / each.mean()
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (each * p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (each * (p - t)) + 1e-6 * (w - [1, 0]))
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    return fit(*labelled_features(docs, labels, id_col, text_col, label_col, rows_per_class))


SCORES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def scorer(model: Model, threshold: float = THRESHOLD) -> Callable[[Column], Column]:
    """Text to a struct of SCORES. An Arrow function of the text alone: no other column of a row passes through Python."""
    names, kinds = [x.split()[0] for x in SCORES.split(", ")], [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for texts in batches:
            rows = []
            for t in texts:
                text = t.as_py() or ""
                base = base_statistics(text)
                failed = base[0] < MIN_WORDS or 100 * base[4] > MOST_REPEATED * base[0]
                p = model.probability(hasher.parts(text))
                rows.append((*base, failed, p, not failed and p >= threshold))
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return F.arrow_udf(run, "struct<" + SCORES.replace(" ", ":").replace(",:", ",") + ">")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id_col and SCORES."""
    return docs.select(column(docs, id_col), scorer(model, threshold)(column(docs, text_col).cast("string")).alias("__s")).select(f"`{id_col}`", "__s.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass; columns as they were."""
    verdict = scorer(train(docs, labels, id_col, text_col, label_col), threshold)(column(docs, text_col).cast("string"))
    return docs.where(verdict["kept"])


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns and the probability."""
    return score(docs, train(docs, labels)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")
