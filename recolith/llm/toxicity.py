"""Toxicity by compression distance: how much shorter do windows of a text become when
zstandard may also use a dictionary of toxic text?

Two dictionaries are trained on labelled rows by zstandard's own trainer: one on all windows of ordinary texts, one on the
stretches of toxic texts whose byte 5-grams are over-represented there (likelihood ratio). Both
compressors hold the ordinary one at the same distance; the toxic one alone follows it in one of them, and
zeros of the same length in the other, so that ordinary text compresses alike in both and the
difference of two lengths is what the toxic text explains. A document's windows of ``WINDOW``
words give a histogram of differences; a logistic regression over it, fitted to the labelled rows with
each label weighted by all its rows, gives the calibrated score, with the threshold at 0.5. Lengths come from zstandard's buffer API, a document a call.
A window counts with at most ``STEPS`` bytes saved: more tell no more.

A departure: the toxic dictionary is not trained on whole toxic windows, as most of what these repeat is as ordinary as the text around it. Where no
5-gram stands out whole windows are used. README has the figures of both ways.

Training sees a bounded sample of labelled rows (``labelled.sample``; ``rows_per_class``); near
copies among them, known by a run of five words at the same quarter, count once for the dictionaries. The driver holds
that sample alone. Scoring is one pass over Arrow batches without a shuffle.

Defined cases: null and empty texts score like any text without toxic windows; rows whose label
is null are not learnt from; without labels of both kinds the score is the share of label 1, 0 if
there are none; repeated rows and null ids (held out if crc32 of the empty text says so: it does) are
scored row by row; a score of exactly 0.5 is toxic; very long texts are taken whole, and windows of very long words are cut into
overlapping pieces of ``MOST`` bytes, so that all of them are within reach of the dictionaries; an empty table gives none. Other columns are never looked at,
whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import labelled
from .common import LOWER, UPPER, column

WINDOW = 8
FOLDS = 5
ROWS_PER_CLASS = 4000
ORDINARY_BYTES, TOXIC_BYTES = 8192, 1024
GRAM, MIN_DOCS, MIN_RATIO, MIN_GAIN = 5, 4, 3.0, 20.0
STEPS, FRONT = 8, 48
#: Most bytes of a window and of the overlap of its pieces.
MOST, OVERLAP = 4096, 32
FEATURES = 2 + 2 * (STEPS + 1) + 2 * STEPS + 1
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWERED).split()


def windows(words: list[bytes], size: int = WINDOW, front: bytes = b"") -> list[bytes]:
    out = []
    for i in range(0, len(words), size):
        window = b" " + b" ".join(words[i : i + size]) + b" "
        out += [front + window] if len(window) <= MOST else [front + window[j : j + MOST] for j in range(0, len(window) - OVERLAP, MOST - OVERLAP)]
    return out


@dataclass
class Model:
    """Dictionary contents, and weights of the standardised features; compressors are made where it is used."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    sd: np.ndarray
    weights: np.ndarray
    _compressors: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compressors": []}

    def compressors(self) -> list:
        import zstandard

        if not self._compressors:
            for tail in (bytes(len(self.toxic)), self.toxic):
                content = zstandard.ZstdCompressionDict(self.ordinary + tail, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                how = zstandard.ZstdCompressionParameters.from_level(6, window_log=16, hash_log=13, chain_log=13, min_match=5, write_checksum=False, write_content_size=False, write_dict_id=False)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=content, compression_params=how))
        return self._compressors

    def features(self, text: str | None) -> np.ndarray:
        """Of the bytes that windows save, at most ``STEPS``: the most and the second most, as numbers and as flags; how
        many windows save each number, as logs and as shares; and the log of the number of windows."""
        # with a stretch of the dictionary in front no window is stored raw, so that each byte saved shows
        parts = windows(words_of(text), front=self.ordinary[-200 : FRONT - 200])
        if not parts or not self.toxic:
            return np.zeros(FEATURES)
        plain, toxic = (np.fromiter(map(len, c.multi_compress_to_buffer(parts, threads=0)), dtype=np.int64, count=len(parts)) for c in self.compressors())
        saved = np.clip(plain - toxic, 0, STEPS)
        counts = np.bincount(saved, minlength=STEPS + 1)[1:]
        top = np.sort(np.concatenate([saved, [0]]))[-2:]
        flags = np.zeros((2, STEPS + 1))
        flags[[0, 1], top] = 1
        return np.concatenate([top, flags.ravel(), np.log1p(counts), counts / len(parts), [np.log1p(len(parts))]])

    def score(self, features: np.ndarray) -> float:
        z = self.weights[0] + self.weights[1:] @ ((features - self.mean) / self.sd)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def distinct(texts: list[str]) -> list[list[bytes]]:
    """Words of the texts, without those that share a run of five words at a quarter of their length with one before."""
    seen: set[tuple] = set()
    out = []
    for t in texts:
        w = words_of(t)
        keys = {(i, *w[i * len(w) // 4 : i * len(w) // 4 + 5]) for i in range(4)}
        if w and not keys & seen:
            seen |= keys
            out.append(w)
    return out


def grams_of(words: list[bytes]) -> set[bytes]:
    return {p[i : i + GRAM] for w in set(words) for p in [b" " + w + b" "] for i in range(len(p) - GRAM + 1)}


def characteristic(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """5-grams in a share of toxic texts that is well above that of ordinary ones, by ratio and by likelihood ratio."""
    ft, fo = (Counter(g for w in texts for g in grams_of(w)) for texts in (toxic, ordinary))
    nt, no = len(toxic), len(ordinary)

    def gain(a: int, b: int) -> float:
        both = (a + b) / (nt + no)
        part = lambda k, n, p: (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)
        return 2 * (part(a, nt, a / nt) + part(b, no, b / no) - part(a, nt, both) - part(b, no, both))

    return {g for g, k in ft.items() if k >= MIN_DOCS and k / nt > MIN_RATIO * (fo[g] + 0.5) / no and gain(k, fo[g]) > MIN_GAIN}


def stretches(word: bytes, marked: set[bytes]) -> list[bytes]:
    """The parts of a word that marked 5-grams cover, with one byte around."""
    p = b" " + word + b" "
    hit = [p[i : i + GRAM] in marked for i in range(len(p) - GRAM + 1)]
    out, i = [], 0
    while i < len(hit):
        j = i
        while j < len(hit) and hit[j]:
            j += 1
        if j > i:
            out.append(p[max(0, i - 1) : j + GRAM])
        i = j + 1
    return out


def dictionary(samples: list[bytes], size: int) -> bytes:
    """zstandard's dictionary of the samples; the samples themselves where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(x for x, _ in Counter(samples).most_common(size // 8))[:size]


def fit(rows: list[tuple[str, int]], totals: dict[int, int] | None = None) -> Model:
    """``rows``: texts and labels 0 or 1. ``totals``: rows of each label that they stand for, so that
    scores are probabilities among all of these."""
    none = np.zeros(FEATURES)
    y = np.array([r[1] for r in rows], dtype=float)
    stands = {c: (totals or {}).get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)} if totals else {0: 1.0, 1: 1.0}
    each = np.where(y == 1, stands[1], stands[0])
    each = each / max(each.mean(), 1e-9) if len(y) else each
    toxic, ordinary = (distinct([t for t, label in rows if label == c]) for c in (1, 0))
    if not toxic or not ordinary:
        share = min(max(y.mean() if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return Model(b"", b"", none, none + 1, np.concatenate([[math.log(share / (1 - share))], none]))
    marked = characteristic(toxic, ordinary)
    samples = [s for w in toxic for x in w for s in stretches(x, marked)] or [x for w in toxic for x in windows(w)]
    model = Model(dictionary([x for w in ordinary for x in windows(w)], ORDINARY_BYTES), dictionary(samples, TOXIC_BYTES), none, none + 1, np.concatenate([[0.0], none]))
    x = np.array([model.features(t) for t, _ in rows])
    model.mean, model.sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.hstack([np.ones((len(x), 1)), (x - model.mean) / model.sd])
    w = np.zeros(x.shape[1])
    for _ in range(100):  # Newton, slightly damped
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (each * p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), x.T @ (each * (p - y)) + 1e-2 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w
    return model


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """From labelled rows that are not held out, at most ``rows_per_class`` of each label."""
    chosen, totals = labelled.sample(docs, labels, id_col, text_col, label_col, rows_per_class, among=lambda i: ~held_out(i))
    rows = sorted(chosen.collect(), key=lambda r: (r["h"], r["t"], r["label"]))
    return fit([(r["text"], r["label"]) for r in rows], totals)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.score(model.features(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], names=[id_col, "score"])

    rows = docs.select(column(docs, id_col), column(docs, text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, StructType([rows.schema[0], StructField("score", DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
