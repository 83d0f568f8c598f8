"""Token counts from distinct pre-tokens: pieces are counted once for each, and documents sum them.

A pre-token here is a run of text between blanks (20, 09-0D), in ASCII lower case, with the ASCII signs
at its end apart: places where the tokenizer splits whatever stands around,
so that the counts of a text's pre-tokens add up to the text's. (Its normaliser is NFC, blanks and lower case; NFC
does not reach across a blank or a sign.) Texts that hold a special string's opening are given to the library whole. Pre-tokens of lower-case letters alone go to the library's model directly, after a
check on the tokenizer at hand that this gives the same ids. All this holds for one normaliser and one splitter (``NORMALIZER``, ``SPLITTER``);
under a tokenizer file with others, every text is given to the library whole, and so is every text under a sentencepiece model.

Each task joins in Arrow batches: the distinct pre-tokens of the batch that its worker has not met go to the library
together, their piece counts into a dictionary of at most ``CACHE`` entries, and each document sums the dictionary
over its pre-tokens. No ids are kept and nothing is shuffled; a join of all documents' pre-token frequencies with one global
dictionary gives the same and moves more bytes than the texts have.

Defined cases: null and empty texts have no bytes and no tokens; repeated rows and null ids are counted
row by row; very long texts are taken whole; there are no ties; an empty table gives none. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import LOWER, UPPER, column

#: Most pre-tokens that a worker keeps, some 200 bytes each; those met later are counted again in each batch.
CACHE = 1_000_000
LIMIT = 2048
SPECIAL = b"<|"
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
# ASCII signs, and Latin-1 letters in UTF-8.
_SIGN, _LATIN = rb"!-/:-@\[-`{-~", rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
#: A run of signs up to a blank or the end, unless a byte beyond ASCII stands before it that is no Latin-1 letter's.
_MARK = re.compile(rb"[" + _SIGN + rb"](?:(?<![\x80-\xff" + _SIGN + rb"].)|(?<=" + _LATIN + rb".))[" + _SIGN + rb"]*(?=[\x20\x09-\x0D]|$)")

#: One run of lower-case letters of ASCII and Latin-1: a single pre-token that no normaliser changes.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# The normaliser and the splitter, as the library writes them, for which texts fall into the pre-tokens above.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Byte-level alphabet: bytes that print stand for themselves, the others, in order, for characters from 256 on.
_BYTES = {b: 256 + i for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
_PROBES = "a there disestablishment été größe ñandú straße ÿ".split()


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_tokens(text: str) -> list[bytes] | None:
    """None where the text must be taken whole."""
    data = text.encode()
    return None if SPECIAL in data else _MARK.sub(rb" \g<0>", data.translate(_LOWERED)).split()


class SentencePiece:
    """A sentencepiece model under the names that ``Pieces`` uses."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str) -> list[int]:
        return self.processor.encode(text, out_type=int)


class Pieces:
    """Values of pre-tokens under a tokenizer file; ``value`` makes one of an encoding's ids."""

    def __init__(self, path: str, value: Any, most: int = CACHE) -> None:
        self.value, self.most = value, most
        self.known: dict[bytes, Any] = {}
        if path.endswith(".model"):
            self.by_words, self.ids = False, SentencePiece(path).ids
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel unit
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        said = json.loads(self.tokenizer.to_str())
        special = [t["content"] for t in said["added_tokens"]]
        self.by_words = said["normalizer"] == NORMALIZER and said["pre_tokenizer"] == SPLITTER and all(SPECIAL.decode() in s for s in special)
        self.model = self.tokenizer.model
        self.direct = self.by_words and all(self.ids_of(w.encode()) == self.ids(w) for w in _PROBES)

    def ids_of(self, word: bytes) -> list[int]:
        """Of a single pre-token: from the library's model, without its normaliser and splitter."""
        text = word.decode("latin-1")
        return [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(_BYTES))]

    def made(self, words: list[bytes]) -> dict[bytes, Any]:
        """Values of pre-tokens that aren't known yet."""
        out = {w: self.value(self.ids_of(w)) for w in words if self.direct and _LETTERS.fullmatch(w)}
        rest = [w for w in words if w not in out]
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        return out | dict(zip(rest, (self.value(e.ids) for e in encoded), strict=True))

    @classmethod
    def of_worker(cls, path: str, name: str, value: Any, most: int = CACHE) -> Pieces:
        """The Python worker's own, under the path, ``name`` of the value and bound: tasks that follow each other share it."""
        kept = sys.modules.setdefault("_recolith_worker", types.ModuleType("_recolith_worker")).__dict__
        key = f"{name}:{most}:{path}"
        if key not in kept:
            kept[key] = cls(path, value, most)
        return kept[key]

    def whole(self, text: str) -> Any:
        return self.value(self.ids(text))

    def of_texts(self, texts: list[str]) -> Iterator[list]:
        """The values of each text's pre-tokens, in order."""
        parts = [pre_tokens(t) if self.by_words else None for t in texts]
        words = list(chain.from_iterable(p for p in parts if p))
        found = list(map(self.known.get, words))
        missing = [i for i, v in enumerate(found) if v is None]
        if missing:
            made = self.made(list({words[i] for i in missing}))
            for i in missing:
                found[i] = made[words[i]]
            if len(self.known) + len(made) <= self.most:
                self.known |= made
        at = 0
        for t, p in zip(texts, parts, strict=True):
            if p is None:
                yield [self.whole(t)]
            else:
                yield found[at : at + len(p)]
                at += len(p)


def batches_of(texts: pa.Array, size: int = 256) -> Iterator[list[str]]:
    """Texts in small runs, so that a task holds the words of a few at a time."""
    for at in range(0, len(texts), size):
        yield [t or "" for t in texts[at : at + size].to_pylist()]


def counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes and n_tokens."""
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of_worker(path, "counts", len)
        for b in batches:
            n_bytes, n_tokens = [], []
            for texts in batches_of(b.column(1)):
                n_tokens += map(sum, pieces.of_texts(texts))
                n_bytes += [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    rows = docs.select(column(docs, id_col), column(docs, text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, StructType([rows.schema[0], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return counts(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)
