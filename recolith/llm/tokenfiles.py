"""Token ids in binary files, in Simple-8b words.

Format. A file is a series of segments, each of whole documents. A segment is a header
(``HEADER``), document ids (int64) with a null flag (uint8) each, the number of ids of each document (uint64), the
first word of each block of ``BLOCK`` ids (uint32), the 64-bit words, and the escapes (uint64); all
little-endian, with a CRC-32 of what follows the header in it. A word's low 4 bits select how many ids of how many
bits its other 60 hold (``COUNTS``, ``WIDTHS``); the last selector is the escape, whose 60 bits are the place of an
id that needs more, among the escapes. Blocks begin with a word of their own, so that all
words of a segment are decoded at once, by selector, into places that follow from the block offsets.

Writing sorts documents by id, and those of one id by a hash of the text, over the cluster by ranges, encodes each range into one file, and lists the files
with their numbers of ids; the prefix sums over that list give every file its first id's place.

Defined cases: null and empty texts are documents of the end id alone; documents that share an id, or have none, stay apart, in
order of the hash of their texts and then of the texts, and their number may span ranges; a null id comes first; documents equal in both are
alike in the files too; a very long text is a segment of its own, held in memory once; an empty table gives no files and no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import column, fresh_path
from .tokencounts import CACHE, Pieces, batches_of, vocabulary

MAGIC = b"S8BT0001"
#: magic, documents, ids, blocks, words, escapes, crc32.
HEADER = "<8sQQQQQI"
BLOCK = 128
END_ID = 1
#: Simple-8b's selectors: ids in a word and bits of each; 0 is a run of zeros as long as a block, 15 the escape.
COUNTS = np.array([128, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 15
#: Ids in a segment, about; a longer document is a segment of its own.
SEGMENT = 1 << 19
FILES = "part int, path string, documents long, ids long"


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """uint64 ids to block offsets, words and escapes. Greedy: each word takes as many ids as fit; all blocks go on at once."""
    blocks = -(-len(ids) // BLOCK)
    table = np.zeros((blocks, BLOCK), dtype=np.uint64)
    table.ravel()[: len(ids)] = ids
    escaped = table >= np.uint64(1) << np.uint64(60)
    escapes = table[escaped]
    bits = np.frexp(table.astype(np.float64))[1].astype(np.int8)  # bit length; floats round up at most
    bits = np.where(table < np.uint64(1) << np.uint64(50), bits, 60).astype(np.int8)
    bits[escaped] = 61
    # the widest of the ids in [i, i + count), zeros behind the block; each count builds on the one below
    choice = np.full((blocks, BLOCK), ESCAPE, dtype=np.int8)
    widest, have = bits, 1
    for s in range(ESCAPE - 1, -1, -1):
        while have < COUNTS[s]:
            step = min(have, int(COUNTS[s]) - have)
            ahead = widest[:, step:].copy()
            np.maximum(widest[:, :-step], ahead, out=widest[:, :-step])
            have += step
        np.putmask(choice, widest <= WIDTHS[s], s)
    number = np.cumsum(escaped.ravel()) - 1
    value = np.where(escaped.ravel(), number, table.ravel().view(np.int64)).astype(np.uint64)
    at, row, order, place, words = np.zeros(blocks, dtype=np.int64), np.arange(blocks), [], [], []
    step = 0
    while len(row):
        sel = choice[row, at]
        word = sel.astype(np.uint64)
        for s in np.unique(sel):
            of = np.flatnonzero(sel == s)
            width, count = int(WIDTHS[s]), int(COUNTS[s])
            if width:
                ids_at = at[of][:, None] + np.arange(count)
                inside = ids_at < BLOCK
                got = np.where(inside, value[row[of][:, None] * BLOCK + np.minimum(ids_at, BLOCK - 1)], np.uint64(0))
                word[of] |= np.bitwise_or.reduce(got << (np.arange(count, dtype=np.uint64) * np.uint64(width) + np.uint64(4)), axis=1)
        order.append(row)
        place.append(np.full(len(row), step))
        words.append(word)
        at = at + COUNTS[sel]
        alive = at < np.minimum(BLOCK, len(ids) - row * BLOCK)
        at, row, step = at[alive], row[alive], step + 1
    if not blocks:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint64), escapes
    blocks_of, steps = np.concatenate(order), np.concatenate(place)
    sort = np.lexsort((steps, blocks_of))
    per_block = np.bincount(blocks_of, minlength=blocks)
    return (np.cumsum(per_block) - per_block).astype(np.uint32), np.concatenate(words)[sort], escapes


def decode(offsets: np.ndarray, words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n ids."""
    sel = (words & np.uint64(15)).astype(np.int64)
    counts = COUNTS[sel]
    before = np.cumsum(counts) - counts
    block = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets.astype(np.int64), len(words))))
    start = before - before[offsets.astype(np.int64)][block] + block * BLOCK if len(words) else before
    out = np.zeros((len(offsets) + 1) * BLOCK, dtype=np.uint64)
    payload = words >> np.uint64(4)
    for s in np.unique(sel):
        of = np.flatnonzero(sel == s)
        width, count = int(WIDTHS[s]), int(COUNTS[s])
        if not width:
            continue
        got = payload[of][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width)) & np.uint64((1 << width) - 1)
        if s == ESCAPE:
            got = escapes[got.astype(np.int64)]
        at = start[of][:, None] + np.arange(count)
        inside = at < (block[of] + 1)[:, None] * BLOCK
        out[at[inside]] = got[inside]
    return out[:n]


def segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    offsets, words, escapes = encode(ids)
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    parts = [known, nulls, np.array(lengths, dtype="<u8"), offsets.astype("<u4"), words.astype("<u8"), escapes.astype("<u8")]
    body = b"".join(p.tobytes() for p in parts)
    return struct.pack(HEADER, MAGIC, len(doc_ids), len(ids), len(offsets), len(words), len(escapes), zlib.crc32(body)) + body


def segments(stream: Any) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, numbers of ids and ids of each segment."""
    while head := stream.read(struct.calcsize(HEADER)):
        magic, docs, n, blocks, n_words, n_escapes, crc = struct.unpack(HEADER, head)
        sizes = [docs * 8, docs, docs * 8, blocks * 4, n_words * 8, n_escapes * 8]
        body = stream.read(sum(sizes))
        if magic != MAGIC or len(body) != sum(sizes) or zlib.crc32(body) != crc:
            raise ValueError("damaged token file")
        ends = list(accumulate(sizes))
        known, nulls, lengths, offsets, words, escapes = (np.frombuffer(body[e - s : e], dtype=t) for s, e, t in zip(sizes, ends, ("<i8", "u1", "<u8", "<u4", "<u8", "<u8"), strict=True))
        yield [None if null else int(d) for d, null in zip(known, nulls, strict=True)], lengths.astype(np.int64), decode(offsets, words, escapes, n)


def write(docs: DataFrame, folder: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, cache: int = CACHE) -> list:
    """Writes the files and returns their list in ascending order of document ids: FILES' columns. ``cache``: most pre-tokens that a worker keeps; the ids are the same."""
    path = path or vocabulary()
    folder = files.qualify(docs.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pieces = Pieces.of_worker(path, "ids", lambda ids: array("I", ids).tobytes(), cache)
        end = np.array([end_id], dtype="<u4").tobytes()
        part, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.s8b"
        out, total_docs, total = None, 0, 0
        ids: list[int | None] = []
        tokens: list[bytes] = []
        held = 0

        def flush() -> None:
            nonlocal out, ids, tokens, held, total_docs, total
            if ids:
                out = out or files.open_new(folder, f"{part:06d}-{name}")
                flat = np.frombuffer(b"".join(tokens), dtype="<u4").astype(np.uint64)
                out.write(segment(ids, [len(t) // 4 for t in tokens], flat))
                total_docs, total = total_docs + len(ids), total + len(flat)
                ids, tokens, held = [], [], 0

        for b in batches:
            known_ids = iter(b.column(0).to_pylist())
            for texts in batches_of(b.column(1)):
                for values in pieces.of_texts(texts):
                    found = b"".join(values) + end
                    ids.append(next(known_ids))
                    tokens.append(found)
                    held += len(found) // 4
                    if held >= SEGMENT:
                        flush()
        flush()
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/{part:06d}-{name}"], "documents": [total_docs], "ids": [total]})

    rows = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_first(), F.col("h").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("text").asc_nulls_first()).select("id", "text")
    return sorted(ordered.mapInArrow(run, FILES).collect())  # a row a file


def read(spark: SparkSession, listed: list, value: Any, schema: str) -> DataFrame:
    """Documents of listed files: doc_id long, start long, n_tokens long and what ``value`` makes of the ids (``schema``)."""
    starts = [0, *accumulate(r["ids"] for r in listed)]
    table = files.as_table(spark, [(r["path"], s) for r, s in zip(listed, starts, strict=False)], "path string, start long")
    kind = schema.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with files.open_old(path) as stream:
                    for doc_ids, lengths, ids in segments(stream):
                        ends = np.cumsum(lengths)
                        made = [value(ids[e - n : e]) for n, e in zip(lengths, ends, strict=True)]
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends - lengths), "n_tokens": pa.array(lengths), kind[0]: pa.array(made)})
                        start += int(lengths.sum())

    return table.mapInArrow(run, f"doc_id long, start long, n_tokens long, {schema}")


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def digest(docs: DataFrame, cache: int = CACHE) -> DataFrame:
    """The contract's columns, from the files read back."""
    spark = docs.sparkSession
    return read(spark, write(docs, fresh_path(spark, "token-files"), cache=cache), crc32_of, "ids_crc32 long")
