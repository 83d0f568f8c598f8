"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams
against the token windows of training documents.

Plan. Benchmark windows (a few words each) are hashed into a table that is broadcast
after its rows and bytes are checked. Documents are split into words once and exploded inside
one codegen stage. A window can only match where its longest word stands, so a
position goes on only if its word is the longest word of some benchmark window
(a second broadcast table); for those the window's hash is looked up in the hash
set and the words compared. What is left, hits alone, is aggregated by row;
texts are never shuffled.

A benchmark that is too large to broadcast is met by a shuffled join on the hashes. A Bloom filter of all its
hashes (``BLOOM_BITS`` a window, 16 MB at most) goes into the scan as a constant, so that of the documents' windows only those that
are likely there are shuffled with their words; where even the longest words are too many to broadcast, every window is tried against the filter.

Defined cases: the unit is the row, whatever its id: each row is judged on its own words and comes out once, rows
that repeat an id or have none too (rows equal in id and text are worked on once and counted). Null and empty texts have no words and are never contaminated;
repeated benchmark rows count once; benchmark items without words and null item ids add no windows; an empty benchmark marks nothing; an empty
table gives no rows. There are no ties. A very long text is one row of its words in memory, some times its
size; its positions stream from there. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, BROADCAST_ROWS, ascii_lower, column, in_order, materialise, private, small_side

#: Words are runs of anything but the ASCII characters that are no digit or lower-case letter.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for text that is not lower-cased yet.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Bits a window in the Bloom filter of a large benchmark, of which two are set, and the most bits in all, as a power of two.
BLOOM_BITS, BLOOM_MOST = 8, 27


def words(text: Column) -> Column:
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def text_key(text: Column) -> Column:
    """Stands for the text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def benchmark_windows(bench: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows: win, k (words in it), hash, items, anchor (longest word) and off (its place).

    An item of fewer than ``window`` words is one window. One more row, of no words, matches the
    mark that ``hits`` puts in front of each document.
    """
    items = (
        bench.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
        .where("item IS NOT NULL AND size(w) > 0")
        .withColumn("k", F.least(F.size("w"), F.lit(window)))
    )
    wins = (
        items.select("item", "w", "k", F.explode(F.expr("sequence(1, size(w) - k + 1)")).alias("s"))
        .select("item", F.expr("slice(w, s, k)").alias("win"))
        .groupBy("win")
        .agg(F.collect_set("item").alias("items"))
    )
    longest = F.array_max(F.transform("win", lambda x, i: F.struct(F.length(x).alias("n"), x.alias("word"), i.alias("off"))))
    wins = wins.withColumn("longest", longest).select("win", F.size("win").alias("k"), "items", F.col("longest.word").alias("anchor"), F.col("longest.off").alias("off"))
    mark = bench.sparkSession.range(1).selectExpr("array() :: array<string> AS win", "0 AS k", "array() :: array<string> AS items", "'' AS anchor", "0 AS off")
    return wins.unionByName(mark).withColumn("hash", F.xxhash64("win"))


def hits(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES, repeat: bool = True) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, spans (array of start word and length, from 1) and items.

    Rows are grouped by id and text: the same words have the same hits, and the group comes out as often as it is there,
    or once if not ``repeat``.
    """
    windows = materialise(windows, "bench-windows")
    rows = docs.select(F.struct(column(docs, id_col).alias("id"), text_key(column(docs, text_col)).alias("text")).alias("__id"), words(column(docs, text_col)).alias("w"))
    table = windows.select("hash", F.col("win").alias("bench_win"), "items")
    total = windows.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.array_join("win", " ")) + F.octet_length(F.array_join("items", " "))).alias("bytes")).first()
    few = total["n"] <= broadcast_rows and (total["bytes"] or 0) <= broadcast_bytes
    anchors = materialise(windows.groupBy("anchor").agg(F.collect_set(F.struct("off", "k")).alias("offs")), "bench-anchors")
    started = _at_anchors(rows, anchors) if few or anchors.count() <= broadcast_rows else _everywhere(rows, windows)
    looked = (
        started.where("k = 0 OR (start >= 1 AND start + k - 1 <= size(w))")
        .select("__id", F.size("w").alias("n"), "start", "k", F.expr("slice(w, greatest(start, 1), k)").alias("win"))
        .withColumn("hash", F.xxhash64("win"))
    )
    if not few:
        # documents' own marks are counted apart: as a key of the shuffled join they would be one
        marks = rows.select("__id", F.size("w").alias("n"), F.lit(0).alias("start"), F.lit(0).alias("k"), F.array().cast("array<string>").alias("items"))
        likely = looked.where((F.col("k") > 0) & _likely(F.col("hash"), windows, total["n"]))
        found = likely.join(table, "hash").where("win = bench_win").drop("hash", "win", "bench_win").unionByName(marks)
    else:
        found = looked.join(F.broadcast(table), "hash").where("win = bench_win")
    found = found.groupBy("__id").agg(
        F.max("n").cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("k") > 0, F.struct("start", "k"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        F.count_if(F.col("k") == 0).cast("int").alias("__rows"),  # each row has one mark
    )
    times = F.array_repeat(F.lit(0), F.col("__rows")) if repeat else F.array(F.lit(0))
    return found.select(F.col("__id.id").alias(id_col), "n_words", "spans", "items", F.explode(times).alias("__each")).drop("__each")


def _likely(hash_: Column, windows: DataFrame, n: int) -> Column:
    """Whether a hash may be one of the windows', by a Bloom filter of two bits each. It is a table of 64-bit words that a
    scalar subquery puts into the plan as one array."""
    power = min(BLOOM_MOST, max(6, (BLOOM_BITS * n).bit_length()))
    places = lambda h: [h.bitwiseAND(F.lit((1 << power) - 1)), F.shiftrightunsigned(h, power).bitwiseAND(F.lit((1 << power) - 1))]
    word = lambda p: F.shiftright(p, 6).cast("int")
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
    set_ = windows.where("k > 0").select(F.explode(F.array(*places(F.col("hash")))).alias("p")).groupBy(word(F.col("p")).alias("at")).agg(F.bit_or(bit(F.col("p"))).alias("bits"))
    every = windows.sparkSession.range(1 << (power - 6)).select(F.col("id").cast("int").alias("at")).join(set_, "at", "left")
    filter_ = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))), lambda x: x["bits"]).alias("f"))
    filter_ = materialise(filter_, "bench-filter").scalar()
    a, b = places(hash_)
    has = lambda p: F.get(filter_, word(p)).bitwiseAND(bit(p)) != 0
    return has(a) & has(b)


def _at_anchors(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """__id, w, start, k: windows to look up, from the places of anchors, which are broadcast."""
    return (
        # the empty word in front is an anchor of its own, so that documents without hits stay too
        rows.select("__id", "w", F.posexplode(F.concat(F.array(F.lit("")), F.col("w"))).alias("p", "word"))
        .join(F.broadcast(anchors), F.col("word") == F.col("anchor"))
        .select("__id", "w", "p", F.explode("offs").alias("o"))
        .select("__id", "w", (F.col("p") - F.col("o.off")).alias("start"), F.col("o.k").alias("k"))
    )


def _everywhere(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """The same for more anchors than may be broadcast: every window of each length that the benchmark has."""
    ks = F.array(*[F.lit(r["k"]) for r in windows.select("k").distinct().collect()])  # lengths, 13 at most and the mark
    starts = F.when(F.col("k") == 0, F.array(F.lit(0))).when(F.size("w") >= F.col("k"), F.sequence(F.lit(1), F.size("w") - F.col("k") + 1))
    return rows.select("__id", "w", F.explode(ks).alias("k")).select("__id", "w", "k", F.explode(starts).alias("start"))


def judge(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, one_in: int = 20, repeat: bool = True) -> DataFrame:
    """``hits`` with hit_words (the places that windows cover) and contaminated: some word is hit,
    and at least one word in ``one_in``."""
    found = hits(docs, benchmark_windows(bench, item_col, text_col, window), id_col, text_col, repeat=repeat)
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["k"] - 1))))
    found = found.withColumn("hit_words", covered)
    n_hit = F.size("hit_words")
    return found.withColumn("contaminated", (n_hit > 0) & (F.lit(one_in) * n_hit >= F.col("n_words")))


def judge_texts(docs: DataFrame, bench: DataFrame, text_col: str, **how) -> DataFrame:
    """``judge`` of each distinct text, under its ``text_key`` __key: the verdict on a row depends on its text alone."""
    text = column(docs, text_col)
    return judge(docs.select(text_key(text).alias("__key"), text.alias(text_col)), bench, "__key", text_col, repeat=False, **how)


def drop_documents(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged on its own words; columns as they were."""
    bad = materialise(judge_texts(docs, bench, text_col, **how).where("contaminated").select(F.col("__key").alias(private(docs, "__bad"))), "contaminated")
    return docs.join(small_side(bad), text_key(column(docs, text_col)) == bad[bad.columns[0]], "left_anti")


def drop_spans(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every hit word, and what stands between it and the word before, cut from the text.

    Each row is judged on its own words; texts without hits are unchanged.
    """
    spans = judge_texts(docs, bench, text_col, **how).where("size(hit_words) > 0").select(F.col("__key").alias("__bad"), F.array_sort("hit_words").alias("__hit"))
    spans, whole = materialise(spans, "hit-spans"), column(docs, text_col)
    gap = RAW_WORD.replace("[^", "[")[:-1] + "*"
    pieces = F.regexp_extract_all(whole, F.lit(f"{gap}{RAW_WORD}"), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~in_order(spans["__hit"], i + 1))
    rest = F.regexp_extract(whole, f"{gap}$", 0)
    joined = docs.join(small_side(spans, 20_000), text_key(whole) == spans["__bad"], "left")
    text = F.when(spans["__hit"].isNull(), whole).otherwise(F.concat(F.array_join(kept, ""), rest))
    return joined.select(*[text.alias(c) if c == text_col else column(docs, c) for c in docs.columns])


def digest(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The contract's columns."""
    ids = F.array_join(F.array_sort("items"), ",")
    return judge(docs, bench).select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0 AND item_id IS NOT NULL)
), dw AS (
  SELECT r, s, k, array_to_string(w[s : s + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
), h AS (
  SELECT r, s, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k
), n AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM h) GROUP BY r
), i AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item_id :: VARCHAR AS item FROM h) GROUP BY r
)
SELECT d.doc_id, len(d.w) :: BIGINT AS n_words, coalesce(n_hit, 0) :: BIGINT AS n_hit, coalesce(n_items, 0) :: BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)
"""
