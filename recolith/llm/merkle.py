"""Merkle manifest of a dataset: leaves of rows, a tree a group, one root, and proofs.

A leaf is the SHA-256 of a row's columns, each written as its length and value. Leaves of a group stand in order of id; every ``fanout`` consecutive nodes
become the hash of their concatenation until one is left, the group's subroot; the subroots, in order of their groups, become the root in the same way.

Plan. Texts are hashed where they are read, and only digests move. Places are found over ranges (``places``), so a group of any share of the rows is no one task's. Every ``BLOCK``
(a power of the fanout) consecutive nodes are one row with an ordered array, whose levels higher-order functions collapse; the block's root goes into the next table,
and so on until every group has one node: three or four tables in all, each a thousandth of the one before. Siblings are read off the arrays' levels, from the top table
down, so a leaf's way to the root is its own steps and those of its block's root.

Defined cases: a null column is written ``-``; a null group is a group of its own and comes first; null ids come first in their group, and rows of one id go by their
digests; repeated rows are leaves each, and of equal ones any comes first; a very long text is hashed in place; a lone leaf is its group's subroot, a lone subroot the root; an
empty table has no rows and the root None. Columns not named play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialise, small_side
from ..operators.places import placed

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Nodes of a block; some 100 KB with their digests.
BLOCK = 1024
STEP = "struct<before:string,after:string>"


def written(value: Column) -> Column:
    """``-`` for null, else bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", changed: dict[str, Column] | None = None) -> DataFrame:
    """id, group, leaf and tampered: the leaf with the columns ``changed`` in place of the rows' own, null where it is the same."""
    own = sha(F.concat(*[written(column(docs, c)) for c in columns]))
    other = sha(F.concat(*[written((changed or {}).get(c, column(docs, c))) for c in columns]))
    differs = [~column(docs, c).eqNullSafe(v) for c, v in (changed or {}).items()]
    where = F.lit(False)
    for d in differs:
        where = where | d
    return docs.select(column(docs, id_col).alias("id"), column(docs, group_col).cast("string").alias("group"), own.alias("leaf"), F.when(where, other).alias("tampered"))


def parents(nodes: Column, fanout: int) -> Column:
    """The level above: each run's hash. ``nodes`` has one at least."""
    runs = F.sequence(F.lit(1), F.size(nodes), F.lit(fanout))
    return F.transform(runs, lambda at: sha(F.array_join(F.slice(nodes, at, F.lit(fanout)), "")))


def height(n: Column, fanout: int) -> Column:
    """Levels above ``n`` nodes until one is left."""
    powers = [fanout**k for k in range(64) if fanout**k < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < n))


def collapsed(rows: DataFrame, fanout: int, block: int) -> DataFrame:
    """Blocks of ``rows`` (key, at, n, node, rest): key, block, n, rests (in order), levels (from the nodes to the block's root)."""
    most = next(k for k in range(1, 64) if fanout**k == block)
    grouped = rows.groupBy("key", (F.col("at") / block).cast("long").alias("block")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "node", "rest"))).alias("each"))
    steps = F.when(F.col("n") <= block, height(F.col("n"), fanout)).otherwise(most)
    ups = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    nodes = F.transform("each", lambda x: x["node"])
    levels = F.aggregate(ups, F.array(nodes), lambda found, _: F.concat(found, F.array(parents(F.element_at(found, -1), fanout))))
    return grouped.select("key", "block", "n", F.transform("each", lambda x: x["rest"]).alias("rests"), levels.alias("levels"))


def steps(levels: Column, place: Column, fanout: int) -> Column:
    """The siblings of the node at ``place`` (from 0) of the lowest level, at each level but the last: an array of STEP."""

    def at(level: Column, k: Column) -> Column:
        index = F.floor(place / F.pow(F.lit(fanout), k)).cast("int")
        first = (index - F.pmod(index, F.lit(fanout))).cast("int")
        before = F.array_join(F.slice(level, first + 1, index - first), "")
        after = F.array_join(F.slice(level, index + 2, first + F.lit(fanout - 1) - index), "")
        return F.struct(before.alias("before"), after.alias("after"))

    below = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.transform(below, at)


@dataclass
class Tree:
    """``blocks`` of leaves with ``path``, the steps from the block's root to ``root``; ``subroots``: key, subroot."""

    blocks: DataFrame
    subroots: DataFrame
    root: str | None
    fanout: int


def key_of(group: Column) -> Column:
    """Groups as keys that are never null and sort as groups do, null first."""
    return F.struct(group.isNotNull().alias("known"), F.coalesce(group, F.lit("")).alias("name"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (written, with key and node, in order of ``order``) with at, the place in the key, and n, its rows."""
    at = placed(rows, [F.col("key").asc(), F.col("order").asc_nulls_first(), F.col("node").asc()], name)
    sizes = materialise(at.groupBy("key").agg(F.min("__at").alias("__first"), F.count("*").alias("n")), f"{name}-sizes")
    return at.join(small_side(sizes), "key").withColumn("at", F.col("__at") - F.col("__first")).drop("__at", "__first")


def climbed(rows: DataFrame, fanout: int, block: int) -> list[DataFrame]:
    """Tables of blocks, each of the block roots of the one before, until every key has one."""
    tables = []
    while True:
        tables.append(materialise(collapsed(rows, fanout, block), "merkle-blocks"))
        if tables[-1].where(F.col("n") > block).isEmpty():
            return tables
        n = F.ceil(F.col("n") / block).cast("long")
        rows = tables[-1].select("key", F.col("block").alias("at"), n.alias("n"), F.element_at(F.element_at("levels", -1), 1).alias("node"), F.lit(None).cast("string").alias("rest"))


def with_paths(tables: list[DataFrame], top: DataFrame | None, fanout: int, block: int) -> DataFrame:
    """The lowest table with path; ``top``: key and path of each key's last node, None where it is the root."""
    above = top.select("key", F.lit(0).cast("long").alias("block"), "path") if top else None
    for i, table in reversed(list(enumerate(tables))):
        found = table.join(small_side(above), ["key", "block"]).select(*table.columns, "path") if above else table.withColumn("path", F.array().cast(f"array<{STEP}>"))
        if not i:
            return found
        each = found.select("key", "block", "levels", "path", F.explode(F.sequence(F.lit(0), F.size(F.element_at("levels", 1)) - 1)).alias("place"))
        above = materialise(each.select("key", (F.col("block") * block + F.col("place")).cast("long").alias("block"), F.concat(steps(F.col("levels"), F.col("place"), fanout), F.col("path")).alias("path")), "merkle-paths")
    raise ValueError("no tables")


def build(rows: DataFrame, fanout: int = FANOUT, block: int = BLOCK) -> Tree:
    """The tree over ``rows`` as ``leaves`` gives them."""
    rest = F.struct("id", "tampered")
    first = materialise(rows.select(key_of(F.col("group")).alias("key"), F.col("id").alias("order"), F.col("leaf").alias("node"), rest.alias("rest")), "leaves")
    tables = climbed(numbered(first, "leaves-in-order"), fanout, block)
    subroots = materialise(tables[-1].select("key", F.element_at(F.element_at("levels", -1), 1).alias("subroot")), "subroots")
    # the groups' own tree has one key, and the groups' keys are its order
    tops = subroots.select(F.lit(0).alias("key"), F.col("key").alias("order"), F.col("subroot").alias("node"), F.col("key").alias("rest"))
    upper = climbed(numbered(materialise(tops, "tops"), "tops-in-order"), fanout, block)
    placed_tops = with_paths(upper, None, fanout, block).select("levels", "path", F.posexplode("rests").alias("place", "key"))
    paths = materialise(placed_tops.select("key", F.concat(steps(F.col("levels"), F.col("place"), fanout), F.col("path")).alias("path")), "subroot-paths")
    last = upper[-1].select(F.element_at(F.element_at("levels", -1), 1).alias("root")).first()  # one row, or none
    return Tree(with_paths(tables, paths, fanout, block), subroots, last["root"] if last else None, fanout)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, leaf, lambda node, s: sha(F.concat(s["before"], node, s["after"])))


def proofs(tree: Tree) -> DataFrame:
    """id, group, leaf, tampered, subroot, root and path (the steps from the leaf to the root) of each row."""
    each = tree.blocks.select("key", "levels", "path", F.posexplode("rests").alias("place", "rest"))
    path = F.concat(steps(F.col("levels"), F.col("place"), tree.fanout), F.col("path"))
    rows = each.select("key", "rest.*", F.get(F.element_at("levels", 1), F.col("place")).alias("leaf"), path.alias("path"))
    group = F.when(F.col("key.known"), F.col("key.name"))
    return rows.join(small_side(tree.subroots), "key").select("id", group.alias("group"), "leaf", "tampered", "subroot", F.lit(tree.root).cast("string").alias("root"), "path")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns. Tampering adds 1 to n_chars where 7 divides the CRC-32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = proofs(build(leaves(docs, changed={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    out = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", sha(siblings).alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n :: UBIGINT, list_transform(range(8), lambda x: x :: UBIGINT)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384 :: UBIGINT, c >> 1) ELSE c >> 1 END)) AS tbl
), d AS (
  SELECT *, coalesce((xor(4294967295 :: UBIGINT, list_reduce(list_prepend(4294967295 :: UBIGINT, list_transform(range(len(doc_id :: VARCHAR)), lambda i: ascii((doc_id :: VARCHAR)[i + 1]) :: UBIGINT)), lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) :: BIGINT + 1]))) % 7) = 0, false) AS hit FROM documents, crc
), l AS (
  SELECT doc_id, coalesce(lang, '') AS g, lang IS NOT NULL AS known, sha256(a || coalesce(octet_length(encode(n_chars :: VARCHAR)) || ':' || n_chars, '-') || b) AS leaf, sha256(a || coalesce(octet_length(encode((n_chars + CASE WHEN hit THEN 1 ELSE 0 END) :: VARCHAR)) || ':' || (n_chars + CASE WHEN hit THEN 1 ELSE 0 END), '-') || b) AS tampered
  FROM (SELECT *, coalesce(octet_length(encode(doc_id :: VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS a, coalesce(octet_length(encode(text)) || ':' || text, '-') AS b FROM d)
), p AS (
  SELECT *, row_number() OVER (PARTITION BY known, g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pl FROM l
), t AS (
  SELECT known, g, 0 AS level, list(leaf ORDER BY pl) AS nodes FROM p GROUP BY known, g
  UNION ALL
  SELECT known, g, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM t WHERE len(nodes) > 1
), s AS (
  SELECT known, g, level, nodes[1] AS subroot, row_number() OVER (ORDER BY known, encode(g)) - 1 AS pl FROM t WHERE len(nodes) = 1
), u AS (
  SELECT 0 AS level, list(subroot ORDER BY pl) AS nodes FROM s HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM u WHERE len(nodes) > 1
), w AS (
  SELECT known, g, s.level AS top, subroot, s.pl AS sat, nodes[1] AS root, u.level AS utop FROM s, u WHERE len(u.nodes) = 1
), f AS (
  SELECT doc_id, known, g, p.pl, leaf, top, sat, utop, subroot, root, 0 AS k, tampered AS node, '' AS seen, row_number() OVER () AS r FROM p JOIN w USING (known, g)
  UNION ALL
  SELECT doc_id, known, g, f.pl, leaf, top, sat, utop, subroot, root, k + 1,
    CASE WHEN i % 2 = 0 THEN sha256(node || coalesce(x, '')) ELSE sha256(x || node) END, seen || coalesce(x, ''), r
  FROM (SELECT f.*, CASE WHEN k < top THEN f.pl >> k ELSE sat >> greatest(k - top, 0) END AS i,
      CASE WHEN k < top THEN t.nodes ELSE u.nodes END AS ns, ns[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END] AS x
    FROM f LEFT JOIN t ON t.known = f.known AND t.g = f.g AND t.level = k AND k < top LEFT JOIN u ON u.level = k - top AND k >= top WHERE k < top + utop) f
)
SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, node AS folded_root, node = root AS verified FROM f WHERE k = top + utop
"""
