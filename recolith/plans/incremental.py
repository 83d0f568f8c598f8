"""The compile by changes: a source's new fragments carried through merge, relations and candidates, for the ids that they touch.

A ledger keeps fragments by source and hash of id, and what follows from them - entries, what is known of ids, relations, block keys, packets - in tables by buckets of a key.
An update compares the source's fragments with those it had; the ids whose fragments differ are merged anew, over all sources; relations whose own fragments differ, or whose
ends have appeared, gone or changed between promoted and held, are checked anew; block keys of these entries, old and new, are the blocks whose packets are made anew. Of every table
only the buckets of such keys are read and written, except that ends which changed are looked for among all relations' ends (three narrow columns). What has no fragments any more goes.

After any updates the state is that of one full compile of all sources' last fragments (``baseline`` and ``find_candidates``). An update that was lost is run again, with the same fragments or
later ones: what it had found to do is kept (``pending``) until all tables have it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import buckets as bk
from ..model import ENTRY, ENTRY_FRAGMENT, RELATION, RELATION_FRAGMENT
from ..operators import candidates as ca
from ..operators import fragments as fr
from ..stages import materialise

KEY = ["reason", "match_key"]
EDGE = ["from_id", "kind", "to_id"]
KNOWN = "id string, entry boolean"
BLOCK_KEY = "reason string, match_key string, id string"
MEMBER = "reason string, match_key string, packet_id string, entry_id string"
PACKET = "id string, reason string, match_key string, severity string, confidence string, review_category string, risks array<string>, source_families array<string>, n long, kinds array<string>, families array<string>, sources array<string>"
RAW_EDGE = ["from_id", "relation_kind", "to_id"]
#: Fragments of a file. A bucket of more, though all may be of one id, is several tasks' to write and to read.
FILE_ROWS = 1 << 16


class Ledger:
    """``policy``: (source, kind, action); ``kinds``: relation kinds by the name that sources give them; ``prefix``: before kinds, as ``find_candidates`` has it."""

    def __init__(self, spark: SparkSession, path: str, policy: DataFrame, kinds: dict[str, str] | None = None, prefix: str = "", buckets: int = 64) -> None:
        self.spark, self.path, self.policy, self.kinds, self.prefix, self.buckets = spark, path.rstrip("/"), policy, kinds or {}, prefix, buckets

    def _schema(self, text: str) -> StructType:
        return self.spark.createDataFrame([], text).schema

    def _at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def entries(self) -> DataFrame:
        return self._all("entries", ENTRY)

    def relations(self) -> DataFrame:
        return self._all("relations", RELATION)

    def packets(self) -> DataFrame:
        """As ``find_candidates`` gives them."""
        return self._all("packets", PACKET)

    def members(self) -> DataFrame:
        return self._all("members", MEMBER).select("packet_id", "entry_id")

    def _all(self, name: str, schema: str) -> DataFrame:
        bk.recover(self.spark, self._at(name))
        return bk.read_table(self.spark, self._at(name)) if bk._parts(self.spark, self._at(name)) else self.spark.createDataFrame([], schema)

    # fragments: parts of a source and a bucket of the id

    def _fragments(self, name: str, schema: str) -> DataFrame:
        bk.recover(self.spark, self._at(name))
        if not bk._parts(self.spark, self._at(name)):
            return self.spark.createDataFrame([], f"{schema}, part string")
        return self.spark.read.schema(StructType([*self._schema(schema).fields, *self._schema("part string").fields])).parquet(self._at(name))

    def _differing(self, name: str, schema: str, source: str, new: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
        """Keys of the fragments of the source that differ from those it had, and the new ones with their part."""
        placed = new.select(*self._schema(schema).names).withColumn("part", F.concat(F.lit(f"{source}~"), bk.bucket_of(key[:1], self.buckets)))
        old = self._fragments(name, schema).where(F.col("part").startswith(f"{source}~"))
        both = [df.select(*key, F.xxhash64(*bk.sortables(df.drop("part"))).alias("h"), F.lit(n).alias("n")) for df, n in ((old, -1), (placed, 1))]
        changed = both[0].unionByName(both[1]).groupBy(*key, "h").agg(F.sum("n").alias("n")).where("n <> 0").select(*key).distinct()
        return changed, placed

    def _store(self, name: str, source: str, placed: DataFrame, changed: DataFrame, column: str) -> None:
        """The source's fragments in the buckets of changed ids, ``FILE_ROWS`` a file."""
        parts = [f"{source}~{b}" for b in bk._touched(changed, [column], self.buckets)]
        if not parts:
            return
        staged = f"{self._at(name)}.{uuid.uuid4().hex}"
        rows = placed.where(F.col("part").isin(parts))
        sizes = rows.groupBy("part").count().collect()  # of ids alone; a row a touched part
        shares = [-(-r["count"] // FILE_ROWS) for r in sizes]
        dealt = self.spark.createDataFrame([(r["part"], sum(shares[:i]), n) for i, (r, n) in enumerate(zip(sizes, shares, strict=True))], "part string, first int, files int")
        # a task a file: fragments of a part by their own place, not their id
        file = (F.col("first") + F.pmod(F.xxhash64("source_record_id", "ord"), F.col("files"))).cast("int")
        rows = rows.join(F.broadcast(dealt), "part").repartitionById(max(1, sum(shares)), file)
        rows.select(*placed.columns).write.partitionBy("part").parquet(staged)
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        full = set(bk._parts(self.spark, staged))
        bk.move_in(self.spark, staged, self._at(name), [n for n in (f"part={escape(p)}" for p in parts) if n not in full])

    def _of(self, name: str, schema: str, wanted: DataFrame, column: str) -> DataFrame:
        """Fragments of all sources whose ``column`` is among ``wanted``, from the buckets that may have some."""
        names = bk._touched(wanted, [column], self.buckets)
        rows = self._fragments(name, schema)
        return rows.where(F.substring_index("part", "~", -1).isin(names)).drop("part").join(wanted.select(column).distinct(), column, "left_semi").select(*self._schema(schema).names)

    def update(self, source: str, entries: DataFrame, relations: DataFrame) -> None:
        """``entries`` and ``relations`` (fragments) take the place of those that the source had. Both are read more than once: what is dear to make is written before."""
        ids, new_entries = self._differing("entry_fragments", ENTRY_FRAGMENT, source, entries, ["provisional_id"])
        edges, new_edges = self._differing("relation_fragments", RELATION_FRAGMENT, source, relations, RAW_EDGE)
        ids, edges = self._pending("ids", ids), self._pending("edges", edges)
        self._store("entry_fragments", source, new_entries, ids, "provisional_id")
        self._store("relation_fragments", source, new_edges, edges, "from_id")

        rows = self._of("entry_fragments", ENTRY_FRAGMENT, ids, "provisional_id")
        decided = materialise(fr.promotion(rows, self.policy), "decided")
        merged = materialise(fr.merge_entries(fr.promoted(decided)), "merged")
        known = materialise(merged.select("id", F.lit(True).alias("entry")).unionByName(fr.not_promoted(decided).select("id", F.lit(False).alias("entry"))), "known")
        ids = ids.withColumnRenamed("provisional_id", "id")
        was = self._lookup("known", KNOWN, ids, ["id"]).withColumnRenamed("entry", "was")
        flipped = self._pending("flipped", ids.join(known, "id", "left").join(was, "id", "left").where("NOT (entry <=> was)").select("id"))
        old_keys = self._pending("block_keys", ca.block_keys(self._lookup("entries", ENTRY, ids, ["id"])).select(*KEY, "id"))

        bk.upsert(merged, self._at("entries"), ["id"], self.buckets, deleted=ids)
        bk.upsert(known, self._at("known"), ["id"], self.buckets, deleted=ids)
        edges = self._relate(edges, flipped)
        self._block(ids, edges.select(F.col("from_id").alias("id")), old_keys)
        files, path = bk.file_system(self.spark, self._at("pending"))
        files.delete(path, True)

    def _pending(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows``, and those of an update that was lost; kept until the update has reached all tables."""
        path = self._at(f"pending/{name}")
        rows.write.mode("append").parquet(path)
        return materialise(self.spark.read.schema(rows.schema).parquet(path).distinct(), f"pending-{name}")

    def _lookup(self, name: str, schema: str, wanted: DataFrame, by: list[str]) -> DataFrame:
        return bk.lookup(self.spark, self._at(name), wanted, by, self._schema(schema))

    def _relate(self, edges: DataFrame, flipped: DataFrame) -> DataFrame:
        """Relations of ``edges``, and of those with an end in ``flipped``, checked and united anew; returns their keys."""
        if not flipped.isEmpty():
            ends = self._fragments("relation_fragments", RELATION_FRAGMENT).select(*RAW_EDGE)
            for c in ("from_id", "to_id"):
                edges = edges.unionByName(ends.join(flipped.withColumnRenamed("id", c), c, "left_semi").select(*RAW_EDGE))
        edges = materialise(fr.canonical_kinds(edges, self.kinds).select("from_id", F.col("relation_kind").alias("kind"), "to_id").distinct(), "touched-edges")
        rows = fr.canonical_kinds(self._of("relation_fragments", RELATION_FRAGMENT, edges, "from_id"), self.kinds).withColumn("kind", F.col("relation_kind")).join(edges, EDGE, "left_semi").drop("kind")
        known = materialise(self._lookup("known", KNOWN, edges.select(F.explode(F.array("from_id", "to_id")).alias("id")), ["id"]), "known-ends")
        checked = fr.endpoint_status(rows, known.where("entry").select("id"), known.where("NOT entry").select("id"))
        bk.upsert(fr.dedupe_relations(checked.where("status = 'keep'")), self._at("relations"), EDGE, self.buckets, by=["from_id"], deleted=edges)
        return edges

    def _block(self, ids: DataFrame, sources: DataFrame, old_keys: DataFrame) -> None:
        """Block keys of ``ids``, and the packets of the blocks that these are or were in, or entries whose relations have changed (``sources``)."""
        touched = ids.unionByName(sources).distinct()
        now = materialise(ca.block_keys(self._lookup("entries", ENTRY, touched, ["id"])).select(*KEY, "id"), "keys-now")
        blocks = materialise(now.select(*KEY).unionByName(old_keys.select(*KEY)).distinct(), "touched-blocks")
        bk.upsert(now.join(ids, "id", "left_semi").select(*KEY, "id"), self._at("block_keys"), [*KEY, "id"], self.buckets, by=KEY, deleted=old_keys)
        inside = materialise(self._lookup("block_keys", BLOCK_KEY, blocks, KEY).select("id").distinct(), "block-entries")
        members = self._lookup("entries", ENTRY, inside, ["id"])
        edges = self._lookup("relations", RELATION, inside.withColumnRenamed("id", "from_id"), ["from_id"])
        packets, listed = ca.find_candidates(members, edges, self.prefix)
        # other blocks of these entries have members that aren't here: they stay as they are
        packets = materialise(packets.join(blocks, KEY, "left_semi").select(*packets.columns), "packets")
        listed = listed.join(packets.select(F.col("id").alias("packet_id"), *KEY), "packet_id").select(*KEY, "packet_id", "entry_id")
        gone = materialise(self._lookup("members", MEMBER, blocks, KEY), "members-before")
        bk.upsert(packets, self._at("packets"), KEY, self.buckets, deleted=blocks)
        bk.upsert(listed, self._at("members"), [*KEY, "packet_id", "entry_id"], self.buckets, by=KEY, deleted=gone)
