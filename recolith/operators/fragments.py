"""Fragments to entries and relations: union, promotion, merge, endpoint checks, dedupe.

All are groupings by id with partial aggregation; picks of the first, last or longest are ``min_by`` and
``max_by`` over an explicit order, never over arrival. Attributes and citations are merged by (id, key), so that an
id with many fragments is spread over its keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import citation_id, is_citation


def union_fragments(*frames: DataFrame) -> DataFrame:
    """UNION ALL in binding order; each frame's ``ord.binding`` is its place here."""
    placed = [f.withColumn("ord", F.struct(F.lit(i).alias("binding"), F.col("ord.record").alias("record"), F.col("ord.emit").alias("emit"))) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b), placed)


def first_wins(frames: list[DataFrame], key: str, *order: Column) -> DataFrame:
    """Union with left priority: of the rows of a key the first frame's stays, then the first by ``order``."""
    union = reduce(lambda a, b: a.unionByName(b), [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames)])
    columns = [c for c in union.columns if c != "__frame"]
    return union.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct("__frame", *order)).alias("row")).select("row.*")


def merge_order() -> Column:
    """Fragments of an id: by record id, then by arrival."""
    return F.struct(F.collate("source_record_id", "UNICODE").alias("record"), F.col("ord"))


def merge_entries(fragments: DataFrame, leading: tuple[str, ...] | None = None) -> DataFrame:
    """One entry an id: first kind, last family, longest name (the first of equal length), attributes of the last
    fragment that has them, citations distinct and ordered. ENTRY columns. With ``leading`` citations are the ``leading_citations`` of these sources alone."""
    ordered = fragments.withColumn("o", merge_order())
    heads = ordered.groupBy(F.col("provisional_id").alias("id")).agg(
        F.max_by("family", "o").alias("family"),
        F.min_by("kind", "o").alias("kind"),
        F.min_by("name", F.struct((-F.length("name")).alias("n"), F.col("o"))).alias("name"),
        *([] if leading is None else [leading_citations(leading)]),
    )
    attributes = (
        ordered.select(F.col("provisional_id").alias("id"), "o", F.explode("attributes").alias("key", "value"))
        .groupBy("id", "key")
        .agg(F.max_by("value", "o").alias("value"))
        .groupBy("id")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("attributes"))
    )
    empty = F.create_map().cast("map<string,string>")
    if leading is None:
        heads = heads.join(merge_citations(ordered.select(F.col("provisional_id").alias("id"), "citations"), "id"), "id")
    return heads.join(attributes, "id", "left").select("id", "family", "kind", "name", F.coalesce("attributes", empty).alias("attributes"), "citations")


def merge_citations(rows: DataFrame, *keys: str) -> DataFrame:
    """keys and citations: valid, distinct by identity, in its order; an empty array where there are none."""
    c = F.when(is_citation(F.col("c")), F.col("c"))
    each = rows.select(*keys, F.explode_outer("citations").alias("c")).select(*keys, c.alias("c")).withColumn("k", F.when(F.col("c").isNotNull(), citation_id(F.col("c"))))
    one = each.groupBy(*keys, "k").agg(F.min("c").alias("c"))
    kept = F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "c")))
    return one.groupBy(*keys).agg(F.transform(F.array_sort(kept), lambda x: x["c"]).alias("citations"))


def leading_citations(sources: tuple[str, ...] = ()) -> Column:
    """An aggregate of citations: of the merged ones in their order, the first that names a source or an address, and the first of each of
    ``sources``. What an entry is shown to come from is among these, so one that a third of all records cite needs no list of them."""

    def first(fits: Callable[[Column], Column]) -> Column:
        own = F.filter("citations", lambda c: is_citation(c) & fits(c))
        return F.min(F.array_min(F.transform(own, lambda c: F.struct(citation_id(c).alias("k"), c.alias("c")))))

    every = [first(lambda c: c["source"].isNotNull() | c["url"].isNotNull()), *[first(lambda c, s=s: c["source"] == s) for s in sources]]
    return F.transform(F.array_sort(F.array_distinct(F.array_compact(F.array(*every)))), lambda x: x["c"]).alias("citations")


def kind_conflicts(fragments: DataFrame) -> DataFrame:
    """id, kind (the first), conflicts: fragments whose kind is another."""
    by_kind = fragments.withColumn("o", merge_order()).groupBy("provisional_id", "kind").agg(F.count("*").alias("n"), F.min("o").alias("o"))
    merged = by_kind.groupBy(F.col("provisional_id").alias("id")).agg(F.min_by("kind", "o").alias("kind"), F.sum("n").alias("all"), F.min_by("n", "o").alias("own"))
    return merged.select("id", "kind", (F.col("all") - F.col("own")).alias("conflicts")).where("conflicts > 0")


ACTIONS = ("promote", "promote_with_warning", "review_required", "conflict", "drop")


def promotion(fragments: DataFrame, policy: DataFrame) -> DataFrame:
    """``fragments`` with action: the policy's (source, kind, action), ``conflict`` where it has none."""
    return fragments.join(policy.select("source", "kind", "action"), ["source", "kind"], "left").withColumn("action", F.coalesce("action", F.lit("conflict")))


def promoted(decided: DataFrame) -> DataFrame:
    return decided.where(F.col("action").isin("promote", "promote_with_warning")).drop("action")


def not_promoted(decided: DataFrame) -> DataFrame:
    """id and action, the last fragment's, of ids that no fragment promotes."""
    good = F.col("action").isin("promote", "promote_with_warning")
    groups = decided.withColumn("o", merge_order()).groupBy(F.col("provisional_id").alias("id")).agg(F.max_by("action", "o").alias("action"), F.bool_or(good).alias("any"))
    return groups.where("NOT any").drop("any")


def promotion_findings(decided: DataFrame) -> DataFrame:
    """One finding a fragment that isn't simply promoted."""
    kind = F.when(F.col("action") == "conflict", "conflict").when(F.col("action") == "drop", "info").otherwise("warn")
    return decided.where("action <> 'promote'").select(kind.alias("kind"), F.concat(F.lit("promotion."), F.col("action")).alias("code"), F.concat_ws(" ", F.lit("fragment"), "provisional_id", F.lit("of"), "source", F.lit("has decision"), "action").alias("message"), F.get("citations", 0).alias("citation"))


def canonical_kinds(relations: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``relations`` with relation_kind by the mapping, and renamed: whether it did."""
    kind = F.col("relation_kind")
    mapped = F.coalesce(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[kind], kind) if mapping else kind
    return relations.withColumn("renamed", mapped != kind).withColumn("relation_kind", mapped)


def endpoint_status(relations: DataFrame, entry_ids: DataFrame, not_promoted_ids: DataFrame) -> DataFrame:
    """``relations`` with status: keep, or what is wrong, the source's side first."""
    known = entry_ids.select("id", F.lit(True).alias("entry")).unionByName(not_promoted_ids.select("id", F.lit(False).alias("entry"))).groupBy("id").agg(F.bool_or("entry").alias("entry"))
    sides = relations.join(known.withColumnsRenamed({"id": "from_id", "entry": "__from"}), "from_id", "left").join(known.withColumnsRenamed({"id": "to_id", "entry": "__to"}), "to_id", "left")

    def side(flag: str, name: str) -> Column:
        return F.when(F.col(flag).isNull(), f"{name}_missing").when(~F.col(flag), f"{name}_not_promoted")

    return sides.withColumn("status", F.coalesce(side("__from", "source"), side("__to", "target"), F.lit("keep"))).select(*relations.columns, "status")


def relation_findings(checked: DataFrame) -> DataFrame:
    """A warning for ends that were not promoted, a conflict for ends that don't exist."""
    end = F.when(F.col("status").startswith("source"), F.col("from_id")).otherwise(F.col("to_id"))
    missing = F.col("status").endswith("missing")
    code = F.concat(F.when(missing, "compiler.conflict.relation_").otherwise("compiler.relation_"), F.col("status"))
    return checked.where("status <> 'keep'").select(F.when(missing, "conflict").otherwise("warn").alias("kind"), code.alias("code"), F.concat_ws(" ", F.lit("relation"), "relation_kind", F.lit("end"), end).alias("message"), F.when(~missing, F.get("citations", 0)).alias("citation"))


def findings_order() -> list[Column]:
    """Findings by kind, code, message and citation: an order for reports and files."""
    text = F.coalesce(F.when(F.col("citation").isNotNull(), citation_id(F.col("citation"))), F.lit(""))
    return [F.col("kind"), F.col("code"), F.col("message"), text]


def dedupe_relations(relations: DataFrame, leading: tuple[str, ...] | None = None) -> DataFrame:
    """RELATION rows: one a (from, kind, to), citations united; with ``leading`` the ``leading_citations`` of these sources alone."""
    rows = relations.select("from_id", F.col("relation_kind").alias("kind"), "to_id", "citations")
    if leading is not None:
        return rows.groupBy("from_id", "kind", "to_id").agg(leading_citations(leading))
    return merge_citations(rows, "from_id", "kind", "to_id")


def dangling(relations: DataFrame, entries: DataFrame) -> DataFrame:
    """Relations whose target is no entry."""
    return relations.join(entries.select(F.col("id").alias("to_id")), "to_id", "left_anti").select(*relations.columns)


def backlinks(relations: DataFrame) -> DataFrame:
    """Edges the other way round: from_id has the relation to id."""
    return relations.select(F.col("to_id").alias("id"), "kind", "from_id", "citations")
