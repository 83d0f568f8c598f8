"""Revisions and identity aliases: rules, resolution of ids, and what suppressions and patches do to a state. ``replay`` has the order in which revisions see each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import citation_id
from .fragments import dedupe_relations


def alias_index(aliases: DataFrame) -> DataFrame:
    """key_type (id or ref), key, canonical_id: distinct."""
    ids = aliases.select(F.lit("id").alias("key_type"), F.explode("previous_ids").alias("key"), "canonical_id")
    refs = aliases.select(F.lit("ref").alias("key_type"), F.explode("source_refs").alias("c"), "canonical_id").select("key_type", citation_id(F.col("c"), "|").alias("key"), "canonical_id")
    return ids.unionByName(refs).distinct()


def resolve_aliases(keys: DataFrame, index: DataFrame) -> DataFrame:
    """``keys`` (key_type, key) with status resolved, missing or ambiguous, canonical_id and canonical_ids (sorted, joined)."""
    found = index.groupBy("key_type", "key").agg(F.array_sort(F.collect_set("canonical_id")).alias("all"))
    n = F.coalesce(F.size("all"), F.lit(0))
    status = F.when(F.col("all").isNull(), "missing").when(n == 1, "resolved").otherwise("ambiguous")
    return keys.join(found, ["key_type", "key"], "left").select(*keys.columns, status.alias("status"), F.when(n == 1, F.get("all", 0)).alias("canonical_id"), F.array_join("all", ",").alias("canonical_ids"))


def target_keys(revisions: DataFrame) -> Column:
    """The ids and source references by which a revision names its target, besides its canonical id: an array of (key_type, key)."""
    none = F.array().cast("array<string>")
    ids = F.concat(F.array("target_id"), F.coalesce("target.previous_ids", none))
    refs = F.transform(F.coalesce("target.source_refs", F.expr("array()").cast(revisions.schema["target"].dataType["source_refs"].dataType)), lambda c: citation_id(c, "|"))
    return _keys(ids, refs)


def patch_keys(parsed: Column | None = None) -> Column:
    """The ids that a patch refers to, in the same form: the canonical entry of its review and the ends of its relations. ``parsed``: the patch as a variant."""
    parsed = F.try_parse_json("patch") if parsed is None else parsed
    # a patch that isn't parsed may still have relations to read
    has = parsed.isNull() | F.try_variant_get(parsed, "$.relations", "variant").isNotNull()
    by_kind = F.when(has, F.from_json("patch", "relations map<string,string>")["relations"])
    ends = F.flatten(F.array_compact(F.transform(F.map_values(by_kind), lambda v: F.from_json(v, "array<struct<to:string>>")["to"])))
    canonical = F.try_variant_get(parsed, "$.review.canonicalEntryId", "string")
    return _keys(F.concat(F.array(canonical), F.coalesce(ends, F.array().cast("array<string>"))), F.array().cast("array<string>"))


def _keys(ids: Column, refs: Column) -> Column:
    each = F.concat(F.transform(ids, lambda x: F.struct(F.lit("id").alias("key_type"), x.alias("key"))), F.transform(refs, lambda x: F.struct(F.lit("ref").alias("key_type"), x.alias("key"))))
    return F.filter(each, lambda k: k["key"].isNotNull())


def revision_issues(revisions: DataFrame) -> DataFrame:
    """id and rule, for each rule that a revision breaks."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    patch = F.try_parse_json("patch")
    suppress = F.coalesce(F.try_variant_get(patch, "$.suppress", "boolean"), F.lit(False))
    review = F.try_variant_get(patch, "$.review", "variant").isNotNull()
    decision = F.try_variant_get(patch, "$.review.decision", "string")
    entry = F.coalesce(F.col("target_kind") == "entry", F.lit(False))
    lacks = lambda path: F.try_variant_get(patch, path, "variant").isNull()
    rules = [
        ("id", blank("id")), ("source", blank("source")), ("target_id", blank("target_id")),
        ("target_kind", ~F.coalesce(F.col("target_kind").isin("entry", "relation"), F.lit(False))),
        ("patch", ~F.coalesce(F.schema_of_variant(patch).startswith("OBJECT"), F.lit(False))),
        ("suppress", suppress & (~entry | blank("rationale"))),
        ("review", review & (~entry | blank("rationale") | ~F.coalesce(decision.isin("preserve_distinct", "alias", "source_shadow"), F.lit(False)))),
        ("preserve_distinct", (decision == "preserve_distinct") & lacks("$.review.relatedEntryIds")),
        ("alias", (decision == "alias") & lacks("$.review.aliasNames")),
        ("source_shadow", (decision == "source_shadow") & lacks("$.review.canonicalEntryId")),
    ]
    return revisions.select("id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in rules]))).alias("rule"))


def suppress(entries: DataFrame, relations: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without the plan's ids; relations to them lead to their replacement, but never back to their own source. ``plan``: id, replacement or null."""
    ids = plan.select("id")
    left = entries.join(ids, "id", "left_anti").select(*entries.columns)
    edges = relations.join(ids.withColumnRenamed("id", "from_id"), "from_id", "left_anti").join(plan.select(F.col("id").alias("to_id"), "replacement", F.lit(True).alias("gone")), "to_id", "left")
    to = F.when(F.col("gone") & (F.col("replacement") != F.col("from_id")), F.col("replacement")).when(F.col("gone"), F.lit(None)).otherwise(F.col("to_id"))
    moved = edges.select("from_id", F.col("kind").alias("relation_kind"), to.alias("to_id"), "citations").where("to_id IS NOT NULL")
    return left, dedupe_relations(moved)


def patch_entries(entries: DataFrame, patches: DataFrame) -> DataFrame:
    """``patches``: id, kind, name, family (null: as it is), attributes (merged over the old ones), citations (null: as they are)."""
    p = patches.withColumnsRenamed({c: f"__{c}" for c in patches.columns if c != "id"})
    joined = entries.join(p, "id", "left")
    changed = F.coalesce("__attributes", F.create_map().cast("map<string,string>"))
    kept = F.map_filter("attributes", lambda k, v: ~F.map_contains_key(changed, k))
    merged = F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(changed))))
    columns: dict[str, Column] = {c: F.coalesce(f"__{c}", c) for c in ("family", "kind", "name", "citations")}
    return joined.select("id", *[columns[c].alias(c) for c in ("family", "kind", "name")], merged.alias("attributes"), columns["citations"].alias("citations"))


def item_revisions(items: DataFrame, revisions: DataFrame) -> DataFrame:
    """item_id and revision_id where a revision's target or related id is among the item's ids, or a citation of both is equal.

    ``items``: item_id, ids, citations. ``revisions``: revision_id, ids, citations. Three keys of one sort, so one equi-join and a distinct.
    """

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        ids = F.transform("ids", lambda x: F.concat(F.lit("id|"), x))
        cites = F.transform("citations", lambda c: F.concat(F.lit("cite|"), citation_id(c, "|")))
        return rows.select(name, F.explode(F.array_distinct(F.concat(ids, cites))).alias("key"))

    return keyed(items, "item_id").join(keyed(revisions, "revision_id"), "key").select("item_id", "revision_id").distinct()
