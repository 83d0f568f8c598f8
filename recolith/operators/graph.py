"""Projections of entries and relations: a public graph, and denormalised tables.

``entries`` have id, kind, family, name, attributes and citations; ``relations`` from_id, kind, to_id. Lists in a row are
of one entry's neighbours; what may be long is a table of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import id_slug
from ..stages import materialise
from .places import placed


@dataclass(frozen=True)
class Verb:
    """What a relation kind is called in public, and between which kinds; empty: any."""

    verb: str
    from_kinds: tuple[str, ...] = ()
    to_kinds: tuple[str, ...] = ()


def nodes(entries: DataFrame, categories: dict[str, str], excluded: DataFrame) -> DataFrame:
    """Entries of kinds that have a category, without the excluded ids."""
    table = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    rows = entries.withColumn("category", table[F.col("kind")]).where("category IS NOT NULL").join(excluded.select("id"), "id", "left_anti")
    return rows.select("id", id_slug(F.col("id")).alias("slug"), "name", "category", "kind", "family")


def public_verb(verbs: dict[str, Verb], relation: Column, from_kind: Column, to_kind: Column) -> Column:
    found: Column | None = None
    for kind, v in verbs.items():
        fits = relation == kind
        if v.from_kinds:
            fits = fits & from_kind.isin(*v.from_kinds)
        if v.to_kinds:
            fits = fits & to_kind.isin(*v.to_kinds)
        found = F.when(fits, v.verb) if found is None else found.when(fits, v.verb)
    return F.lit(None).cast("string") if found is None else found


def edges(relations: DataFrame, node_rows: DataFrame, verbs: dict[str, Verb]) -> DataFrame:
    """Relations between nodes that have a public verb: from_id, verb, to_id, relation_kind."""
    ends = node_rows.select("id", "kind")
    rows = relations.withColumnRenamed("kind", "relation_kind")
    rows = rows.join(ends.withColumnsRenamed({"id": "from_id", "kind": "__from"}), "from_id").join(ends.withColumnsRenamed({"id": "to_id", "kind": "__to"}), "to_id")
    return rows.withColumn("verb", public_verb(verbs, F.col("relation_kind"), F.col("__from"), F.col("__to"))).where("verb IS NOT NULL").select("from_id", "verb", "to_id", "relation_kind")


def excluded_edges(relations: DataFrame, node_rows: DataFrame, blocked: DataFrame) -> DataFrame:
    """Relations that leave a node or a blocked entry and don't arrive at a node, or whose start is blocked."""
    known = node_rows.select("id")
    starts = known.withColumn("node", F.lit(True)).unionByName(blocked.select("id", F.lit(False).alias("node"))).groupBy(F.col("id").alias("from_id")).agg(F.bool_or("node").alias("node"))
    # each row is judged by its own ends, so no copies of rows meet to be told apart
    ends = known.distinct().select(F.col("id").alias("to_id"), F.lit(True).alias("arrives"))
    return relations.select("from_id", "kind", "to_id").join(starts, "from_id").join(ends, "to_id", "left").where("NOT (node AND arrives IS NOT NULL)").select("from_id", "kind", "to_id")


def summary(node_rows: DataFrame, edge_rows: DataFrame) -> DataFrame:
    """section, label, n: nodes by category, edges by verb, mapped relations."""
    return (
        node_rows.groupBy(F.col("category").alias("label")).agg(F.count("*").alias("n")).withColumn("section", F.lit("node_category"))
        .unionByName(edge_rows.groupBy(F.col("verb").alias("label")).agg(F.count("*").alias("n")).withColumn("section", F.lit("edge_verb")))
        .unionByName(edge_rows.where("relation_kind <> verb").groupBy(F.concat_ws(">", "relation_kind", "verb").alias("label")).agg(F.count("*").alias("n")).withColumn("section", F.lit("mapped_relation")))
        .select("section", "label", "n")
    )


def first_parent(entries: DataFrame, relations: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Entries with parent_id: of their relations of the given kinds the first, by kind, then by target."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    parents = relations.where(F.col("kind").isin(*kinds)).groupBy(F.col("from_id").alias("id")).agg(F.min_by("to_id", F.struct(rank.alias("r"), F.col("to_id"))).alias("parent_id"))
    return entries.join(parents, "id", "left")


def first_of_kind(entries: DataFrame, relations: DataFrame, relation: str, target_kind: str, name: str) -> DataFrame:
    """Entries with ``name``: the smallest target of the relation that is of the kind."""
    targets = entries.where(F.col("kind") == target_kind).select(F.col("id").alias("to_id"))
    found = relations.where(F.col("kind") == relation).join(targets, "to_id", "left_semi").groupBy(F.col("from_id").alias("id")).agg(F.min("to_id").alias(name))
    return entries.join(found, "id", "left")


def related(relations: DataFrame, entries: DataFrame, relation: str, incoming: bool = False) -> DataFrame:
    """id, other and name: the other ends of an entry's relations, a row each, however many there are."""
    own, other = ("to_id", "from_id") if incoming else ("from_id", "to_id")
    return relations.where(F.col("kind") == relation).select(F.col(own).alias("id"), F.col(other).alias("other")).join(entries.select(F.col("id").alias("other"), "name"), "other").select("id", "other", "name")


def related_counts(rows: DataFrame) -> DataFrame:
    """id and n of ``related`` rows, not distinct; counted map-side, so a hub is one number a task."""
    return rows.groupBy("id").agg(F.count("*").alias("n"))


#: Members of an entry beyond which its list is made in chunks, and the members of a chunk.
MOST, CHUNK = 10_000, 1_000
SEPARATOR = "; "


def list_chunks(rows: DataFrame, key: str, order: list[str], texts: list[str], chunk: int = CHUNK) -> DataFrame:
    """key, chunk (from 0), n and, for each of ``texts``, the values of ``chunk`` rows joined, in the given order. ``rows`` are dealt by
    ranges of key and order, so a key of any number of rows is no one task's."""
    at = placed(materialise(rows, "members"), [F.col(c).asc() for c in (key, *order)], "members-in-order")
    first = at.groupBy(key).agg(F.min("__at").alias("__first"))
    cut = at.join(first, key).withColumn("chunk", F.floor((F.col("__at") - F.col("__first")) / chunk).cast("long"))
    each = cut.groupBy(key, "chunk").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.col("__at").alias("at"), *texts))).alias("l"))
    return each.select(key, "chunk", "n", *[F.array_join(F.col("l")[t], SEPARATOR).alias(t) for t in texts])


def listed(rows: DataFrame, key: str, order: list[str], texts: list[str], most: int = MOST, chunk: int = CHUNK) -> DataFrame:
    """key, n and, for each of ``texts``, the values joined by ``; `` in the given order: for files whose readers want lists in a cell.

    Keys of more than ``most`` rows are listed in chunks, which alone are put together; the cell is the same text either way.
    """

    def joined(part: DataFrame) -> DataFrame:
        group = part.groupBy(key).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *texts))).alias("l"))
        return group.select(key, "n", *[F.array_join(F.col("l")[t], SEPARATOR).alias(t) for t in texts])

    rows = rows.where(F.col(key).isNotNull())
    hubs = materialise(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(key), "hubs")
    if hubs.isEmpty():
        return joined(rows)
    parts = list_chunks(rows.join(F.broadcast(hubs) if hubs.count() <= MOST else hubs, key, "left_semi"), key, order, texts, chunk)
    group = parts.groupBy(key).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("chunk", *texts))).alias("l"))
    large = group.select(key, "n", *[F.array_join(F.col("l")[t], SEPARATOR).alias(t) for t in texts])
    return joined(rows.join(hubs, key, "left_anti")).unionByName(large)


def related_list(relations: DataFrame, entries: DataFrame, relation: str, incoming: bool = False, most: int = MOST) -> DataFrame:
    """id, n (not distinct), ids and names of the other ends, distinct by id, in order of name, joined by ``; ``."""
    rows = related(relations, entries, relation, incoming)
    made = listed(rows.distinct(), "id", ["name", "other"], ["other", "name"], most).drop("n")
    return related_counts(rows).join(made, "id", "left").select("id", "n", F.col("other").alias("ids"), F.col("name").alias("names"))


def chain(entries: DataFrame, relations: DataFrame, first: tuple[str, str], second: tuple[str, str], top_kind: str) -> DataFrame:
    """top_id, middle_id, seat_id: tops of a kind to middles by ``first`` (relation, kind), to seats by ``second``
    where there is one; of several seats that lead to a middle the last."""
    of = lambda kind: entries.where(F.col("kind") == kind).select("id")
    middles = relations.where(F.col("kind") == first[0]).select(F.col("from_id").alias("top_id"), F.col("to_id").alias("middle_id"))
    middles = middles.join(of(top_kind).withColumnRenamed("id", "top_id"), "top_id", "left_semi").join(of(first[1]).withColumnRenamed("id", "middle_id"), "middle_id", "left_semi")
    seats = relations.where(F.col("kind") == second[0]).select(F.col("from_id").alias("seat_id"), F.col("to_id").alias("middle_id")).join(of(second[1]).withColumnRenamed("id", "seat_id"), "seat_id", "left_semi")
    return middles.join(seats.groupBy("middle_id").agg(F.max("seat_id").alias("seat_id")), "middle_id", "left").select("top_id", "middle_id", "seat_id")


def role_override(rows: DataFrame, keys: list[str], role: str, ranks: tuple[str, ...]) -> DataFrame:
    """keys and role: of several roles the one that stands last in ``ranks``."""
    rank = F.array_position(F.array(*map(F.lit, ranks)), F.col(role))
    return rows.groupBy(*keys).agg(F.max_by(role, rank).alias(role))


def distinct_summary(rows: DataFrame, key: str, member: str, name: str) -> DataFrame:
    """key, members (distinct, counted by rows of key and member), names (distinct, sorted, joined)."""
    members = rows.select(key, member).where(F.col(member).isNotNull()).distinct().groupBy(key).agg(F.count("*").alias("members"))
    names = listed(rows.select(key, F.col(name).alias("names")).where("names IS NOT NULL").distinct(), key, ["names"], ["names"]).drop("n")
    both = rows.select(key).distinct().join(names, key, "left").join(members, key, "left")
    return both.select(key, F.coalesce("members", F.lit(0)).cast("long").alias("members"), F.coalesce("names", F.lit("")).alias("names"))


def stable_position(rows: DataFrame, order: Column, tie: Column) -> DataFrame:
    """``rows`` in order of the first column with an explicit tie-breaker, for file sinks."""
    return rows.orderBy(order, tie)


def ranked(rows: DataFrame, partition: list[str], *order: Column) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*partition).orderBy(*order)))
