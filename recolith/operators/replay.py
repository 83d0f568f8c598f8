"""Revisions replayed over a state, in order of their ids, on the executors.

A revision sees what earlier ones did only through the entries that it may mean: whether they are still there, and by what kind and name. So revisions fall into components over
these entries. In a component where some revision suppresses an entry, or gives it another kind or name, they are read in order, as a stream that holds no more than kind and name of the entries met (a component is
one task's, as each revision may hang on the one before); everywhere else their order makes no difference, and each is decided on its own, so that an entry that a third of all revisions patch is no task's.
What the decisions amount to - patches, new relations, suppressions - are rows, put together by id and order with aggregates; an edge to a
suppressed entry goes where the chain of replacements ends. Nothing of this is collected.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import ALIAS
from ..stages import materialise, spread
from .links import components, ends
from .revisions import alias_index, patch_entries, patch_keys, suppress, target_keys

#: effect: finding, suppress, patch, relations (an entry's are replaced), relation (one of the new ones). ``revision`` and ``row`` are the order.
EFFECT = "effect string, revision string, row long, id string, kind string, name string, family string, code string, message string, to_id string, citations string, review string, attributes map<string,string>"
_FIELDS = [f.split()[0] for f in EFFECT.split(", ")]
_TYPES = [pa.int64() if f == "row" else pa.map_(pa.string(), pa.string()) if f == "attributes" else pa.string() for f in _FIELDS]


class Unclear(ValueError):
    """A reference that several canonical entries answer to."""


def compact(value: Any, **how: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), **how)


def decide(r: dict[str, Any], state: dict[str, tuple[str, str] | None]) -> Iterator[dict[str, Any]]:
    """The effects of one revision. ``state``: kind and name of the entries met so far, None for those that are gone; it is brought up to date."""
    for e in r["known"] or []:
        state.setdefault(e["id"], (e["kind"], e["name"]))
    answers = {(a["key_type"], a["key"]): a["ids"] for a in r["answers"] or []}
    there = lambda id_: state.get(id_) is not None

    def say(kind: str, code: str, message: str) -> dict[str, Any]:
        return {"effect": "finding", "kind": kind, "code": f"compiler.{code}", "message": message}

    options = {r["canonical_id"]} if there(r["canonical_id"]) else set()
    unclear = []
    for k in r["keys"]:
        found = answers.get((k["key_type"], k["key"]), [])
        if k["key_type"] == "id" and there(k["key"]):
            options.add(k["key"])
        elif len(found) == 1:
            options.add(found[0])
        elif found:
            unclear.append(k["key"])
    if unclear or len(options) > 1:
        yield say("conflict", "conflict.revision_target_ambiguous", f"{r['id']}: {', '.join(unclear or sorted(options))}")
        return
    id_ = next(iter(options), None)
    if id_ is None or not there(id_):
        yield say("conflict", "conflict.revision_target_missing", f"{r['id']}: {r['target_id']}")
        return
    kind, name = state[id_]
    if (r["guard_kind"] and r["guard_kind"] != kind) or (r["guard_name"] and r["guard_name"] != name):
        yield say("conflict", "conflict.revision_target_guard_mismatch", f"{r['id']}: {id_}")
        return

    def reference(to: str) -> tuple[str, list[dict[str, Any]]]:
        found = answers.get(("id", to), [])
        if len(found) > 1:
            raise Unclear(f"reference {to} has several canonical entries: {', '.join(sorted(found))}")
        return (found[0], [say("info", "identity_alias.reference_resolved", f"{to}: {found[0]}")]) if found and found[0] != to else (to, [])

    try:
        yield from effects(r, id_, state, reference, say)
    except ValueError as e:
        yield say("conflict", "conflict.revision_invalid_state", f"{r['id']}: {e}")


def effects(r: dict[str, Any], id_: str, state: dict, reference: Any, say: Any) -> Iterator[dict[str, Any]]:
    """What the revision does to the entry that it means."""
    patch = json.loads(r["patch"] or "null")
    if not isinstance(patch, dict):
        raise ValueError("patch is no object")
    review = patch.get("review") if isinstance(patch.get("review"), dict) else {}
    entry = r["target_kind"] == "entry"
    if entry and patch.get("suppress") is True:
        canonical, other = review.get("canonicalEntryId"), None
        if review.get("decision") == "source_shadow" and isinstance(canonical, str) and canonical.strip():
            other, said = reference(canonical)
            yield from said
        state[id_] = None
        yield {"effect": "suppress", "id": id_, "to_id": other}
        yield say("info", "revision.entry_suppressed", f"{r['id']}: {id_}")
        return
    if isinstance(patch.get("relations"), dict):
        made = []
        for x in (x for v in patch["relations"].values() if isinstance(v, list) for x in v):
            if isinstance(x, dict) and isinstance(x.get("kind"), str) and isinstance(x.get("to"), str):
                to, said = reference(x["to"])
                yield from said
                made.append({"effect": "relation", "id": id_, "kind": x["kind"], "to_id": to, "citations": json.dumps(x.get("citations") or [])})
        yield {"effect": "relations", "id": id_}
        yield from made
    elif r["target_kind"] == "relation":
        raise ValueError("patch must include a relations object")
    if not entry:
        return
    own: dict[str, Any] = {"effect": "patch", "id": id_} | {k: patch[k] for k in ("kind", "name", "family") if isinstance(patch.get(k), str) and patch[k]}
    if isinstance(patch.get("attributes"), dict):
        own["attributes"] = [(k, compact(v)) for k, v in patch["attributes"].items()]
    if isinstance(patch.get("citations"), list):
        own["citations"] = json.dumps(patch["citations"])
    if review:
        kept = {k: review[k] for k in ("aliasNames", "relatedEntryIds", "canonicalEntryId") if k in review}
        own["review"] = compact(kept | {"decision": review.get("decision"), "rationale": r["rationale"], "revisionId": r["id"], "source": r["source"]}, sort_keys=True)
        yield say("info", "revision.review_recorded", f"{r['id']}: {id_}")
    yield own
    kind, name = state[id_]
    state[id_] = (own.get("kind", kind), own.get("name", name))


def _values(column: pa.Array) -> list[Any]:
    """A column as Python values; lists of structs by their fields' columns, as made one by one they take most of a revision's time."""
    if column.null_count == len(column):
        return [None] * len(column)
    if not (pa.types.is_list(column.type) and pa.types.is_struct(column.type.value_type)):
        return column.to_pylist()
    flat, names = column.flatten(), [f.name for f in column.type.value_type]
    each = iter([dict(zip(names, v, strict=True)) for v in zip(*[_values(flat.field(i)) for i in range(len(names))], strict=True)])
    return [None if n is None else list(islice(each, n)) for n in pc.list_value_length(column).to_pylist()]


def _rows(b: pa.RecordBatch) -> Iterator[dict[str, Any]]:
    return (dict(zip(b.schema.names, v, strict=True)) for v in zip(*[_values(c) for c in b.columns], strict=True))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, state, out = None, {}, []
    for b in batches:
        for r in _rows(b):
            if r["group"] != group:
                group, state = r["group"], {}
            out += [e | {"revision": r["id"], "row": r["row"]} for e in decide(r, state)]
            if len(out) >= 4096:
                yield _batch(out)
                out = []
    if out:
        yield _batch(out)


def _batch(rows: list[dict[str, Any]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], t) for f, t in zip(_FIELDS, _TYPES, strict=True)], names=_FIELDS)


def grouped(revisions: DataFrame, entries: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """``revisions`` with what they may mean: keys, answers (of the aliases to what they name), known (the entries among it), and
    group: the component, where the order in it matters, else the row alone."""
    spark = revisions.sparkSession
    patch = F.col("__patch")
    changes = (F.col("target_kind") == "entry") & (F.coalesce(F.try_variant_get(patch, "$.suppress", "boolean"), F.lit(False)) | F.try_variant_get(patch, "$.kind", "string").isNotNull() | F.try_variant_get(patch, "$.name", "string").isNotNull())
    rows = spread(revisions).withColumn("__patch", F.try_parse_json("patch")).select(
        F.monotonically_increasing_id().alias("row"), "id", "source", "target_kind", "target_id", F.col("target.canonical_id").alias("canonical_id"), F.col("target.kind").alias("guard_kind"), F.col("target.name").alias("guard_name"),
        "rationale", "patch", target_keys(revisions).alias("keys"), patch_keys(patch).alias("patch_keys"), F.coalesce(changes, F.lit(False)).alias("changes"),
    )
    rows = materialise(rows, "revisions")
    index = alias_index(aliases if aliases is not None else spark.createDataFrame([], ALIAS)).groupBy("key_type", "key").agg(F.array_sort(F.collect_set("canonical_id")).alias("ids"))
    named = rows.select("row", F.explode(F.array_distinct(F.concat(F.transform("keys", lambda k: F.struct(k["key_type"], k["key"], F.lit(True))), F.transform("patch_keys", lambda k: F.struct(k["key_type"], k["key"], F.lit(False))))).cast("array<struct<key_type:string,key:string,target:boolean>>")).alias("k")).select("row", "k.*")
    answered = materialise(named.join(index, ["key_type", "key"]), "revision-aliases")
    meant = named.where("target AND key_type = 'id'").select("row", F.col("key").alias("id")).unionByName(answered.where("target AND size(ids) = 1").select("row", F.get("ids", 0).alias("id")))
    meant = meant.unionByName(rows.where("canonical_id IS NOT NULL").select("row", F.col("canonical_id").alias("id"))).distinct()
    met = materialise(meant.join(entries.select("id", "kind", "name"), "id"), "revision-entries")
    firsts = met.groupBy("row").agg(F.min("id").alias("first"), F.collect_list(F.struct("id", "kind", "name")).alias("known"))
    labels = components(met.join(firsts.select("row", "first"), "row").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct())
    labels = materialise(labels, "revision-components")
    placed = firsts.join(labels.withColumnRenamed("id", "first"), "first").select("row", "known", "component")
    replies = answered.groupBy("row").agg(F.collect_list(F.struct("key_type", "key", "ids")).alias("answers"))
    whole = materialise(rows.drop("patch_keys").join(placed, "row", "left").join(replies, "row", "left"), "revisions-placed")
    ordered = whole.where("changes AND component IS NOT NULL").select("component").distinct().withColumn("ordered", F.lit(True))
    alone = F.concat(F.lit("row:"), F.col("row").cast("string"))
    return whole.join(ordered, "component", "left").withColumn("group", F.when(F.col("ordered"), F.concat(F.lit("component:"), "component")).otherwise(alone)).drop("changes", "component", "ordered")


@dataclass
class Replayed:
    """``effects``: EFFECT rows. ``findings``: kind, code, message. ``suppressed``: id and replacement, where its edges go in the end, or null."""

    effects: DataFrame
    findings: DataFrame
    suppressed: DataFrame


def replay(revisions: DataFrame, entries: DataFrame, aliases: DataFrame | None = None) -> Replayed:
    """What ``revisions`` (REVISION rows) amount to over ``entries``, of which ids, kinds and names count. Of revisions of one id any comes first."""
    dealt = grouped(revisions, entries, aliases).repartition("group").sortWithinPartitions("group", "id", "row")
    made = materialise(dealt.mapInArrow(_stream, EFFECT), "revision-effects")
    gone = made.where("effect = 'suppress'").select("id", F.col("to_id").alias("to"), F.struct("revision", "row").alias("at"))
    return Replayed(made, made.where("effect = 'finding'").select("kind", "code", "message"), ends(gone).withColumnRenamed("end", "replacement"))


def last(value: Column | str) -> Column:
    """The latest value that there is; by revision and row."""
    value = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(value.isNotNull(), F.struct("revision", "row", value.alias("value"))))["value"]


def patches(effects: DataFrame, citations: str) -> DataFrame:
    """id, kind, name, family, attributes and citations (of the type ``citations``): all patches of an entry as one."""
    rows = effects.where("effect = 'patch'")
    heads = rows.groupBy("id").agg(*[last(c).alias(c) for c in ("kind", "name", "family", "citations")])
    by_id = F.array_sort(F.collect_list(F.struct("revision", "row", "review")))
    reviews = rows.where("review IS NOT NULL").groupBy("id").agg(F.concat(F.lit("["), F.array_join(F.transform(by_id, lambda x: x["review"]), ","), F.lit("]")).alias("reviews"))
    place = F.struct("revision", "row", "reviewed")
    own = rows.select("id", "revision", "row", F.explode("attributes").alias("key", "value"), F.lit(False).alias("reviewed"))
    noted = rows.where("review IS NOT NULL").select("id", "revision", "row", F.lit("revisionReviews").alias("key"), F.lit(None).cast("string").alias("value"), F.lit(True).alias("reviewed"))
    latest = own.unionByName(noted).groupBy("id", "key").agg(F.max_by(F.struct("value", "reviewed"), place).alias("v")).join(reviews, "id", "left")
    value = F.when(F.col("v.reviewed"), F.col("reviews")).otherwise(F.col("v.value"))
    maps = latest.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", value.alias("value"))))).alias("attributes"))
    return heads.join(maps, "id", "left").select("id", "kind", "name", "family", "attributes", F.from_json("citations", citations).alias("citations"))


def new_relations(effects: DataFrame, citations: str) -> tuple[DataFrame, DataFrame]:
    """from_id of the entries whose relations are replaced, and the new ones, RELATION rows: an entry's latest."""
    at = F.struct("revision", "row")
    heads = effects.where("effect = 'relations'").groupBy("id").agg(F.max(at).alias("at"))
    rows = effects.where("effect = 'relation'").select("id", "kind", "to_id", "citations", at.alias("at")).join(heads, ["id", "at"])
    made = rows.select(F.col("id").alias("from_id"), "kind", "to_id", F.from_json("citations", citations).alias("citations"))
    return heads.select(F.col("id").alias("from_id")), made


def apply(entries: DataFrame, relations: DataFrame, replayed: Replayed) -> tuple[DataFrame, DataFrame]:
    """The state after the revisions: entries and relations meet what has become of them in a join each."""
    kind = entries.schema["citations"].dataType.simpleString()
    after = patch_entries(entries, materialise(patches(replayed.effects, kind), "patches"))
    replaced, new = new_relations(replayed.effects, kind)
    edges = relations.join(replaced, "from_id", "left_anti").select(*relations.columns).unionByName(new)
    return suppress(after, edges, materialise(replayed.suppressed, "suppressed"))
