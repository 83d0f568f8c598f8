"""Entry validation: a registry of kinds as data, turned into expressions; one row an issue."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import is_citation


@dataclass
class Kind:
    """``attributes``: name to (type, required); types string, number, boolean, json."""

    family: str
    attributes: dict[str, tuple[str, bool]] = field(default_factory=dict)


@dataclass
class Registry:
    kinds: dict[str, Kind]
    relations: set[str] = field(default_factory=set)


def issue(code: str, path: Column | str, message: Column | str, when: Column) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(when, F.struct(F.lit(code).alias("code"), as_column(path).alias("path"), as_column(message).alias("message")))


def _of_type(json: Column, kind: str) -> Column:
    if kind == "string":
        return json.startswith('"')
    if kind == "number":
        return json.rlike(r"^-?\d")
    if kind == "boolean":
        return json.isin("true", "false")
    return F.lit(True)


def entry_issues(entries: DataFrame, registry: Registry) -> DataFrame:
    """id, code, path, message. Attributes beyond the declared ones are allowed; an unknown kind ends the check of its entry."""
    missing = [issue(f"entry.{c}_missing", c, f"entry {c} must be a non-empty string", F.coalesce(F.col(c), F.lit("")) == "") for c in ("id", "kind", "name", "family")]
    shapes = [
        issue("entry.citations_missing", "citations", "citations must be an array", F.col("citations").isNull()),
        issue("entry.attributes_missing", "attributes", "attributes must be an object", F.col("attributes").isNull()),
    ]
    bad = F.transform(F.coalesce("citations", F.expr("array()").cast(entries.schema["citations"].dataType)), lambda c, i: F.when(~is_citation(c), F.struct(F.lit("entry.citation_invalid").alias("code"), F.concat(F.lit("citations["), i, F.lit("]")).alias("path"), F.lit("citation must be cited or uncited").alias("message"))))
    known = F.col("kind").isin(*registry.kinds)
    kinds = [issue("entry.kind_unknown", "kind", F.concat(F.lit("unknown entry kind: "), F.coalesce("kind", F.lit(""))), ~F.coalesce(known, F.lit(False)))]
    by_kind: list[Column] = []
    for name, kind in registry.kinds.items():
        own = F.col("kind") == name
        by_kind.append(issue("entry.family_mismatch", "family", F.concat_ws(" ", F.lit("family"), "family", F.lit(f"does not match kind family {kind.family}")), own & (F.coalesce("family", F.lit("")) != kind.family)))
        for attribute, (type_, required) in kind.attributes.items():
            has = F.coalesce(F.map_contains_key(F.col("attributes"), F.lit(attribute)), F.lit(False))
            if required:
                by_kind.append(issue("entry.attribute_missing", f"attributes.{attribute}", f"required attribute missing: {attribute}", own & ~has))
            if type_ in ("string", "number", "boolean"):
                fits = F.coalesce(_of_type(F.element_at("attributes", F.lit(attribute)), type_), F.lit(False))
                by_kind.append(issue("entry.attribute_type", f"attributes.{attribute}", f"attribute {attribute} must be {type_}", own & has & ~fits))
    every = F.concat(F.array(*missing, *shapes, *kinds, *by_kind), bad)
    return entries.select("id", F.explode(F.filter(every, lambda x: x.isNotNull())).alias("issue")).select("id", "issue.*")


def relation_issues(relations: DataFrame, registry: Registry) -> DataFrame:
    """id (of the source), code, path, message; kinds are checked once some are registered."""
    kind, to = F.coalesce("kind", F.lit("")), F.coalesce("to_id", F.lit(""))
    path = F.concat_ws(".", F.lit("relations"), kind)
    found = [
        issue("entry.relation_kind", path, "relation kind must be a non-empty string", kind == ""),
        issue("entry.relation_kind_unknown", path, F.concat(F.lit("unknown relation kind: "), kind), (kind != "") & F.lit(bool(registry.relations)) & ~kind.isin(*(registry.relations or {""}))),
        issue("entry.relation_to", path, "relation to must be a non-empty string", to == ""),
        issue("entry.relation_citation_invalid", path, "relation citations must be cited or uncited", F.exists("citations", lambda c: ~is_citation(c))),
    ]
    return relations.select(F.col("from_id").alias("id"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("issue")).select("id", "issue.*")


def state_issues(entries: DataFrame, relations: DataFrame, registry: Registry) -> DataFrame:
    """Issues of entries and relations, and relations that lead nowhere."""
    targets = entries.select(F.col("id").alias("to_id"))
    lost = relations.join(targets, "to_id", "left_anti").select(F.col("from_id").alias("id"), F.lit("relation.target_missing").alias("code"), F.concat_ws(".", F.lit("relations"), "kind").alias("path"), F.concat(F.lit("relation target not found: "), F.coalesce("to_id", F.lit(""))).alias("message"))
    return entry_issues(entries, registry).unionByName(relation_issues(relations, registry)).unionByName(lost)
