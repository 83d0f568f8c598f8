"""Records to fragments: validity, keys, lookups, parents, and flat-maps of one record to several fragments.

Each interpreter is a projection with its findings beside it; lookups are joins against tables of distinct keys, whose
picks (first or last wins) are explicit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import candidate_names, entity_slug, classify, lookup_key, member_title
from ..functions.values import cite, is_object, json_string, quoted
from ..model import FINDING
from .candidates import stale_duplicates


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records whose payload is an object, and findings for the others."""
    ok = is_object(F.col("payload"))
    return records.where(ok), invalid(records.where(~ok))


def invalid(records: DataFrame) -> DataFrame:
    """Findings for records whose payload is no object."""
    return records.select(F.lit("warn").alias("kind"), F.when(F.col("payload").isNull(), "interpreter.invalid_record").otherwise("interpreter.invalid_payload").alias("code"), F.concat_ws(":", "source", "key").alias("message"), cite(F.col("source"), F.col("key")).alias("citation"))


def keyed(records: DataFrame, id_keys: tuple[str, ...], name_keys: tuple[str, ...]) -> DataFrame:
    """``records`` with source_id and name, the first of the payload's keys that is there."""
    return records.withColumn("source_id", json_string(F.col("payload"), *id_keys)).withColumn("name", json_string(F.col("payload"), *name_keys))


def name_lookup(entries: DataFrame) -> DataFrame:
    """key and id: normalised names, then short names; the first entry wins. ``entries``: id, name, short_name, seq."""
    both = entries.select("id", "seq", F.posexplode(F.array("name", "short_name")).alias("form", "text")).withColumn("key", lookup_key(F.col("text"))).where("key <> ''")
    return both.groupBy("key").agg(F.min_by("id", F.struct("seq", "form")).alias("id"))


def id_lookup(entries: DataFrame) -> DataFrame:
    """source_id and id; the last entry wins."""
    return entries.where("source_id IS NOT NULL").groupBy("source_id").agg(F.max_by("id", "seq").alias("id"))


def resolve(rows: DataFrame, by_id: DataFrame, by_name: DataFrame, ref: str, label: str, fallback: str) -> DataFrame:
    """``rows`` with resolved: the entry of the id in ``ref`` (raw under ``fallback`` if unknown), else of the name in ``label``, else the label itself if it looks like an id."""
    r = rows.join(by_id.select(F.col("source_id").alias("__ref"), F.col("id").alias("__by_id")), F.col(ref) == F.col("__ref"), "left")
    r = r.withColumn("__key", lookup_key(F.col(label))).join(by_name.select(F.col("key").alias("__key"), F.col("id").alias("__by_name")), "__key", "left")
    raw = lambda c: F.concat(F.lit(fallback), c)
    resolved = F.when(F.col(ref).isNotNull(), F.coalesce("__by_id", raw(F.col(ref)))).otherwise(F.coalesce("__by_name", F.when(F.col(label).rlike(r"^[A-Za-z0-9._:-]+$"), raw(F.col(label)))))
    return r.select(*rows.columns, resolved.alias("resolved"))


def parents(rows: DataFrame, own: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """id and parent_id of rows whose parent is another row's ``own`` value; and the ids whose parent isn't there. A row is never its own parent."""
    known = rows.groupBy(F.col(own).alias("__own")).agg(F.min("id").alias("parent_id"))
    joined = rows.where(F.col(parent).isNotNull()).join(known, F.col(parent) == F.col("__own"), "left")
    return joined.where("parent_id IS NOT NULL AND parent_id <> id").select("id", "parent_id"), joined.where("parent_id IS NULL").select("id", F.col(parent).alias("parent"))


def id_collisions(rows: DataFrame) -> DataFrame:
    """id and n: ids that several source records give."""
    return rows.groupBy("id").agg(F.count_distinct("source_id").alias("n")).where("n > 1")


def enrich_directory(directory: DataFrame, by_name: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Directory rows (name, url, pos) matched on their candidate names, first candidate first. Of an entry the first
    url wins: id and url; and warnings: rows without entry, and later rows with another url (name, url, problem)."""
    tries = directory.select("name", "url", "pos", F.posexplode(candidate_names(F.col("name"))).alias("try", "candidate")).withColumn("key", lookup_key(F.col("candidate")))
    found = tries.join(by_name, "key").groupBy("name", "url", "pos").agg(F.min_by("id", "try").alias("id"))
    first = found.groupBy("id").agg(F.min_by("url", "pos").alias("first_url"))
    other = found.join(first, "id").where("url <> first_url").select("name", "url", F.lit("conflicting_url").alias("problem"))
    lost = directory.join(found.select("pos"), "pos", "left_anti").select("name", "url", F.lit("unmatched").alias("problem"))
    return first.select("id", F.col("first_url").alias("url")), lost.unionByName(other)


def with_fallback_name(rows: DataFrame, prefix: str) -> DataFrame:
    """Missing names become the prefix and the source id; named tells."""
    return rows.withColumn("named", F.col("name").isNotNull()).withColumn("name", F.coalesce("name", F.concat(F.lit(prefix), F.col("source_id"))))


def area_and_seat(rows: DataFrame) -> DataFrame:
    """Two entry fragments a record (source_id, name, holder): the area and its seat, without a holder where it is vacant. Contact columns are never read."""
    holder = F.when(F.upper(F.trim("holder")) != "VACANT", F.col("holder"))
    own = F.map_from_arrays(F.array(F.lit("sourceSmdId")), F.array(quoted(F.col("source_id"))))
    seat = F.when(holder.isNotNull(), F.map_concat(own, F.map_from_arrays(F.array(F.lit("currentHolderName")), F.array(quoted(holder))))).otherwise(own)
    area_id, seat_id = F.concat(F.lit("smd:"), F.col("source_id")), F.concat(F.lit("anc_commissioner_seat:"), F.col("source_id"))
    made = lambda emit, id_, kind, family, name, attributes: F.struct(F.lit(emit).alias("emit"), id_.alias("provisional_id"), F.lit(kind).alias("kind"), F.lit(family).alias("family"), name.alias("name"), attributes.alias("attributes"))
    both = F.array(made(0, area_id, "smd", "area", F.col("name"), own), made(1, seat_id, "anc_commissioner_seat", "position", F.concat(F.col("name"), F.lit(" Commissioner")), seat))
    return rows.select("source", F.col("source_id").alias("source_record_id"), F.explode(both).alias("f")).select("source", "source_record_id", "f.*")


def area_edges(rows: DataFrame) -> DataFrame:
    """contains (commission to area) and represents (seat to area) of the records (source_id, anc_id)."""
    area = F.concat(F.lit("smd:"), F.col("source_id"))
    edges = F.array(F.struct(F.concat(F.lit("anc:"), F.col("anc_id")).alias("from_id"), F.lit("contains").alias("kind"), area.alias("to_id")), F.struct(F.concat(F.lit("anc_commissioner_seat:"), F.col("source_id")).alias("from_id"), F.lit("represents").alias("kind"), area.alias("to_id")))
    return rows.select(F.explode(edges).alias("e")).select("e.*").where("from_id IS NOT NULL AND to_id IS NOT NULL")


def members(rows: DataFrame) -> DataFrame:
    """Roster rows (name, slug, title) with office, ward_number, member_id and office_id."""
    t = member_title(F.col("title"))
    office_id = F.concat_ws(":", F.lit("elected_office"), F.when(t["office"] == "ward", F.concat(F.lit("ward-"), t["ward_number"])).otherwise(t["office"]))
    return rows.select("*", t["office"].alias("office"), t["ward_number"].alias("ward_number"), F.concat(F.lit("councilmember:"), F.col("slug")).alias("member_id"), F.when(t["office"].isNotNull(), office_id).alias("office_id"))


def committee_edges(committees: DataFrame, roster: DataFrame, whole: str = "committee of the whole") -> DataFrame:
    """from_id, kind, to_id of committees (id, name, chair, members: arrays of member ids): chairs are members too, and the
    committee of the whole has everyone of the roster (member_id) who isn't there already."""
    listed = committees.select(F.explode("members").alias("from_id"), F.lit("member_of").alias("kind"), F.col("id").alias("to_id"))
    chairs = committees.where("chair IS NOT NULL").select(F.explode(F.array(F.struct("chair", F.lit("chairs").alias("kind")), F.struct("chair", F.lit("member_of").alias("kind")))).alias("c"), "id").select(F.col("c.chair").alias("from_id"), "c.kind", F.col("id").alias("to_id"))
    there = listed.unionByName(chairs)
    # there is one committee of that name, so its id is a constant
    found = committees.where(F.lower("name") == whole).agg(F.min("id").alias("id")).first()["id"]
    if found is None:
        return there.distinct()
    everyone = roster.select(F.col("member_id").alias("from_id"), F.lit("member_of").alias("kind"), F.lit(found).alias("to_id"))
    return there.unionByName(everyone.join(there, ["from_id", "kind", "to_id"], "left_anti")).distinct()


def entry_id(kind: str, name: Column, folded: Column | None = None) -> Column:
    return F.concat(F.lit(f"{kind}:"), entity_slug(name, folded))


def no_findings(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], FINDING)


def legal_artifacts(rows: DataFrame, authority: Column, rejected: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, locator) to authority entries, authorized_by edges, and locators that stay citations; rejected ones go."""
    with_authority = rows.withColumn("a", authority).withColumn("rejected", F.coalesce(rejected, F.lit(False)))
    found = with_authority.where("a IS NOT NULL")
    entries = found.groupBy("a.authority_type", "a.canonical_url").agg(F.min("a.id").alias("id"), F.min("a.locator").alias("locator"))
    return entries.select("id", "locator", "authority_type", "canonical_url"), found.select(F.col("id").alias("from_id"), F.lit("authorized_by").alias("kind"), F.col("a.id").alias("to_id")).distinct(), with_authority.where("a IS NULL AND NOT rejected").select("id", "locator")


def public_bodies(rows: DataFrame, trusted: DataFrame, rules: list[tuple[str, str]], corrections: dict[str, str] | None = None, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Bodies (slug, name, substantive) with kind, id, shadow and stale. The kind is by words of the name, or corrected by slug; a trusted
    entry (kind, name, id, seq) of the same kind and name gives its id, the first one; else it is the kind's with the slug.
    Of bodies that share a name those without substance are stale if another has some."""
    kind = classify(F.col("name"), rules, "public_body")
    if corrections:
        kind = F.coalesce(F.create_map(*[F.lit(x) for kv in corrections.items() for x in kv])[F.col("slug")], kind)
    kept = rows.where(~F.col("slug").isin(*excluded)) if excluded else rows
    known = trusted.groupBy(F.col("kind").alias("__kind"), lookup_key(F.col("name")).alias("__key")).agg(F.min_by("id", "seq").alias("__id"))
    typed = kept.withColumn("kind", kind).withColumn("__k", lookup_key(F.col("name")))
    joined = typed.join(known, (typed["kind"] == known["__kind"]) & (typed["__k"] == known["__key"]), "left")
    named = joined.select(*rows.columns, "kind", F.coalesce("__id", F.concat_ws(":", "kind", "slug")).alias("id"), F.col("__id").isNotNull().alias("shadow"))
    return stale_duplicates(named, lookup_key(F.col("name")), F.col("substantive"))


def deferred_ids(rows: DataFrame, ref: str) -> tuple[DataFrame, DataFrame]:
    """Rows with plain ids, and those with a slash, which wait for review."""
    slashed = F.contains(ref, F.lit("/"))
    return rows.where(~slashed), rows.where(slashed)


def office_edges(offices: DataFrame, by_key: DataFrame, by_name: DataFrame) -> DataFrame:
    """from_id, kind and to_id of offices (id, parent_key, relation_kind, agency): to the parent of that key, and to the agency of that name."""
    up = offices.where("parent_key IS NOT NULL").join(by_key.select(F.col("key").alias("parent_key"), F.col("id").alias("to_id")), "parent_key").select(F.col("id").alias("from_id"), F.coalesce("relation_kind", F.lit("reports_to")).alias("kind"), "to_id")
    named = offices.withColumn("key", lookup_key(F.col("agency"))).join(by_name.select("key", F.col("id").alias("to_id")), "key").select(F.col("id").alias("from_id"), F.lit("part_of").alias("kind"), "to_id")
    return up.unionByName(named).where("from_id <> to_id").distinct()
