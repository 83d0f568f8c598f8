"""Review items as one plan: candidates, boundary items, findings and tracked revisions, with their status after revisions.

Items are slim rows; what they concern is a table of its own, (item_id, type, key): ids of entries, identities of citations. Revisions meet
items by an equi-join on these keys, so that an item of many entries is many rows and no long cell.

Defined cases: items that share an id are one; a revision that no item of another origin has the id of gives an item of its own, applied; draft revisions
change the status alone; empty inputs give empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import review_key, source_family
from ..functions.values import citation_id, unquoted
from ..operators import candidates as ca
from ..operators import review as re_
from ..stages import materialise

KEYS = "item_id string, type string, key string"
#: A directory page that this many entries share says nothing about any of them.
BROAD_ENTRIES = 10


@dataclass
class Review:
    """``items`` (ITEM), their ``keys``, the pairs ``tracked`` and ``drafted`` (item_id, revision_id), and those that are ``superseded``."""

    items: DataFrame
    keys: DataFrame
    tracked: DataFrame
    drafted: DataFrame
    superseded: DataFrame


def id_keys(rows: DataFrame) -> DataFrame:
    """KEYS of rows (item_id, entry_id)."""
    return rows.select("item_id", F.lit("id").alias("type"), F.col("entry_id").alias("key"))


def citation_keys(rows: DataFrame) -> DataFrame:
    """KEYS of rows (item_id, c: a citation)."""
    return rows.where("c IS NOT NULL").select("item_id", F.lit("cite").alias("type"), citation_id(F.col("c"), "|").alias("key"))


def boundary_review(entries: DataFrame, kind: str, id_attribute: str, page_attribute: str) -> tuple[DataFrame, DataFrame]:
    """Items of profiles whose source id ends, behind a slash, in another entry's; and (item_id, entry_id)."""
    text = lambda a: unquoted(F.try_element_at("attributes", F.lit(a)))
    of_kind = entries.where(F.col("kind") == kind)
    pairs = re_.boundary_items(of_kind, text(id_attribute))
    full = of_kind.where(text(page_attribute).isNotNull()).select("id", text(id_attribute).alias("full"))
    found = pairs.join(full, "id").select(F.concat_ws(":", F.lit("profile_boundary"), review_key(F.col("full")), review_key(F.col("suffix"))).alias("item_id"), "full", "suffix", F.explode(F.array("id", "sibling")).alias("entry_id")).distinct()
    cited = found.join(entries.select(F.col("id").alias("entry_id"), "citations"), "entry_id").select("item_id", "full", "suffix", F.explode_outer("citations.source").alias("source"))
    heads = cited.groupBy("item_id", "full", "suffix").agg(F.array_sort(F.collect_set(source_family(F.col("source")))).alias("source_families"))
    none, no = F.lit(None).cast("string"), F.lit(False)
    title = F.concat(F.lit("identity conflict: "), F.col("full"), F.lit(" vs "), F.col("suffix"))
    items = heads.select(F.col("item_id").alias("id"), F.lit("identity_conflict").alias("category"), F.lit("curation_conflict").alias("classification"), F.lit("medium").alias("severity"), F.lit("medium").alias("confidence"), F.lit("open").alias("status"), F.lit("reconciliation_candidate").alias("source_type"), none.alias("reason"), title.alias("title"), "source_families", none.alias("finding_code"), F.lit(2).cast("long").alias("n_entries"), no.alias("blocks_state"), no.alias("blocks_release"))
    return items, found.select("item_id", "entry_id")


def patch_facts(revisions: DataFrame) -> DataFrame:
    """``revisions`` with suppress, decision, others (ids that the review names), from the patch."""
    v = F.try_parse_json("patch")
    related = F.coalesce(F.try_variant_get(v, "$.review.relatedEntryIds", "array<string>"), F.array().cast("array<string>"))
    others = F.array_compact(F.concat(related, F.array(F.try_variant_get(v, "$.review.canonicalEntryId", "string"))))
    return revisions.select("*", F.coalesce(F.try_variant_get(v, "$.suppress", "boolean"), F.lit(False)).alias("suppress"), F.try_variant_get(v, "$.review.decision", "string").alias("decision"), F.coalesce(others, F.array().cast("array<string>")).alias("others"))


def revision_keys(facts: DataFrame) -> DataFrame:
    """revision_id, type, key: the target, the ids that the review names, and the evidence."""
    ids = facts.select(F.col("id").alias("revision_id"), F.explode(F.concat(F.array("target_id"), "others")).alias("key")).select("revision_id", F.lit("id").alias("type"), "key")
    cited = facts.select(F.col("id").alias("revision_id"), F.explode("evidence").alias("c")).where("c IS NOT NULL").select("revision_id", F.lit("cite").alias("type"), citation_id(F.col("c"), "|").alias("key"))
    return ids.unionByName(cited).where("key IS NOT NULL").distinct()


def from_revisions(facts: DataFrame) -> DataFrame:
    """ITEM rows of tracked revisions, applied: suppressions, review decisions, and relations that lead elsewhere."""
    category = (
        F.when(F.col("suppress"), "source_shadow").when(F.col("decision") == "preserve_distinct", "preserve_distinct_candidate").when(F.col("decision") == "source_shadow", "source_shadow")
        .when(F.col("decision") == "alias", "alias_candidate").when(F.col("decision").isNull() & (F.col("target_kind") == "relation"), "relation_endpoint_missing")
    )
    rows = facts.withColumn("category", category).where("category IS NOT NULL")
    broken = F.col("category") == "relation_endpoint_missing"
    none, no = F.lit(None).cast("string"), F.lit(False)
    families = F.coalesce(F.array_sort(F.array_distinct(F.transform(F.filter("evidence", lambda c: c["source"].isNotNull()), lambda c: source_family(c["source"])))), F.array().cast("array<string>"))
    return rows.select(
        F.concat(F.lit("tracked_revision:"), F.col("id")).alias("id"), "category", F.when(broken, "compiler_rule_bug").otherwise("curation_conflict").alias("classification"), F.when(broken | (F.col("category") == "source_shadow"), "high").otherwise("medium").alias("severity"),
        F.lit("high").alias("confidence"), F.lit("applied").alias("status"), F.lit("tracked_revision").alias("source_type"), none.alias("reason"), F.concat(F.replace("category", F.lit("_"), F.lit(" ")), F.lit(": "), F.col("id")).alias("title"),
        families.alias("source_families"), none.alias("finding_code"), F.size(F.array_distinct(F.concat(F.array("target_id"), "others"))).cast("long").alias("n_entries"), no.alias("blocks_state"), no.alias("blocks_release"),
    )


def matches(keys: DataFrame, revisions: DataFrame) -> DataFrame:
    """item_id and revision_id that share a key."""
    return keys.join(revisions, ["type", "key"]).select("item_id", "revision_id").distinct()


def generate(
    entries: DataFrame,
    relations: DataFrame,
    findings: DataFrame,
    tracked: DataFrame | None = None,
    drafts: DataFrame | None = None,
    no_decision: tuple[str, ...] = (),
    prefix: str = "",
    profiles: tuple[str, str, str] = ("anc", "sourceAncId", "sourceOancProfileUrl"),
    directory_source: str = "open_dc.public_bodies",
    directory_url: str | None = None,
) -> Review:
    """Items of the four origins. ``tracked``: REVISION rows. ``drafts``: the same and source_review_item_id. ``no_decision``: codes of findings that ask
    for none. ``directory_url``: the page whose shared-url item is broad from ``BROAD_ENTRIES`` entries on."""
    findings = materialise(findings, "findings")
    rows = ca.blocks(entries, relations, prefix)
    packets, members = ca.packets_of(rows, relations, prefix)
    # only blocks of the directory's entries alone can be stale, so theirs are all the attributes that are looked at
    own = rows.groupBy("reason", "match_key").agg(F.bool_and(F.array_contains("sources", directory_source)).alias("own")).where("own").drop("own")
    directory = rows.join(own, ["reason", "match_key"], "left_semi").join(entries.select("id", "attributes"), "id")
    stale_blocks = re_.stale_packets(directory, directory_source).withColumn("__stale", F.lit(True))
    packets = materialise(packets.join(stale_blocks, ["reason", "match_key"], "left").na.fill(False, ["__stale"]), "packets")
    members = materialise(members, "packet-members")
    found = re_.from_candidates(packets, source_family(F.lit(directory_source)), F.col("__stale"))
    bounds, bound_entries = boundary_review(entries, prefix + profiles[0], profiles[1], profiles[2])
    decided = findings.where(~F.col("code").isin(*no_decision)) if no_decision else findings
    said = re_.from_findings(decided).dropDuplicates(["id"])
    items = materialise(found.unionByName(bounds).unionByName(said).dropDuplicates(["id"]), "review-items")

    affected = members.select(F.col("packet_id").alias("item_id"), "entry_id").unionByName(bound_entries)
    cited = affected.join(entries.select(F.col("id").alias("entry_id"), F.explode("citations").alias("c")), "entry_id").select("item_id", "c")
    of_findings = decided.where("citation IS NOT NULL").select(re_.finding_id().alias("item_id"), F.col("citation").alias("c"))
    keys = materialise(id_keys(affected).unionByName(citation_keys(cited)).unionByName(citation_keys(of_findings)).distinct(), "review-keys")

    none = items.select(F.col("id").alias("item_id"), F.lit("").alias("revision_id")).limit(0)
    by_tracked, by_draft, over = none, none, none
    broad = none.select("item_id")
    if directory_url is not None:
        cites_page = cited.where(F.col("c.url") == directory_url).select("item_id").distinct()
        broad = items.where((F.col("reason") == ca.URL) & (F.col("category") == "source_shadow") & (F.col("confidence") == "low") & (F.col("n_entries") >= BROAD_ENTRIES)).select(F.col("id").alias("item_id")).join(cites_page, "item_id", "left_semi")
    if drafts is not None:
        own = drafts.where("source_review_item_id IS NOT NULL").select(F.col("source_review_item_id").alias("item_id"), F.col("id").alias("revision_id"))
        by_draft = matches(keys, revision_keys(patch_facts(drafts))).unionByName(own).distinct()
    if tracked is not None:
        facts = materialise(patch_facts(tracked), "tracked")
        by_tracked = materialise(matches(keys, revision_keys(facts)), "tracked-items")
    rows = re_.revised(items, by_tracked, by_draft, broad)
    if tracked is not None:
        own_items = from_revisions(facts).join(items.select("id"), "id", "left_anti")
        rows = rows.unionByName(own_items.select(*rows.columns))
        own_keys = facts.select(F.concat(F.lit("tracked_revision:"), F.col("id")).alias("item_id"), F.explode(F.concat(F.array("target_id"), "others")).alias("key")).select("item_id", F.lit("id").alias("type"), "key")
        keys = keys.unionByName(own_keys.join(own_items.select(F.col("id").alias("item_id")), "item_id", "left_semi")).distinct()
        apart = rows.where("status = 'applied' AND category = 'preserve_distinct_candidate'").select(F.col("id").alias("item_id"))
        gone = facts.where("suppress").select(F.col("target_id").alias("key"), F.col("id").alias("revision_id"))
        over = keys.where("type = 'id'").join(apart, "item_id", "left_semi").join(gone, "key").select("item_id", "revision_id").distinct()
    return Review(rows, keys, by_tracked, by_draft, over)


def posture(review: Review, broad: Column | None = None) -> DataFrame:
    """section (queue, category, status) and label with n: queues and statuses with their zeros."""
    rows = review.items.withColumn("queue", re_.queue(broad))
    queues = re_.zero_filled(rows.select("queue"), "queue", re_.QUEUES).withColumnRenamed("queue", "label").withColumn("section", F.lit("queue"))
    statuses = re_.zero_filled(rows.select("status"), "status", re_.STATUSES).withColumnRenamed("status", "label").withColumn("section", F.lit("status"))
    categories = rows.groupBy(F.col("category").alias("label")).agg(F.count("*").alias("n")).withColumn("section", F.lit("category"))
    return queues.unionByName(statuses).unionByName(categories).select("section", "label", "n")
