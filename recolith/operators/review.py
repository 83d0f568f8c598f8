"""Review items: from candidates and findings, with their category, class, queue, and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import review_id_segment, review_key, source_family
from ..functions.values import citation_id

ITEM = "id string, category string, classification string, severity string, confidence string, status string, source_type string, reason string, title string, source_families array<string>, finding_code string, n_entries long, blocks_state boolean, blocks_release boolean"
QUEUES = ("blocking", "actionable", "drafted", "applied", "deferred")
SEVERITIES, STATUSES = ("high", "medium", "low"), ("open", "drafted", "applied")

# Resolutions that fit a category, best first.
RESOLUTIONS = {
    "kind_conflict": ("preserve-distinct", "source-shadow", "override-kind", "suppress"),
    "source_shadow": ("source-shadow", "preserve-distinct", "alias", "suppress"),
    "same_source_duplicate": ("suppress", "alias", "preserve-distinct"),
    "alias_candidate": ("alias", "preserve-distinct", "source-shadow", "suppress"),
    "identity_conflict": ("alias", "preserve-distinct", "source-shadow", "suppress"),
    "relation_endpoint_missing": ("source-shadow", "suppress"),
    "legal_authority_ambiguous": ("preserve-distinct", "suppress"),
    "out_of_scope_candidate": ("suppress",),
    "preserve_distinct_candidate": ("preserve-distinct", "source-shadow", "alias"),
    "source_stale_or_failed": ("suppress", "source-shadow"),
    "incomplete_entry": ("suppress", "override-kind"),
}


def candidate_category(stale: Column | None = None) -> Column:
    has = lambda r: F.array_contains("risks", r)
    of = F.col("review_category")
    return (
        F.when(has("kind_conflict") | has("family_conflict"), "kind_conflict")
        .when(F.lit(False) if stale is None else stale, "source_stale_or_failed")
        .when(of == "same_source_duplicate", "same_source_duplicate")
        .when(of == "relation_endpoint_review", "relation_endpoint_missing")
        .when(F.col("reason") == "shared_legal_locator", "legal_authority_ambiguous")
        .when(of == "source_shadow", "source_shadow")
        .when(F.col("reason") == "same_normalized_name", "identity_conflict")
        .otherwise("alias_candidate")
    )


def from_candidates(packets: DataFrame, directory_family: str = "open_dc", stale: Column | None = None) -> DataFrame:
    """ITEM rows. ``stale``: whether a duplicate of one source is a stale page."""
    rows = packets.withColumn("category", candidate_category(stale))
    own = F.col("category").isin("same_source_duplicate", "source_stale_or_failed") & (F.size("source_families") == 1) & F.array_contains("source_families", directory_family)
    classification = F.when(F.col("category") == "legal_authority_ambiguous", "legal_authority_ambiguity").when(F.col("category") == "relation_endpoint_missing", "compiler_rule_bug").when(own, "source_ingestion_bug").otherwise("curation_conflict")
    none = F.lit(None).cast("string")
    title = F.concat(F.replace("category", F.lit("_"), F.lit(" ")), F.lit(": "), F.col("match_key"))
    release = (F.col("severity") == "high") | (F.col("category") == "legal_authority_ambiguous")
    return rows.select("id", "category", classification.alias("classification"), "severity", "confidence", F.lit("open").alias("status"), F.lit("reconciliation_candidate").alias("source_type"), "reason", title.alias("title"), "source_families", none.alias("finding_code"), F.col("n").alias("n_entries"), F.lit(False).alias("blocks_state"), release.alias("blocks_release"))


def finding_category(code: Column, kind: Column) -> Column:
    """By parts of the code, the first that is there; null for findings that ask for no decision."""
    has = lambda *parts: code.rlike("|".join(parts))
    return (
        F.when(has("stale_or_failed"), "source_stale_or_failed")
        .when(has("not_promoted", "promotion"), "out_of_scope_candidate")
        .when(has("relation_target", "relation_source"), "relation_endpoint_missing")
        .when(has("legal"), "legal_authority_ambiguous")
        .when(has("missing", "invalid"), "incomplete_entry")
        .when(kind == "conflict", "identity_conflict")
    )


def finding_id() -> Column:
    """Of the columns of FINDING: code, message and what is cited."""
    cited = F.when(F.col("citation").isNotNull(), F.concat(F.lit(":"), review_id_segment(citation_id(F.col("citation"), "|"), 60))).otherwise("")
    return F.concat(F.lit("finding:"), review_key(F.col("code")), F.lit(":"), review_key(F.col("message")), cited)


def from_findings(findings: DataFrame) -> DataFrame:
    rows = findings.withColumn("category", finding_category(F.col("code"), F.col("kind"))).where("category IS NOT NULL")
    code, category = F.col("code"), F.col("category")
    classification = F.when(category == "legal_authority_ambiguous", "legal_authority_ambiguity").when(category == "out_of_scope_candidate", "out_of_scope").when(code.rlike(r"^(?:\w+\.)?(?:reader|interpreter)"), "source_ingestion_bug").when(code.startswith("compiler."), "compiler_rule_bug").otherwise("curation_conflict")
    severity = F.when(category == "source_stale_or_failed", "low").when(F.col("kind") == "conflict", "high").otherwise("medium")
    families = F.when(F.col("citation.source").isNotNull(), F.array(source_family(F.col("citation.source")))).otherwise(F.array().cast("array<string>"))
    none = F.lit(None).cast("string")
    return rows.select(finding_id().alias("id"), category.alias("category"), classification.alias("classification"), severity.alias("severity"), F.lit("medium").alias("confidence"), F.lit("open").alias("status"), F.lit("finding").alias("source_type"), none.alias("reason"), F.concat(F.replace("category", F.lit("_"), F.lit(" ")), F.lit(": "), code).alias("title"), families.alias("source_families"), code.alias("finding_code"), F.lit(0).cast("long").alias("n_entries"), (F.col("kind") == "conflict").alias("blocks_state"), (~category.isin("source_stale_or_failed", "out_of_scope_candidate")).alias("blocks_release"))


def resolutions(category: Column) -> Column:
    table = F.create_map(*[x for k, v in RESOLUTIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.element_at(table, category)


def blocks_output() -> Column:
    return (F.col("status") == "open") & (F.col("blocks_state") | (F.col("blocks_release") & (F.col("n_entries") > 0)))


def queue(broad: Column | None = None) -> Column:
    """``broad``: items of a directory page that many entries share."""
    later = (F.col("classification") == "out_of_scope") | F.col("category").isin("out_of_scope_candidate", "source_stale_or_failed")
    return F.when(F.col("status").isin("applied", "drafted"), F.col("status")).when(blocks_output(), "blocking").when(later | (F.lit(False) if broad is None else broad), "deferred").otherwise("actionable")


def boundary_items(entries: DataFrame, source_id: Column) -> DataFrame:
    """Entries whose source id ends, behind a slash, in another's: id, sibling, suffix. An equi self-join."""
    rows = entries.select("id", F.upper(source_id).alias("sid")).where("sid IS NOT NULL")
    slashed = rows.where(F.contains("sid", F.lit("/"))).withColumn("suffix", F.element_at(F.split("sid", "/"), -1)).where("suffix <> ''")
    return slashed.join(rows.select(F.col("id").alias("sibling"), F.col("sid").alias("suffix")), "suffix").where("id <> sibling").select("id", "sibling", "suffix")


def queue_counts(items: DataFrame) -> DataFrame:
    """queue and n, zeros included."""
    return zero_filled(items.select(queue().alias("queue")), "queue", QUEUES)


def zero_filled(rows: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows by value, a row for each of ``values``."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    every = rows.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return every.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def deferred_groups(items: DataFrame) -> DataFrame:
    """category, label, n and the first item's id, in the order of review, of deferred items; most items first."""
    label = F.coalesce(F.when(F.col("source_type") == "finding", F.col("finding_code")), F.nullif(F.array_join("source_families", ", "), F.lit("")), F.col("classification"))
    rows = items.where(queue() == "deferred").withColumn("label", label)
    return rows.groupBy("category", "label").agg(F.count("*").alias("n"), F.min_by("id", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(review_order())])).alias("sample_id")).orderBy(F.desc("n"), "category", "label")


def review_order() -> list[Column]:
    rank = lambda c, values: F.coalesce(F.array_position(F.array(*map(F.lit, values)), F.col(c)), F.lit(99))
    return [rank("severity", SEVERITIES), rank("status", STATUSES), F.col("category"), F.col("id")]


def next_item(items: DataFrame) -> DataFrame:
    """The first blocking item, else the first actionable one."""
    rows = items.withColumn("queue", queue()).where(F.col("queue").isin("blocking", "actionable"))
    return rows.orderBy(F.col("queue") == "actionable", *review_order()).limit(1)


def inbox(items: DataFrame, status: str | None = None, queues: tuple[str, ...] = ("blocking", "actionable")) -> DataFrame:
    rows = items.withColumn("queue", queue()).where(F.col("queue").isin(*queues))
    return rows.where(F.col("status") == status) if status else rows


def superseded(items: DataFrame, suppressed: DataFrame) -> DataFrame:
    """item_id and revision_id of items (item_id, ids) that keep apart an entry that a revision (revision_id, target_id) suppresses."""
    return items.select("item_id", F.explode("ids").alias("target_id")).join(suppressed, "target_id").select("item_id", "revision_id").distinct()


def revised(items: DataFrame, tracked: DataFrame, drafted: DataFrame, broad: DataFrame | None = None) -> DataFrame:
    """Items with their status after revisions: applied if a tracked one matches, else drafted if a draft does; what is applied
    blocks nothing. ``tracked`` and ``drafted``: item_id and revision_id (``revisions.item_revisions``). Items of ``broad`` (item_id:
    shared directory pages) are never applied and block no release."""
    flag = lambda rows, name: rows.select(F.col("item_id").alias("id")).distinct().withColumn(name, F.lit(True))
    none = items.select(F.col("id").alias("item_id")).limit(0)
    rows = items.join(flag(tracked, "__applied"), "id", "left").join(flag(drafted, "__drafted"), "id", "left").join(flag(none if broad is None else broad, "__broad"), "id", "left").na.fill(False, ["__applied", "__drafted", "__broad"])
    applied = F.col("__applied") & ~F.col("__broad")
    changed = {
        "status": F.when(applied, "applied").when(F.col("__drafted"), "drafted").otherwise("open"),
        "blocks_state": F.col("blocks_state") & ~applied,
        "blocks_release": F.col("blocks_release") & ~applied & ~F.col("__broad"),
    }
    return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in items.columns])


def stale_packets(rows: DataFrame, source: str, weak_keys: tuple[str, ...] = ("description", "shortName", "sourceOpenDcSlug", "sourceOpenDcUrl")) -> DataFrame:
    """reason and match_key of blocks of members (``candidates.members``) that all come from the source, where some member
    is weak (no relations, weak attributes alone, at most a boilerplate description) and another has substance."""
    keys = F.map_keys("attributes")
    boilerplate = F.coalesce(F.try_element_at("attributes", F.lit("description")), F.lit('"report website problems to:"')).rlike(r'(?i)^"\s*(?:report website problems to:|this website requires a browser feature called javascript)')
    weak = ~F.col("related") & F.forall(keys, lambda k: k.isin(*weak_keys)) & boilerplate
    substance = F.col("related") | F.exists(keys, lambda k: k.rlike("(?i)^(?:enabling|legal)")) | F.coalesce(F.try_element_at("attributes", F.lit("officialUrl")).startswith('"'), F.lit(False))
    heads = rows.groupBy("reason", "match_key").agg(F.bool_and(F.array_contains("sources", source)).alias("own"), F.bool_or(weak).alias("weak"), F.bool_or(~weak & substance).alias("substance"))
    return heads.where("own AND weak AND substance").select("reason", "match_key")


def item_records(items: DataFrame, records: DataFrame) -> DataFrame:
    """Records that items cite: ``items`` have item_id and citations; found tells whether the record is there."""
    cited = items.select("item_id", F.explode("citations").alias("c")).where("c.source IS NOT NULL").select("item_id", F.col("c.source").alias("source"), F.col("c.source_record_id").alias("key")).distinct()
    rows = records.select("source", "key", "payload", F.lit(True).alias("found"))
    return cited.join(rows, ["source", "key"], "left").na.fill(False, ["found"])
