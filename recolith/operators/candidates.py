"""Duplicate candidates: blocks of entries that share a key, their risks, and the noise among them.

An entry gives keys of three sorts; a block of two entries or more is a packet. Blocks are never collected: what a
packet says comes from aggregates over its members (kinds, families and sources are sets of a registry's size), and
members stand in a table of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_name, source_family, stable_key
from ..functions.url import canonical_url, is_url_key, looks_like_url
from ..functions.values import unquoted
from ..stages import materialise
from .graph import listed

PLACES = ("officialUrl", "sourcePageUrl", "sourceDiscoveryPageUrl", "webUrl", "sourceOancProfileUrl")
NAME, URL, LOCATOR = "same_normalized_name", "shared_url", "shared_legal_locator"


def entry_sources(entries: DataFrame, relations: DataFrame) -> DataFrame:
    """id and source of every citation, relations' included; distinct."""
    own = entries.select("id", F.explode("citations.source").alias("source"))
    edges = relations.select(F.col("from_id").alias("id"), F.explode("citations.source").alias("source"))
    return own.unionByName(edges).where("source IS NOT NULL").distinct()


def name_keys() -> Column:
    return F.array(normalize_name(F.col("name")))


def url_keys() -> Column:
    """Addresses in attributes and citations."""
    texts = F.transform(F.map_entries("attributes"), lambda e: F.struct(e["key"].alias("key"), unquoted(e["value"]).alias("text")))
    urls = F.filter(texts, lambda e: looks_like_url(e["text"]) | (e["text"].isNotNull() & is_url_key(e["key"])))
    return F.concat(F.transform(urls, lambda e: canonical_url(e["text"])), F.transform(F.filter(F.col("citations.url"), lambda u: u.isNotNull()), lambda u: canonical_url(u)))


def locator_keys() -> Column:
    return F.transform(F.filter(F.col("citations.locator"), lambda x: x.isNotNull()), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))


#: What entries are blocked by: reasons, and the keys of an entry as an array over its columns. Callers may give others, or more.
KEYERS: dict[str, Callable[[], Column]] = {NAME: name_keys, URL: url_keys, LOCATOR: locator_keys}


def block_keys(entries: DataFrame, keyers: Mapping[str, Callable[[], Column]] = KEYERS) -> DataFrame:
    """reason, match_key, id: distinct."""
    keyed = lambda reason, keys: F.transform(keys, lambda k: F.struct(F.lit(reason).alias("reason"), k.alias("match_key")))
    every = F.concat(*[keyed(reason, keys()) for reason, keys in keyers.items()])
    return entries.select("id", F.explode(every).alias("k")).select("k.reason", "k.match_key", "id").where("match_key IS NOT NULL AND match_key <> ''").distinct()


def shared_keys(keys: DataFrame) -> DataFrame:
    """Keys of blocks of two and more: most keys are one entry's, and need no facts."""
    keys = materialise(keys, "block-keys")
    shared = keys.groupBy("reason", "match_key").agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    return keys.join(shared, ["reason", "match_key"], "left_semi")


def members(entries: DataFrame, relations: DataFrame, carry: tuple[str, ...] = ("name", "attributes"), keyers: Mapping[str, Callable[[], Column]] = KEYERS) -> DataFrame:
    """reason, match_key, id, and what the packets look at: family, kind, related (has relations), sources; and the columns ``carry`` of
    entries, which come once a block key."""
    sources = entry_sources(entries, relations).groupBy("id").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    related = relations.select(F.col("from_id").alias("id")).distinct().withColumn("related", F.lit(True))
    facts = entries.select("id", "family", "kind", *carry).join(sources, "id", "left").join(related, "id", "left")
    facts = facts.withColumn("sources", F.coalesce("sources", F.array().cast("array<string>"))).withColumn("related", F.coalesce("related", F.lit(False)))
    return shared_keys(block_keys(entries, keyers)).join(facts, "id")


def groups(rows: DataFrame) -> DataFrame:
    """reason, match_key, n, kinds, families, sources, related, of blocks of two and more."""
    block = ["reason", "match_key"]
    heads = rows.groupBy(*block).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("kind")).alias("kinds"), F.array_sort(F.collect_set("family")).alias("families"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"), F.bool_or("related").alias("related"))
    return heads.where("n >= 2")


def risks() -> Column:
    n_sources = F.size("sources")
    found = [
        F.when(n_sources > 1, "cross_source_shadow"),
        F.when(F.size("families") > 1, "family_conflict"),
        F.when(F.size("kinds") > 1, "kind_conflict"),
        F.when(F.col("related"), "relation_review_needed"),
        F.when(n_sources == 1, "same_source_duplicate"),
    ]
    return F.array_compact(F.array(*found))


def packets(heads: DataFrame) -> DataFrame:
    """The groups with id, risks, severity, confidence, review_category and source_families."""
    has = lambda r: F.array_contains("risks", r)
    mixed = has("kind_conflict") | has("family_conflict")
    severity = F.when(mixed | (has("cross_source_shadow") & has("relation_review_needed")), "high").when((F.col("reason") == LOCATOR) | has("cross_source_shadow"), "medium").otherwise("low")
    confidence = F.when(F.col("reason").isin(NAME, LOCATOR), "high").when(has("same_source_duplicate"), "medium").otherwise("low")
    category = F.when(mixed, "kind_conflict").when(has("cross_source_shadow"), "source_shadow").when(has("same_source_duplicate"), "same_source_duplicate").when(has("relation_review_needed"), "relation_endpoint_review").when(F.col("reason").isin(URL, LOCATOR), "locator_or_url_overlap").otherwise("source_shadow")
    families = F.array_sort(F.array_distinct(F.transform("sources", lambda s: source_family(s))))
    return heads.withColumn("risks", risks()).select(F.concat_ws(":", "reason", stable_key(F.col("match_key"))).alias("id"), "reason", "match_key", severity.alias("severity"), confidence.alias("confidence"), category.alias("review_category"), "risks", families.alias("source_families"), "n", "kinds", "families", "sources")


def places(prefix: str = "") -> Column:
    """What ``noise`` looks at in the attributes of courts, commissions, areas and seats; null for other kinds. Small, unlike the attributes."""
    text = lambda a: unquoted(F.try_element_at("attributes", F.lit(a)))
    urls = F.struct(*[F.coalesce(canonical_url(text(a)), F.lit("")).alias(a) for a in PLACES], text("sourceAncId").alias("anc_id"))
    return F.when(F.col("kind").isin(*[f"{prefix}{k}" for k in ("court", "court_division", "anc", "smd", "anc_commissioner_seat")]), urls)


def noise(rows: DataFrame, heads: DataFrame, relations: DataFrame, prefix: str = "") -> DataFrame:
    """reason and match_key of URL groups that say nothing: all legal authorities; authorities and what they
    authorise; a court and its divisions; an area's commission with its areas and seats; many of one source and kind; areas of one source and kind.

    ``rows`` have ``places``. ``prefix`` stands before kinds and ``relation:`` before relation kinds of the registry. Edges meet the blocks of
    their source first, so that a hub that many point to counts once a block.
    """
    kind = lambda k: F.col("kind") == f"{prefix}{k}"
    block = ["reason", "match_key"]
    url_rows = rows.where(F.col("reason") == URL)

    def related_inside(relation: str, target: str) -> DataFrame:
        """Members with such a relation to a member of such a kind."""
        ends = url_rows.where(kind(target)).select(*block, F.col("id").alias("to_id"))
        edges = relations.where(F.col("kind") == f"{prefix}relation:{relation}").select(F.col("from_id").alias("id"), "to_id")
        return url_rows.select(*block, "id").join(edges, "id").join(ends, [*block, "to_id"], "left_semi").select(*block, "id").distinct()

    facts = (
        url_rows.join(related_inside("authorized_by", "legal_authority").withColumn("authorised", F.lit(True)), [*block, "id"], "left")
        .join(related_inside("part_of", "court").withColumn("inside", F.lit(True)), [*block, "id"], "left")
        .na.fill(False, ["authorised", "inside"])
    )
    points_here = lambda *names: F.coalesce(F.array_contains(F.array(*[F.col(f"places.{a}") for a in names]), F.col("match_key")), F.lit(False))
    law, court, division, anc, area, seat = (kind(k) for k in ("legal_authority", "court", "court_division", "anc", "smd", "anc_commissioner_seat"))
    anc_id = F.col("places.anc_id")
    flags = facts.groupBy(*block).agg(
        F.bool_and(law).alias("laws"),
        (F.bool_or(law) & F.bool_and(law | F.col("authorised"))).alias("authorised"),
        (F.bool_or(court) & F.bool_or(division) & F.bool_and(court | division) & F.bool_or(court & points_here("officialUrl", "sourcePageUrl")) & F.bool_and(~division | (points_here("sourceDiscoveryPageUrl") & F.col("inside")))).alias("courts"),
        (
            (F.count_if(anc) == 1) & F.bool_or(area | seat) & F.bool_and(anc | area | seat) & F.bool_or(anc & anc_id.isNotNull() & points_here("officialUrl", "webUrl", "sourceOancProfileUrl"))
            & (F.count_distinct(anc_id) == 1) & F.bool_and(anc_id.isNotNull()) & F.bool_and(~area | points_here("webUrl")) & F.bool_and(~seat | points_here("sourceOancProfileUrl"))
        ).alias("ancs"),
    )
    sized = heads.where(F.col("reason") == URL).join(flags, block)
    one = (F.size("sources") == 1) & (F.size("kinds") == 1)
    return sized.where(F.col("laws") | F.col("authorised") | F.col("courts") | F.col("ancs") | (one & (F.col("n") > 2)) | (one & (F.size("families") == 1) & F.array_contains("families", "area"))).select(*block)


def blocks(entries: DataFrame, relations: DataFrame, prefix: str = "", keyers: Mapping[str, Callable[[], Column]] = KEYERS) -> DataFrame:
    """``members`` with ``places``, written: what packets, noise and stale duplicates are made from."""
    return materialise(members(entries.withColumn("places", places(prefix)), relations, ("places",), keyers), "block-members")


def packets_of(rows: DataFrame, relations: DataFrame, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Packets of ``blocks`` without the noise, and their members (packet id, entry id)."""
    heads = groups(rows)
    kept = packets(heads.join(noise(rows, heads, relations, prefix), ["reason", "match_key"], "left_anti"))
    return kept, rows.select("reason", "match_key", F.col("id").alias("entry_id")).join(kept.select("id", "reason", "match_key"), ["reason", "match_key"]).select(F.col("id").alias("packet_id"), "entry_id")


def find_candidates(entries: DataFrame, relations: DataFrame, prefix: str = "", keyers: Mapping[str, Callable[[], Column]] = KEYERS) -> tuple[DataFrame, DataFrame]:
    """Packets without the noise, and their members (packet id, entry id)."""
    return packets_of(blocks(entries, relations, prefix, keyers), relations, prefix)


def top_packets(found: DataFrame, limit: int) -> DataFrame:
    """The first packets by (reason, match_key), each with the number of all before the limit."""
    return found.orderBy("reason", "match_key").limit(limit).withColumn("candidate_count", F.lit(found.count()).cast("long"))


def duplicate_slugs(rows: DataFrame, name: Column, slug: Column, most: int = 1000) -> DataFrame:
    """name, n and slugs (distinct, in order, joined by ``; ``) of normalised names that several slugs share; names of more than ``most`` slugs are listed in chunks."""
    each = rows.select(name.alias("name"), slug.alias("slugs")).where("name <> '' AND slugs IS NOT NULL").distinct()
    shared = each.groupBy("name").agg(F.count("*").alias("__n")).where("__n > 1").select("name")
    return listed(each.join(shared, "name", "left_semi"), "name", ["slugs"], ["slugs"], most).select("name", "n", "slugs")


def stale_duplicates(rows: DataFrame, name: Column, substantive: Column) -> DataFrame:
    """``rows`` with stale: the name is shared, some row of it has substance and this one has none.

    Shared names are known from counts alone; rows meet them by a join that AQE may split.
    """
    keyed = rows.withColumn("__name", name).withColumn("__good", F.coalesce(substantive, F.lit(False)))
    shared = keyed.groupBy(F.col("__name").alias("__shared")).agg(F.count("*").alias("n"), F.bool_or("__good").alias("any")).where("n > 1 AND any")
    joined = keyed.join(shared, F.col("__name") == F.col("__shared"), "left")
    return joined.withColumn("stale", F.col("__shared").isNotNull() & ~F.col("__good")).select(*rows.columns, "stale")
