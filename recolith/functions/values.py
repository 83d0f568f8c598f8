"""JSON texts, arrays, dates, ids and statuses as Column to Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_json(text: Column) -> Column:
    """Keys sorted, blanks dropped; null if it is no JSON."""
    return F.to_json(F.try_parse_json(text))


def is_object(text: Column) -> Column:
    return is_variant_object(F.try_parse_json(text))


def is_variant_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def variant_string(v: Column, *keys: str) -> Column:
    """The first of the keys of a variant object whose value is a non-blank string or a number, as text."""
    found = []
    for key in keys:
        kind = F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
        found.append(F.when(kind.isin("STRING", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), F.nullif(F.trim(F.try_variant_get(v, f"$.{key}", "string")), F.lit(""))))
    return F.coalesce(*found)


def json_string(payload: Column, *keys: str) -> Column:
    """The same of a JSON text."""
    return variant_string(F.try_parse_json(payload), *keys)


def attribute_map(**values: Column) -> Column:
    """Attributes whose values are JSON texts; nulls are left out."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def quoted(text: Column) -> Column:
    """A text as a JSON text."""
    return F.when(text.isNotNull(), F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", ""))


def unquoted(json: Column) -> Column:
    """A JSON text that is a string, as text; null for other types."""
    return F.when(json.startswith('"'), F.try_variant_get(F.try_parse_json(json), "$", "string"))


def attribute_text(json: Column) -> Column:
    """Strings, numbers and booleans as text; arrays joined by ``; ``."""
    as_array = F.array_join(F.from_json(json, "array<string>"), "; ")
    return F.when(json.startswith("["), as_array).when(json.startswith("{") | (json == "null"), F.lit(None).cast("string")).otherwise(F.try_variant_get(F.try_parse_json(json), "$", "string"))


def citation_id(c: Column, separator: str = ":") -> Column:
    """What makes citations equal."""
    empty = lambda x: F.coalesce(x, F.lit(""))
    cited = F.concat_ws(separator, F.lit("source"), c["source"], c["source_record_id"], empty(c["locator"]), empty(c["url"]))
    return F.when(c["source"].isNotNull(), cited).otherwise(F.concat_ws(separator, F.lit("uncited"), empty(c["reason"])))


def is_citation(c: Column) -> Column:
    return c.isNotNull() & ((c["source"].isNotNull() & c["source_record_id"].isNotNull()) | F.coalesce(c["uncited"], F.lit(False)))


def cite(source: Column, record: Column, locator: Column | None = None, url: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(source.alias("source"), record.alias("source_record_id"), (none if locator is None else locator).alias("locator"), (none if url is None else url).alias("url"), F.lit(None).cast("boolean").alias("uncited"), none.alias("reason"))


def distinct_citations(citations: Column) -> Column:
    """Valid ones, the first of equal ones, in order of what makes them equal."""
    keyed = F.transform(F.filter(citations, is_citation), lambda c: F.struct(citation_id(c).alias("k"), c.alias("c")))
    # array_sort is stable and equal keys have equal contents but for nulls, so one of each key stays
    ordered = F.array_sort(F.array_distinct(keyed))
    return F.transform(F.filter(ordered, lambda x, i: (i == 0) | (x["k"] != F.get(ordered, i - 1)["k"])), lambda x: x["c"])


def preferred_citation(citations: Column, source: Column) -> Column:
    """The first of the source, else the first."""
    return F.coalesce(F.get(F.filter(citations, lambda c: c["source"] == source), 0), F.get(citations, 0))


def record_ref(source: Column, record: Column) -> Column:
    return F.concat_ws(":", source, record)


def iso_timestamp(http_date: Column) -> Column:
    """``Tue, 02 Jan 2024 03:04:05 GMT`` in ISO form; null if it is none."""
    at = F.try_to_timestamp(F.regexp_replace(http_date, r"^[A-Za-z]{3},\s*|\s*GMT$", ""), F.lit("d MMM yyyy HH:mm:ss"))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def is_utc_iso(text: Column) -> Column:
    """Whether parsing and formatting give the text back."""
    again = F.date_format(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.coalesce(again == text, F.lit(False))


def is_count(text: Column) -> Column:
    return text.rlike(r"^(?:0|[1-9]\d*)$")


def fingerprint(*columns: Column) -> Column:
    return F.sha2(F.to_json(F.array(*[c.cast("string") for c in columns])), 256)


def collection_status(snapshots: Column, records: Column) -> Column:
    return F.when(F.coalesce(snapshots, F.lit(0)) == 0, "not_collected").when(F.coalesce(records, F.lit(0)) == 0, "collected_empty").otherwise("collected")


def release_status(inventory: Column, citations: Column, snapshots: Column, records: Column) -> Column:
    count = lambda c: F.coalesce(c, F.lit(0))
    exported = F.when(F.coalesce(inventory, F.lit(False)), "inventory_only").when(count(citations) > 0, "exported")
    return exported.when(count(records) > 0, "collected_not_exported").when(count(snapshots) > 0, "collected_empty").otherwise("not_collected")


def first_attribute(attributes: Column, *names: str) -> Column:
    """The text of the first attribute that has one."""
    return F.coalesce(*[attribute_text(F.try_element_at(attributes, F.lit(n))) for n in names])


def citation_row(c: Column) -> Column:
    """A citation as texts, '' for what it lacks: status cited or uncited, and its parts."""
    part = lambda name: F.coalesce(c[name], F.lit("")).alias(name)
    return F.struct(F.when(c["source"].isNotNull(), "cited").otherwise("uncited").alias("status"), part("source"), part("source_record_id"), part("locator"), part("url"), part("reason"))
