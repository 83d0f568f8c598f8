"""Fragments to state: promotion, merge, relations, validation, revisions; conflicts stop it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import FINDING
from ..operators import fragments as fr
from ..operators.replay import apply, replay
from ..operators.validate import Registry, state_issues
from ..stages import materialise


@dataclass
class Compiled:
    """``state`` is None if there are conflicts; the baseline is what stood before revisions."""

    baseline: tuple[DataFrame, DataFrame]
    state: tuple[DataFrame, DataFrame] | None
    findings: DataFrame
    conflicts: DataFrame


def issues_as_findings(issues: DataFrame) -> DataFrame:
    none = F.lit(None).cast(issues.sparkSession.createDataFrame([], FINDING).schema["citation"].dataType)
    return issues.select(F.lit("conflict").alias("kind"), "code", F.concat_ws(": ", "id", "message").alias("message"), none.alias("citation"))


def baseline(entries: DataFrame, relations: DataFrame, policy: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries, relations and findings of fragments, before validation."""
    decided = fr.promotion(entries, policy)
    merged = materialise(fr.merge_entries(fr.promoted(decided)), "merged")
    checked = fr.endpoint_status(fr.canonical_kinds(relations, kinds), merged.select("id"), fr.not_promoted(decided))
    checked = materialise(checked, "checked")
    kept = materialise(fr.dedupe_relations(checked.where("status = 'keep'")), "relations")
    none = F.lit(None).cast(entries.schema["citations"].dataType.elementType)
    renamed = checked.where("renamed").select(F.lit("warn").alias("kind"), F.lit("compiler.relation_kind_canonicalized").alias("code"), F.concat_ws(" ", F.lit("to"), "relation_kind").alias("message"), none.alias("citation"))
    mismatched = fr.kind_conflicts(fr.promoted(decided)).select(F.lit("conflict").alias("kind"), F.lit("compiler.conflict.entry_kind_mismatch").alias("code"), F.col("id").alias("message"), none.alias("citation"))
    findings = fr.promotion_findings(decided).unionByName(fr.relation_findings(checked)).unionByName(renamed).unionByName(mismatched)
    return merged, kept, findings


def compile_state(entries: DataFrame, relations: DataFrame, policy: DataFrame, registry: Registry, kinds: dict[str, str] | None = None, revisions: DataFrame | None = None, aliases: DataFrame | None = None) -> Compiled:
    """The state of the fragments, as entries and relations, after the revisions."""
    merged, kept, findings = baseline(entries, relations, policy, kinds or {})
    findings = materialise(findings, "findings")
    conflicts = materialise(findings.where("kind = 'conflict'").unionByName(issues_as_findings(state_issues(merged, kept, registry))), "conflicts")
    start = (merged, kept)
    if not conflicts.isEmpty():
        return Compiled(start, None, findings, conflicts)
    if revisions is None:
        return Compiled(start, start, findings, conflicts)
    replayed = replay(revisions, merged, aliases)
    after = apply(merged, kept, replayed)
    state = (materialise(after[0], "entries"), materialise(after[1], "relations-after"))
    none = F.lit(None).cast(findings.schema["citation"].dataType)
    said = replayed.findings.withColumn("citation", none)
    findings = findings.unionByName(said)
    conflicts = conflicts.unionByName(said.where("kind = 'conflict'"))
    conflicts = conflicts.unionByName(issues_as_findings(state_issues(*state, registry)))
    return Compiled(start, state if conflicts.isEmpty() else None, findings, conflicts)
