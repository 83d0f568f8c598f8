"""The fold of revisions as one loop: what the distributed replay is held against."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any


@dataclass
class Fold:
    """What the revisions amount to."""

    suppressed: dict[str, str | None] = field(default_factory=dict)
    retargets: list[tuple[str, str | None]] = field(default_factory=list)
    patches: dict[str, dict[str, Any]] = field(default_factory=dict)
    relations: dict[str, list[tuple[str, str, list]]] = field(default_factory=dict)
    findings: list[tuple[str, str, str]] = field(default_factory=list)
    final_target: dict[str, str | None] = field(default_factory=dict)

    @property
    def conflicts(self) -> list[tuple[str, str, str]]:
        return [f for f in self.findings if f[0] == "conflict"]


def fold_revisions(revisions: list[Any], touched: dict[str, tuple[str, str]], aliases: dict[tuple[str, str], set[str]]) -> Fold:
    """``revisions``: REVISION rows. ``touched``: kind and name by id of the entries that revisions may name.
    ``aliases``: canonical ids by (key type, key). In order of revision id; a later one sees what earlier ones did."""
    fold, state = Fold(), dict(touched)

    def say(kind: str, code: str, message: str) -> None:
        fold.findings.append((kind, code, message))

    def reference(id_: str) -> str:
        found = aliases.get(("id", id_), set())
        if len(found) > 1:
            raise ValueError(f"reference {id_} has several canonical entries: {', '.join(sorted(found))}")
        if found and found != {id_}:
            say("info", "compiler.identity_alias.reference_resolved", f"{id_}: {min(found)}")
        return next(iter(found), id_)

    def target_of(r: Any) -> str | None:
        selector = r["target"]
        options: set[str] = set()
        unclear: list[str] = []
        keys = [("id", r["target_id"])] + ([("id", p) for p in selector["previous_ids"] or []] if selector else [])
        refs = [("ref", ref_key(s)) for s in (selector["source_refs"] or [])] if selector else []
        if selector and selector["canonical_id"] in state:
            options.add(selector["canonical_id"])
        for key in keys + refs:
            if key[0] == "id" and key[1] in state:
                options.add(key[1])
                continue
            found = aliases.get(key, set())
            if len(found) == 1:
                options |= found
            elif found:
                unclear.append(key[1])
        if unclear or len(options) > 1:
            say("conflict", "compiler.conflict.revision_target_ambiguous", f"{r['id']}: {', '.join(unclear or sorted(options))}")
        elif not options or next(iter(options)) not in state:
            say("conflict", "compiler.conflict.revision_target_missing", f"{r['id']}: {r['target_id']}")
        else:
            id_ = next(iter(options))
            kind, name = state[id_]
            if selector and ((selector["kind"] and selector["kind"] != kind) or (selector["name"] and selector["name"] != name)):
                say("conflict", "compiler.conflict.revision_target_guard_mismatch", f"{r['id']}: {id_}")
                return None
            return id_
        return None

    for r in sorted(revisions, key=lambda r: r["id"]):
        id_ = target_of(r)
        if id_ is None:
            continue
        patch = json.loads(r["patch"])
        review = patch.get("review") if isinstance(patch.get("review"), dict) else {}
        try:
            if r["target_kind"] == "entry" and patch.get("suppress") is True:
                canonical = review.get("canonicalEntryId")
                other = reference(canonical) if review.get("decision") == "source_shadow" and isinstance(canonical, str) and canonical.strip() else None
                del state[id_]
                fold.suppressed[id_] = other
                fold.retargets.append((id_, other))
                fold.relations = {k: [(kind, other if to == id_ and other and other != k else to, c) for kind, to, c in v if to != id_ or (other and other != k)] for k, v in fold.relations.items() if k != id_}
                fold.patches.pop(id_, None)
                say("info", "compiler.revision.entry_suppressed", f"{r['id']}: {id_}")
                continue
            if isinstance(patch.get("relations"), dict):
                fold.relations[id_] = [(x["kind"], reference(x["to"]), x.get("citations") or []) for v in patch["relations"].values() if isinstance(v, list) for x in v if isinstance(x.get("kind"), str) and isinstance(x.get("to"), str)]
            elif r["target_kind"] == "relation":
                raise ValueError("patch must include a relations object")
            if r["target_kind"] == "entry":
                own = fold.patches.setdefault(id_, {"attributes": {}})
                for key in ("kind", "name", "family"):
                    if isinstance(patch.get(key), str) and patch[key]:
                        own[key] = patch[key]
                if isinstance(patch.get("attributes"), dict):
                    own["attributes"] |= {k: json.dumps(v, ensure_ascii=False, separators=(",", ":")) for k, v in patch["attributes"].items()}
                if isinstance(patch.get("citations"), list):
                    own["citations"] = patch["citations"]
                if review:
                    entry = {k: review[k] for k in ("aliasNames", "relatedEntryIds", "canonicalEntryId") if k in review}
                    entry |= {"decision": review.get("decision"), "rationale": r["rationale"], "revisionId": r["id"], "source": r["source"]}
                    own.setdefault("reviews", []).append(entry)
                    own["attributes"]["revisionReviews"] = json.dumps(sorted(own["reviews"], key=lambda x: x["revisionId"]), ensure_ascii=False, separators=(",", ":"), sort_keys=True)
                    say("info", "compiler.revision.review_recorded", f"{r['id']}: {id_}")
                state[id_] = (own.get("kind", state[id_][0]), own.get("name", state[id_][1]))
        except ValueError as e:
            say("conflict", "compiler.conflict.revision_invalid_state", f"{r['id']}: {e}")
    # where an edge to a suppressed id leads in the end: each step holds for what stood when it was taken
    # an id is suppressed once, so read backwards each replacement's own end is known by then if it goes later
    for gone, other in reversed(fold.retargets):
        fold.final_target[gone] = fold.final_target.get(other, other) if other else None
    return fold


def ref_key(citation: Any) -> str:
    """citation_id with ``|``, of a row."""
    c = citation.asDict() if hasattr(citation, "asDict") else citation
    return "|".join(["source", c["source"], c["source_record_id"], c.get("locator") or "", c.get("url") or ""])
