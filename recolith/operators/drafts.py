"""Draft revisions from review decisions: one small document a decision, made on the driver."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

DECISIONS = ("preserve-distinct", "source-shadow", "suppress", "alias", "override-kind")


def draft(item: dict[str, Any], decision: str, target: str | None = None, kind: str | None = None, rationale: str = "", names: dict[str, str] | None = None) -> dict[str, Any]:
    """``item``: id, ids of its entries, citations. ``names``: entries' names, for aliases. REVISION's fields, and the draft's own."""
    ids = sorted(item["ids"])
    if decision not in DECISIONS:
        raise ValueError(f"unknown decision {decision}")
    if not ids:
        raise ValueError(f"{item['id']} names no entry")
    if target is not None and target not in ids:
        raise ValueError(f"{target} is no entry of {item['id']}")
    if target is None and decision in ("source-shadow", "alias"):
        raise ValueError(f"{decision} needs a target")
    own = target or ids[0]
    others = [i for i in ids if i != own]
    if decision == "source-shadow":
        if not others:
            raise ValueError("source-shadow needs another entry")
        own, others = others[0], [target]
        patch: dict[str, Any] = {"suppress": True, "review": {"decision": "source_shadow", "canonicalEntryId": target}}
    elif decision == "preserve-distinct":
        if not others:
            raise ValueError("preserve-distinct needs another entry")
        patch = {"review": {"decision": "preserve_distinct", "relatedEntryIds": others}}
    elif decision == "alias":
        aliases = list(dict.fromkeys((names or {})[i] for i in ids if i != target and i in (names or {})))
        if not aliases:
            raise ValueError("alias needs a name")
        patch = {"review": {"decision": "alias", "aliasNames": aliases}}
    elif decision == "override-kind":
        if not kind:
            raise ValueError("override-kind needs a kind")
        patch = {"kind": kind}
    else:
        patch = {"suppress": True}
    return {"id": f"review-{decision}-{item['id']}" + (f"-{target}" if target else ""), "source": "review", "status": "draft", "item_id": item["id"], "decision": decision, "related_ids": others, "target_kind": "entry", "target_id": own, "rationale": rationale or f"{decision} of {own}", "evidence": item.get("citations", []), "patch": json.dumps(patch, sort_keys=True)}


def apply_draft(document: dict[str, Any], tracked: Path) -> Path:
    """Writes the draft's revision among the tracked ones; an existing one is never overwritten."""
    revision = {k: document[k] for k in ("id", "source", "target_kind", "target_id", "rationale", "evidence", "patch")}
    path = tracked / f"{''.join(c if c.isalnum() or c in '._-' else '-' for c in document['id'])}.json"
    with path.open("x") as f:
        json.dump(revision, f, indent=1, sort_keys=True)
    return path
