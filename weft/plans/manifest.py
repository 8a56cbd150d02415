"""Stages with chained fingerprints: a stage whose inputs are as before is skipped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from weft import uris

STAGES = ("ingest", "clean", "tokenizer", "pretrain", "convdata", "finetune", "evaluate", "export")


def fingerprint(payload: dict) -> str:
    """The first 16 hex digits of the SHA-256 of the payload as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()[:16]


@dataclass
class Manifest:
    """What each stage was run on and gave; kept as one small JSON file at a URI of the project."""

    path: str
    stages: dict[str, dict] = field(default_factory=dict)
    provenance: list[dict] = field(default_factory=list)

    @classmethod
    def load(cls, path: str) -> Manifest:
        data = json.loads(uris.read(path)) if uris.exists(path) else {}
        return cls(path, data.get("stages", {}), data.get("provenance", []))

    def save(self) -> None:
        uris.write(self.path, json.dumps({"stages": self.stages, "provenance": self.provenance}, indent=2, ensure_ascii=False))

    def fresh(self, stage: str, print_: str) -> bool:
        return self.stages.get(stage, {}).get("fingerprint") == print_

    def record(self, stage: str, print_: str, outputs: list[str], metrics: dict) -> None:
        self.stages[stage] = {"fingerprint": print_, "completed_at": datetime.now(timezone.utc).isoformat(), "outputs": outputs, "metrics": metrics}

    def invalidate_from(self, stage: str) -> None:
        for name in STAGES[STAGES.index(stage) :]:
            self.stages.pop(name, None)

    def add_provenance(self, records: list[dict]) -> None:
        """One record for each source, the latest."""
        known = {r["source"]: r for r in self.provenance}
        self.provenance = list((known | {r["source"]: r for r in records}).values())


def run(manifest: Manifest, selected: list[str], config: dict, work: dict[str, Callable[[], tuple[list[str], dict]]], force_from: str | None = None) -> dict[str, str]:
    """Runs the selected stages in canonical order; the manifest is saved after each, so a broken run resumes there.

    ``work`` gives outputs and metrics of a stage. A fingerprint covers the stage's own configuration and
    the fingerprint of the selected stage before it.
    """
    if unknown := set(selected) - set(STAGES):
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    if force_from:
        manifest.invalidate_from(force_from)
    upstream, said = "", {}
    for stage in (s for s in STAGES if s in selected):
        mine = fingerprint({"stage": stage, "config": config.get(stage, {}), "upstream": upstream})
        if manifest.fresh(stage, mine):
            said[stage] = "skipped"
        else:
            outputs, metrics = work[stage]()
            manifest.record(stage, mine, outputs, metrics)
            manifest.save()
            said[stage] = "ran"
        upstream = mine
    return said
