"""Scoring rules: checked on the driver, compiled to one projection."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("club", "event", "yacht", "participant", "registration")
STATES = ("auto_promote", "review", "hold", "reject")


class RuleError(ValueError):
    """A rule set that can't be used."""


@dataclass(frozen=True)
class RuleSet:
    entity_type: str
    version: str
    thresholds: dict[str, float]
    feature_weights: dict[str, float]
    missing_attribute_penalties: dict[str, float] = field(default_factory=dict)
    hard_blocks: tuple[str, ...] = ()
    source_system: str = ""

    @property
    def digest(self) -> str:
        return hashlib.sha256(json.dumps([self.entity_type, self.version, self.thresholds, self.feature_weights, self.missing_attribute_penalties, list(self.hard_blocks), self.source_system]).encode()).hexdigest()


def checked(data: dict) -> RuleSet:
    """Rule set of a mapping, as a rule file holds it."""
    if not isinstance(data, dict):
        raise RuleError("a rule set is a mapping")
    missing = {"entity_type", "version", "thresholds", "feature_weights"} - data.keys()
    if missing:
        raise RuleError(f"missing: {sorted(missing)}")
    if data["entity_type"] not in KINDS:
        raise RuleError(f"unknown entity type {data['entity_type']!r}")
    try:
        limits = {k: float(v) for k, v in (data["thresholds"] or {}).items()}
        weights = {k: float(v) for k, v in (data["feature_weights"] or {}).items()}
        penalties = {k: float(v) for k, v in (data.get("missing_attribute_penalties") or {}).items()}
    except (TypeError, ValueError) as e:
        raise RuleError(f"not a number: {e}") from None
    if {"auto_promote", "review", "hold"} - limits.keys():
        raise RuleError("thresholds need auto_promote, review and hold")
    if not all(0 <= v <= 1 for v in limits.values()) or not limits["hold"] <= limits["review"] <= limits["auto_promote"]:
        raise RuleError("thresholds lie in 0 to 1 and rise from hold to auto_promote")
    if not weights or any(w < 0 for w in weights.values()):
        raise RuleError("feature weights are needed and not negative")
    return RuleSet(data["entity_type"], str(data["version"]), limits, weights, penalties, tuple(data.get("hard_blocks") or ()), data.get("source_system") or "")


def load(text: str) -> RuleSet:
    """Rule set of a YAML or JSON text."""
    try:
        return checked(json.loads(text))
    except json.JSONDecodeError:
        pass
    try:
        import yaml
    except ImportError as e:
        raise RuleError("YAML rules need PyYAML") from e
    try:
        return checked(yaml.safe_load(text))
    except yaml.YAMLError as e:
        raise RuleError(str(e)) from e


# The shipped rule sets.
SHIPPED: dict[str, RuleSet] = {
    kind: RuleSet(kind, version, dict(zip(("auto_promote", "review", "hold"), limits, strict=True)), weights, penalties, blocks)
    for kind, version, limits, weights, penalties, blocks in (
        (
            "participant", "v1.2.0", (0.60, 0.50, 0.25),
            {"email_exact": 0.55, "phone_exact": 0.20, "dob_exact": 0.15, "normalized_name_exact": 0.10, "address_present": 0.35},
            {"missing_email": 0.10, "missing_phone": 0.05}, ("conflicting_dob", "conflicting_high_confidence_email"),
        ),
        (
            "yacht", "v1.1.0", (0.75, 0.50, 0.25),
            {"sail_number_exact": 0.50, "name_normalized": 0.30, "yacht_type_present": 0.10, "length_feet_present": 0.10},
            {"missing_sail_number": 0.15, "missing_name": 0.20}, ("conflicting_sail_number_same_name",),
        ),
        (
            "club", "v1.1.0", (0.45, 0.30, 0.15),
            {"name_normalized": 0.50, "website_present": 0.25, "state_usa_present": 0.15, "phone_present": 0.10},
            {"missing_website": 0.05}, ("conflicting_normalized_names_no_corroboration",),
        ),
        (
            "event", "v1.0.2", (0.40, 0.30, 0.20),
            {"external_id_present": 0.40, "season_year_present": 0.25, "name_normalized": 0.25, "dates_present": 0.10},
            {"missing_external_id": 0.10, "missing_season_year": 0.10}, ("conflicting_years_same_external_id",),
        ),
        (
            "registration", "v1.0.0", (0.90, 0.75, 0.50),
            {"external_id_present": 0.40, "event_resolved": 0.25, "yacht_resolved": 0.25, "participant_resolved": 0.10},
            {"missing_external_id": 0.10, "missing_yacht": 0.10}, ("duplicate_external_id_different_event",),
        ),
    )
}


def _dec(v: float) -> Column:
    return F.lit(Decimal(str(v))).cast("decimal(6,4)")


def score(rules: RuleSet, features: dict[str, Column], flags: Column | None = None) -> tuple[Column, Column, Column]:
    """Score, state and reasons as Columns of one projection, in exact decimals.

    ``features``: what holds for the row. ``flags``: array of hard blocks found.
    A penalty applies if no feature whose name begins with the attribute holds,
    and the score doesn't fall below 0 at any step.
    """
    has = {f: F.coalesce(features[f], F.lit(False)) if f in features else F.lit(False) for f in rules.feature_weights}
    total = _dec(0)
    reasons = []
    for f, w in rules.feature_weights.items():
        total = (total + F.when(has[f], _dec(w)).otherwise(_dec(0))).cast("decimal(6,4)")
        reasons.append(F.when(has[f], F.lit(f"feature:{f}:{w:.4f}")))
    for p, v in rules.missing_attribute_penalties.items():
        lacks = F.lit(True)
        for f in has:
            if f.startswith(p.removeprefix("missing_")):
                lacks = lacks & ~has[f]
        total = F.greatest(_dec(0), total - F.when(lacks, _dec(v)).otherwise(_dec(0))).cast("decimal(6,4)")
        reasons.append(F.when(lacks, F.lit(f"penalty:{p}:{v:.4f}")))
    total = F.least(_dec(1), total).cast("decimal(5,4)")
    blocked = F.lit(False)
    found = F.array().cast("array<string>")
    if flags is not None and rules.hard_blocks:
        found = F.filter(flags, lambda x: x.isin(list(rules.hard_blocks)))
        blocked = F.coalesce(F.size(found) > 0, F.lit(False))
    total = F.when(blocked, _dec(0).cast("decimal(5,4)")).otherwise(total)
    limits = rules.thresholds
    state = F.when(blocked, "reject")
    for s in STATES[:3]:
        state = state.when(total >= _dec(limits[s]), s)
    why = F.when(blocked, F.array(F.concat(F.lit("hard_block:"), F.get(found, F.lit(0))))).otherwise(F.array_compact(F.array(*reasons)))
    return total, state.otherwise("reject"), why


def register(registry: list[dict], rules: RuleSet) -> tuple[list[dict], str]:
    """New registry and id: an active equal rule set is reused, another of its kind and source is retired."""
    same = [r for r in registry if (r["entity_type"], r["source_system"]) == (rules.entity_type, rules.source_system) and r["is_active"]]
    for r in same:
        if r["digest"] == rules.digest:
            return registry, r["id"]
    kept = [r | {"is_active": False} if r in same else r for r in registry]
    new = hashlib.sha256(f"{rules.entity_type}|{rules.source_system}|{rules.digest}|{len(registry)}".encode()).hexdigest()[:32]
    return [*kept, {"id": new, "entity_type": rules.entity_type, "source_system": rules.source_system, "version": rules.version, "digest": rules.digest, "is_active": True}], new
