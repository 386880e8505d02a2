"""Candidate scoring, suggested actions and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rules import SHIPPED, RuleSet, score


def _there(c: str) -> Column:
    """Not null, and neither blank nor 0."""
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "") & F.coalesce(F.col(c).try_cast("double") != 0, F.lit(True))


def _text(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "")


def child_evidence(contacts: DataFrame, addresses: DataFrame) -> DataFrame:
    """Per candidate whether it has an e-mail, a phone and an address among its child rows."""
    usable = contacts.where(F.col("normalized_value").isNotNull() & F.col("contact_type").isin("email", "phone"))
    c = usable.groupBy("candidate_id").agg(F.bool_or(F.col("contact_type") == "email").alias("child_email"), F.bool_or(F.col("contact_type") == "phone").alias("child_phone"))
    a = addresses.groupBy("candidate_id").agg(F.lit(True).alias("child_address"))
    both = c.join(a, "candidate_id", "full_outer")
    return both.select("candidate_id", *[F.coalesce(x, F.lit(False)).alias(x) for x in ("child_email", "child_phone", "child_address")])


def features(kind: str, columns: list[str]) -> dict[str, Column]:
    """What the rules of a kind look at; an address counts only where there is no e-mail and no phone."""
    if kind == "participant":
        child = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in columns else F.lit(False)
        mail, phone = _text("best_email") | child("child_email"), _text("best_phone") | child("child_phone")
        return {
            "email_exact": mail,
            "phone_exact": phone,
            "dob_exact": F.col("date_of_birth").isNotNull(),
            "normalized_name_exact": _text("normalized_name"),
            "address_present": child("child_address") & ~mail & ~phone,
        }
    if kind == "yacht":
        return {
            "sail_number_exact": _text("normalized_sail_number"),
            "name_normalized": _text("normalized_name"),
            "yacht_type_present": _text("yacht_type"),
            "length_feet_present": _there("length_feet"),
        }
    if kind == "club":
        return {"name_normalized": _text("normalized_name"), "website_present": _text("website"), "state_usa_present": _text("state_usa"), "phone_present": _text("phone")}
    if kind == "event":
        return {
            "external_id_present": _text("event_external_id"),
            "season_year_present": F.col("season_year").isNotNull(),
            "name_normalized": _text("normalized_event_name"),
            "dates_present": F.col("start_date").isNotNull() | F.col("end_date").isNotNull(),
        }
    if kind == "registration":
        return {
            "external_id_present": _text("registration_external_id"),
            "event_resolved": _text("candidate_event_id"),
            "yacht_resolved": _text("candidate_yacht_id"),
            "participant_resolved": _text("candidate_primary_participant_id"),
        }
    raise ValueError(kind)


def scored(candidates: DataFrame, kind: str, rules: RuleSet | None = None, flags: Column | None = None) -> DataFrame:
    """Set quality_score, resolution_state and confidence_reasons; promoted candidates keep their state.

    ``staged`` marks unpromoted ones that rise from reject to auto_promote, which
    happens through review.
    """
    rules = rules or SHIPPED[kind]
    value, state, why = score(rules, features(kind, candidates.columns), flags)
    if kind == "participant" and "child_email" in candidates.columns:
        seen = [F.when(F.coalesce(F.col(f"child_{c}"), F.lit(False)) & w, F.lit(f"evidence:child_{c}")) for c, w in (("email", ~_text("best_email")), ("phone", ~_text("best_phone")))]
        why = F.concat(why, F.array_compact(F.array(*seen)))
    promoted = F.coalesce(F.col("is_promoted"), F.lit(False)) if "is_promoted" in candidates.columns else F.lit(False)
    before = F.col("resolution_state") if "resolution_state" in candidates.columns else F.lit(None).cast("string")
    return candidates.withColumns(
        {
            "quality_score": value,
            "resolution_state": F.when(promoted, F.coalesce(before, F.lit("auto_promote"))).otherwise(state),
            "confidence_reasons": why,
            "staged": F.coalesce(~promoted & (before == "reject") & (state == "auto_promote"), F.lit(False)),
        }
    )


def suggestions(candidates: DataFrame, kind: str, rules: RuleSet | None = None, id_col: str = "id") -> DataFrame:
    """One action for each weighted feature that an open candidate lacks, the weight as its priority; no address is asked for."""
    rules = rules or SHIPPED[kind]
    have = features(kind, candidates.columns)
    lacking = [F.when(~F.coalesce(have[f], F.lit(False)), F.struct(F.lit(f).alias("feature"), F.lit(w).cast("decimal(8,4)").alias("priority"))) for f, w in rules.feature_weights.items() if f != "address_present"]
    blocked = F.exists("confidence_reasons", lambda r: r.startswith("hard_block:"))
    promoted = F.coalesce(F.col("is_promoted"), F.lit(False)) if "is_promoted" in candidates.columns else F.lit(False)
    live = candidates.where(~promoted & (F.col("resolution_state") != "auto_promote") & ~F.coalesce(blocked, F.lit(False)))
    rows = live.select(F.col(id_col).alias("target_entity_id"), F.explode(F.array_compact(F.array(*lacking))).alias("a"))
    return rows.select(F.lit("enrich_candidate").alias("action_type"), F.lit(f"candidate_{kind}").alias("target_entity_type"), "target_entity_id", F.concat(F.lit("missing_"), F.col("a.feature")).alias("reason_code"), F.col("a.priority").alias("priority"), F.lit("open").alias("status"))


def refreshed_suggestions(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Open actions of the scorer are replaced; all others stay."""
    own = (F.col("action_type") == "enrich_candidate") & (F.col("status") == "open")
    return old.where(~own).unionByName(fresh)


def distribution(scored_rows: DataFrame, by: str = "entity_type", value: str = "quality_score") -> DataFrame:
    """Least, quartiles and greatest score per group, exactly."""
    v = F.col(value).cast("double")
    p = lambda q: F.percentile(v, q)
    return scored_rows.groupBy(by).agg(F.count("*").alias("n"), F.min(v).alias("min_score"), p(0.25).alias("p25"), p(0.5).alias("p50"), p(0.75).alias("p75"), F.max(v).alias("max_score"))


def top_reasons(scored_rows: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent reasons, ties by name."""
    per = scored_rows.select("entity_type", F.explode("confidence_reasons").alias("reason")).groupBy("entity_type", "reason").agg(F.count("*").alias("n"))
    return per.orderBy("entity_type", F.desc("n"), "reason").limit(limit)


def state_counts(scored_rows: DataFrame) -> DataFrame:
    return scored_rows.groupBy("entity_type", "resolution_state", "is_promoted").agg(F.count("*").alias("n"))


def blocked_counts(scored_rows: DataFrame) -> DataFrame:
    """Candidates by kind and hard block."""
    per = scored_rows.select("entity_type", "id", F.explode("confidence_reasons").alias("reason")).where(F.col("reason").startswith("hard_block:"))
    return per.groupBy("entity_type", "reason").agg(F.count_distinct("id").alias("n"))


def would_promote(scored_rows: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """By kind: unpromoted candidates whose score reaches the kind's threshold of auto_promote, and how many of them are in another state."""
    limits = limits or {k: r.thresholds["auto_promote"] for k, r in SHIPPED.items()}
    least = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[F.col("entity_type")]
    up = ~F.coalesce("is_promoted", F.lit(False)) & (F.col("quality_score").cast("double") >= least)
    return scored_rows.groupBy("entity_type").agg(F.count_if(up).alias("n"), F.count_if(up & (F.col("resolution_state") != "auto_promote")).alias("held_back"))


def all_kinds(rows: dict[str, DataFrame]) -> DataFrame:
    """What the candidates of all kinds have in common, as one table."""
    out = None
    for kind, df in rows.items():
        part = df.select(F.lit(kind).alias("entity_type"), "id", "resolution_state", F.coalesce("is_promoted", F.lit(False)).alias("is_promoted"), "quality_score", "confidence_reasons")
        out = part if out is None else out.unionByName(part)
    return out
