"""Promotion, manual decisions, merge, demote, unlink, split, lineage and remediation.

Tables are versions: each function takes DataFrames and returns new ones.
Candidates: id, resolution_state, is_promoted, promoted_canonical_id and
attributes. Links: candidate_id, canonical_id. Canonicals: id and attributes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import entity_id
from tidemark.lineage import discard, table
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import closed_map, remapped

# Attributes whose origin is kept, per kind.
TRACKED = {
    "participant": ("display_name", "normalized_name", "date_of_birth", "best_email", "best_phone"),
    "yacht": ("name", "normalized_name", "sail_number", "normalized_sail_number", "length_feet", "yacht_type"),
    "club": ("name", "normalized_name", "website", "phone", "state_usa"),
    "event": ("event_name", "normalized_event_name", "season_year", "event_external_id", "start_date", "end_date"),
    "registration": ("registration_external_id", "entry_status", "registered_at"),
}


#: Columns of registrations that refer to canonicals of a kind.
REFERENCES = {"participant": "canonical_primary_participant_id", "event": "canonical_event_id", "yacht": "canonical_yacht_id"}


def promote(kind: str, candidates: DataFrame, links: DataFrame, attributes: Sequence[str], needs: dict[str, DataFrame] | None = None, optional: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Promote candidates in auto_promote that aren't yet: canonicals, links, candidates and audit rows.

    A link that exists gives the canonical id, else a deterministic new one.
    ``needs`` maps a foreign key column to the links of its kind: such rows wait
    until what they refer to is promoted, and refer to its canonical; references
    in ``optional`` columns stay empty instead.
    """
    ready = candidates.where((F.col("resolution_state") == "auto_promote") & ~F.coalesce("is_promoted", F.lit(False)))
    known = links.select(F.col("candidate_id").alias("id"), F.col("canonical_id").alias("_known"))
    ready = ready.join(known, "id", "left").withColumn("canonical_id", F.coalesce("_known", entity_id(f"canonical_{kind}", F.col("id"))))
    extra = []
    for column, of in (needs or {}).items():
        to = of.select(F.col("candidate_id").alias(column), F.col("canonical_id").alias(f"canonical_{column}"))
        ready = ready.join(to, column, "left")
        if column not in optional:
            ready = ready.where(F.col(column).isNull() | F.col(f"canonical_{column}").isNotNull())
        extra.append(f"canonical_{column}")
    done = ready.select("id", F.col("canonical_id").alias("_new"))
    updated = candidates.join(done, "id", "left").withColumns({"is_promoted": F.coalesce("is_promoted", F.lit(False)) | F.col("_new").isNotNull(), "promoted_canonical_id": F.coalesce("_new", "promoted_canonical_id")})
    return {
        "canonicals": ready.where(F.col("_known").isNull()).select(F.col("canonical_id").alias("id"), *attributes, *extra, F.col("quality_score").alias("canonical_confidence_score")),
        "links": ready.where(F.col("_known").isNull()).select(F.col("id").alias("candidate_id"), "canonical_id"),
        "candidates": updated.drop("_new"),
        "audit": ready.select(F.lit(kind).alias("entity_type"), F.col("id").alias("candidate_id"), "canonical_id", F.lit("auto_promote").alias("action_type")),
    }


def provenance(kind: str, canonicals: DataFrame, links: DataFrame, scores: DataFrame, version: str | None, decided_by: str) -> DataFrame:
    """One row per canonical and tracked attribute: its value as text and the candidate it came from."""
    tracked = [a for a in TRACKED[kind] if a in canonicals.columns]
    wide = canonicals.select(F.col("id").alias("canonical_id"), *[F.col(a).cast("string").alias(a) for a in tracked])
    tall = wide.unpivot(["canonical_id"], tracked, "attribute_name", "attribute_value")
    origin = links.groupBy("canonical_id").agg(F.min("candidate_id").alias("candidate_id")).join(scores.select(F.col("id").alias("candidate_id"), F.col("quality_score").alias("source_score")), "candidate_id", "left")
    return tall.join(origin, "canonical_id", "left").select(F.lit(kind).alias("entity_type"), "canonical_id", "attribute_name", "attribute_value", F.col("candidate_id").alias("source_candidate_id"), "source_score", F.lit(version).alias("rule_version"), F.lit(decided_by).alias("decided_by"))


def manual(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Outcome of manual decisions (candidate_id, action, seq): the last per candidate counts.

    promote, reject and hold; a promoted candidate can't be rejected or held,
    and one in reject must pass review before it is promoted.
    """
    d = latest_per_key(decisions, ["candidate_id"], [F.desc("seq")])
    j = d.join(candidates.select(F.col("id").alias("candidate_id"), "resolution_state", "is_promoted", F.lit(True).alias("_known")), "candidate_id", "left")
    promoted = F.coalesce(F.col("is_promoted"), F.lit(False))
    outcome = (
        F.when(F.col("_known").isNull(), "invalid: unknown candidate")
        .when(~F.col("action").isin("promote", "reject", "hold"), "invalid: unknown action")
        .when((F.col("action") == "promote") & promoted, "skipped: already promoted")
        .when(promoted, "invalid: promoted")
        .otherwise("applied")
    )
    state = F.when(outcome == "applied", F.when(F.col("action") == "promote", "auto_promote").otherwise(F.col("action")))
    return j.select("candidate_id", "action", "seq", outcome.alias("outcome"), state.alias("new_state"), F.coalesce((outcome == "applied") & (F.col("action") == "promote") & (F.col("resolution_state") == "reject"), F.lit(False)).alias("through_review"))


def relinked(candidates: DataFrame, links: DataFrame, canonicals: DataFrame | None) -> DataFrame:
    """Candidates that are marked as promoted but whose canonical is gone, or that have no link, are open again."""
    live = links if canonicals is None else links.join(canonicals.select(F.col("id").alias("canonical_id")), "canonical_id", "left_semi")
    held = live.select(F.col("candidate_id").alias("id"), F.lit(True).alias("_held")).distinct()
    stale = F.coalesce("is_promoted", F.lit(False)) & F.col("_held").isNull()
    out = candidates.join(held, "id", "left")
    return out.withColumns({"promoted_canonical_id": F.when(stale, F.lit(None)).otherwise(F.col("promoted_canonical_id")), "is_promoted": F.when(stale, False).otherwise(F.col("is_promoted"))}).select(*candidates.columns)


def checked_merges(decisions: DataFrame, canonicals: DataFrame, links: DataFrame) -> DataFrame:
    """Status of merge decisions (keep_id, merge_id, seq) taken one after another: applied, or why not.

    Both ids must exist, which an id that an earlier applied decision merged away
    no longer does, and the merged one must have candidates by then: its own or
    some merged into it before. Invalid decisions change nothing. Who is merged
    away when is guessed, and corrected until the guess explains itself; each
    round settles at least the earliest decision that is still open.
    """
    ids = canonicals.select("id").distinct()
    owned = links.select(F.col("canonical_id").alias("merge_id")).distinct()
    d = decisions.select("keep_id", "merge_id", "seq")
    d = d.join(ids.select(F.col("id").alias("keep_id"), F.lit(True).alias("_k")), "keep_id", "left")
    d = d.join(ids.select(F.col("id").alias("merge_id"), F.lit(True).alias("_m")), "merge_id", "left")
    d = d.join(owned.withColumn("_l", F.lit(True)), "merge_id", "left")
    known = table(d.withColumn("applied", F.col("_k").isNotNull() & F.col("_m").isNotNull() & (F.col("keep_id") != F.col("merge_id"))), "decisions")
    while True:
        done = known.where("applied")
        gone = done.groupBy(F.col("merge_id").alias("_id")).agg(F.min("seq").alias("_gone"))
        given = done.groupBy(F.col("keep_id").alias("_id")).agg(F.min("seq").alias("_given"))
        j = known.withColumnRenamed("applied", "_was")
        j = j.join(gone.select(F.col("_id").alias("keep_id"), F.col("_gone").alias("_kgone")), "keep_id", "left")
        j = j.join(gone.select(F.col("_id").alias("merge_id"), F.col("_gone").alias("_mgone")), "merge_id", "left")
        j = j.join(given.select(F.col("_id").alias("merge_id"), "_given"), "merge_id", "left")
        late = lambda c: F.coalesce(F.col(c) < F.col("seq"), F.lit(False))
        status = (
            F.when(F.col("_k").isNull() | late("_kgone"), "invalid: keep_id not found")
            .when(F.col("_m").isNull() | late("_mgone"), "invalid: merge_id not found")
            .when(F.col("keep_id") == F.col("merge_id"), "invalid: same id")
            .when(F.col("_l").isNull() & ~late("_given"), "invalid: no linked candidates")
            .otherwise("applied")
        )
        new = table(j.select("keep_id", "merge_id", "seq", "_k", "_m", "_l", (status == "applied").alias("applied"), status.alias("status"), "_was"), "decisions")
        discard(known)
        if not new.where("applied <> _was").limit(1).count():
            return new.select("keep_id", "merge_id", "seq", "status")
        known = new.drop("status", "_was")
        known._tidemark_path = new._tidemark_path


def merged(kind: str, canonicals: DataFrame, links: DataFrame, candidates: DataFrame, registrations: DataFrame, decisions: DataFrame) -> dict[str, DataFrame]:
    """Apply valid merges, chains included: the kept canonical's null attributes are filled in merge order.

    What was merged into a canonical before it was merged itself counts after its
    own values. Links, candidates and the registrations' references move to the
    kept id, the merged canonicals go, actions on their candidates are to be
    dismissed, and ``audit`` tells of each decision.
    """
    checked = checked_merges(decisions, canonicals, links)
    ok = checked.where("status = 'applied'")
    ids = closed_map(ok.select(F.col("merge_id").alias("old_id"), F.col("keep_id").alias("new_id"), F.col("seq").cast("long").alias("seq")), "seq")
    fields = [c for c in canonicals.columns if c != "id"]
    to = ids.select(F.col("old_id").alias("id"), F.col("new_id").alias("_to"), "path")
    ranked = canonicals.join(to, "id", "left").withColumn("_at", F.coalesce("path", F.array().cast("array<bigint>")))
    kept = ranked.groupBy(F.coalesce("_to", "id").alias("id")).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in fields])
    pairs = ids.select("old_id", "new_id")
    return {
        "canonicals": kept.select(*canonicals.columns),
        "links": remapped(links, pairs, ["canonical_id"]),
        "candidates": remapped(candidates, pairs, ["promoted_canonical_id"]),
        "registrations": remapped(registrations, pairs, [REFERENCES[kind]]) if kind in REFERENCES else registrations,
        "dismissed": links.join(pairs.select(F.col("old_id").alias("canonical_id")), "canonical_id", "left_semi").select("candidate_id"),
        "audit": checked.select(F.lit(kind).alias("entity_type"), F.lit("merge").alias("action_type"), F.col("merge_id").alias("entity_id"), F.col("keep_id").alias("target_id"), "seq", "status"),
    }


def detached(kind: str, canonicals: DataFrame, links: DataFrame, candidates: DataFrame, registrations: DataFrame, ids: DataFrame, delete: bool) -> dict[str, DataFrame]:
    """Demote (``delete``) or unlink candidates: they go back to review.

    On demotion a canonical without links left goes too, and references to it
    are cleared; unlinking keeps it.
    """
    gone = ids.select(F.col("candidate_id")).distinct()
    left = links.join(gone, "candidate_id", "left_anti")
    back = F.col("_hit").isNotNull() & F.coalesce(F.col("is_promoted"), F.lit(False))
    marked = candidates.join(gone.select(F.col("candidate_id").alias("id"), F.lit(True).alias("_hit")), "id", "left")
    updated = marked.withColumns(
        {"resolution_state": F.when(back, "review").otherwise(F.col("resolution_state")), "promoted_canonical_id": F.when(back, F.lit(None)).otherwise(F.col("promoted_canonical_id")), "is_promoted": F.when(back, False).otherwise(F.col("is_promoted"))}
    ).select(*candidates.columns)
    out = {"links": left, "candidates": updated, "canonicals": canonicals, "registrations": registrations}
    if delete:
        lone = links.join(gone, "candidate_id", "left_semi").select("canonical_id").distinct().join(left.select("canonical_id"), "canonical_id", "left_anti")
        out["canonicals"] = canonicals.join(lone.select(F.col("canonical_id").alias("id")), "id", "left_anti")
        if kind in REFERENCES:
            none = lone.select(F.col("canonical_id").alias("old_id"), F.lit(None).cast("string").alias("new_id"))
            out["registrations"] = remapped(registrations, none, [REFERENCES[kind]])
        out["dismissed"] = links.join(gone, "candidate_id", "left_semi").select("candidate_id")
    known = links.join(gone, "candidate_id").select("candidate_id", F.min("canonical_id").over(Window.partitionBy("candidate_id")).alias("target_id")).distinct()
    action = "demote" if delete else "unlink"
    status = F.when(F.col("target_id").isNull(), "invalid: not linked").otherwise("applied")
    out["audit"] = gone.join(known, "candidate_id", "left").select(
        F.lit(kind).alias("entity_type"), F.lit(action).alias("action_type"), F.col("candidate_id").alias("entity_id"), "target_id", F.lit(None).cast("long").alias("seq"), status.alias("status")
    )
    return out


def dismissed(actions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Actions with the open ones on the given candidates (candidate_id) dismissed."""
    gone = candidates.select(F.col("candidate_id").alias("target_entity_id"), F.lit(True).alias("_hit")).distinct()
    status = F.when(F.col("_hit") & (F.col("status") == "open"), "dismissed").otherwise(F.col("status"))
    return actions.join(gone, "target_entity_id", "left").withColumn("status", status).select(*actions.columns)


def dispatched(rows: DataFrame, needs: Sequence[str], kind_column: str) -> DataFrame:
    """Decision rows with trimmed fields, the kind in lower case, their order and why they are invalid, if they are."""
    clean = {c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in rows.columns if not c.startswith("_")}
    d = rows.withColumns(clean).withColumn(kind_column, F.lower(kind_column))
    bad = [F.when(F.col(c).isNull(), f"invalid: missing {c}") for c in needs]
    return d.withColumn("invalid", F.coalesce(*bad, F.when(~F.col(kind_column).isin(*TRACKED), F.concat(F.lit("invalid: unknown kind "), kind_column))))


def split(kind: str, canonicals: DataFrame, links: DataFrame, decisions: DataFrame) -> dict[str, DataFrame]:
    """Move candidates (old_id, candidate_id) to a clone of their canonical, one clone per old id; ``audit`` tells of each decision."""
    real = decisions.join(links.select("candidate_id", F.col("canonical_id").alias("old_id")), ["candidate_id", "old_id"], "left_semi")
    made = real.groupBy("old_id").agg(F.array_join(F.sort_array(F.collect_set("candidate_id")), ",").alias("_c")).select("old_id", entity_id(f"split_{kind}", F.col("old_id"), F.col("_c")).alias("new_id"))
    clones = canonicals.join(made, canonicals["id"] == made["old_id"]).select(F.col("new_id").alias("id"), *[c for c in canonicals.columns if c != "id"])
    moves = real.join(made, "old_id").select("candidate_id", F.col("new_id").alias("_new"))
    told = decisions.select("old_id", "candidate_id").distinct().join(moves, "candidate_id", "left")
    status = F.when(F.col("_new").isNull(), "invalid: not linked").otherwise("applied")
    return {
        "canonicals": canonicals.unionByName(clones),
        "links": links.join(moves, "candidate_id", "left").select("candidate_id", F.coalesce("_new", "canonical_id").alias("canonical_id")),
        "moved": moves.select("candidate_id", F.col("_new").alias("canonical_id")),
        "audit": told.select(
            F.lit(kind).alias("entity_type"), F.lit("split").alias("action_type"), F.col("candidate_id").alias("entity_id"), F.coalesce("_new", "old_id").alias("target_id"), F.lit(None).cast("long").alias("seq"), status.alias("status")
        ),
    }


def coverage(kind: str, candidates: DataFrame, links: DataFrame, unresolved: int = 0, limit: float = 90.0) -> DataFrame:
    """One row: share promoted in percent, links, unresolved references and whether the limit is met; null without candidates."""
    n = F.count("*")
    promoted = F.count_if(F.coalesce(F.col("is_promoted"), F.lit(False)))
    pct = F.when(n > 0, F.round(promoted * 100.0 / n, 2))
    row = candidates.agg(n.alias("candidates_total"), promoted.alias("candidates_promoted"), pct.alias("pct_promoted"))
    linked = links.agg(F.count("*").alias("links_total"))
    return row.join(linked, F.lit(True)).select(F.lit(kind).alias("entity_type"), "*", F.lit(unresolved).alias("unresolved_dependencies"), (F.coalesce(F.col("pct_promoted") >= limit, F.lit(False)) & F.lit(unresolved == 0)).alias("passed"))


def under_combined(candidates: DataFrame) -> DataFrame:
    """Names with candidates both with and without an e-mail."""
    per = candidates.where(F.col("normalized_name").isNotNull()).groupBy("normalized_name").agg(F.bool_or(F.col("best_email").isNull()).alias("a"), F.bool_or(F.col("best_email").isNotNull()).alias("b"), F.count("*").alias("n"))
    return per.where("a and b").select("normalized_name", "n")


def remediation(candidates: DataFrame) -> DataFrame:
    """loser_id to winner_id per under-combined name.

    The winner ranks by e-mail, promotion, score, time of update and id; losers
    are rejected, unpromoted and without e-mail.
    """
    rows = candidates.join(under_combined(candidates), "normalized_name", "left_semi")
    order = [F.desc(F.col("best_email").isNotNull()), F.desc(F.coalesce("is_promoted", F.lit(False))), F.desc_nulls_last("quality_score"), F.desc_nulls_last("updated_at"), F.asc("id")]
    best = latest_per_key(rows, ["normalized_name"], order).select("normalized_name", F.col("id").alias("winner_id"))
    loses = (F.col("resolution_state") == "reject") & ~F.coalesce("is_promoted", F.lit(False)) & F.col("best_email").isNull()
    return rows.where(loses).join(best, "normalized_name").where(F.col("id") != F.col("winner_id")).select(F.col("id").alias("loser_id"), "winner_id")


def absorbed(candidates: DataFrame, children: dict[str, tuple[DataFrame, Sequence[str]]], losers: DataFrame, fields: Sequence[str]) -> dict[str, DataFrame]:
    """Apply a remediation map: winners' null fields are filled from losers by id, child rows move and are deduplicated, losers go.

    ``children``: name to (rows with candidate_id, key columns without it).
    """
    ids = losers.select(F.col("loser_id").alias("old_id"), F.col("winner_id").alias("new_id"))
    given = candidates.join(ids.select(F.col("old_id").alias("id"), "new_id"), "id").groupBy(F.col("new_id").alias("id")).agg(*[F.min_by(f, F.when(F.col(f).isNotNull(), F.col("id"))).alias(f"_{f}") for f in fields])
    rest = candidates.join(ids.select(F.col("old_id").alias("id")), "id", "left_anti").join(given, "id", "left")
    out = {"candidates": rest.withColumns({f: F.coalesce(f, f"_{f}") for f in fields}).select(*candidates.columns)}
    for name, (rows, keys) in children.items():
        out[name] = remapped(rows, ids, ["candidate_id"]).dropDuplicates(["candidate_id", *keys])
    return out


def prevented(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows without e-mail join the one candidate of their name that has one; several leave them alone, with a warning."""
    per = candidates.where(F.col("best_email").isNotNull() & F.col("normalized_name").isNotNull()).groupBy("normalized_name").agg(F.count_distinct("id").alias("_n"), F.min("id").alias("_id"))
    j = rows.join(per, "normalized_name", "left")
    bare: Column = F.col("best_email").isNull()
    return j.withColumns({"reuse_id": F.when(bare & (F.col("_n") == 1), F.col("_id")), "ambiguous_name": F.coalesce(bare & (F.col("_n") > 1), F.lit(False))}).drop("_n", "_id")
