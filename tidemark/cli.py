"""Command line: ``python -m tidemark.cli --mode MODE --store PATH [--input NAME=PATH ...] [--dry-run]``.

A mode reads tables of the store or feed files, stages new versions and
publishes them together once its gates hold; a dry run does all but publish.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys, urls
from tidemark.lineage import table
from tidemark.operators import expect, gates, lifecycle, match, merge, scoring
from tidemark.operators.rules import KINDS, SHIPPED, load, register
from tidemark.plans import audience, candidates, enrich, geo_ready, ingest, operational, views
from tidemark.sources import feeds, pages
from tidemark.store import Store

MODES: dict[str, Callable[[SparkSession, Store, argparse.Namespace], dict]] = {}


def mode(f):
    MODES[f.__name__] = f
    return f


RAW_KEY = ["source_system", "feed", "source_file", "row_hash"]


def _merged(store: Store, name: str, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append to a table what it lacks."""
    if store.has(name):
        old = store.read(name)
        new = old.unionByName(merge.insert_absent(old, new, keys), allowMissingColumns=True)
    return store.stage(name, new)


def _appended(store: Store, name: str, new: DataFrame) -> DataFrame:
    """Append rows to a log."""
    return store.stage(name, store.read(name).unionByName(new, allowMissingColumns=True) if store.has(name) else new)


def _tables(spark: SparkSession, store: Store) -> operational.Tables:
    return operational.Tables(spark, {n: store.read(f"operational_{n}") for n in operational.SCHEMAS if store.has(f"operational_{n}")})


def _keep(store: Store, t: operational.Tables) -> dict[str, int]:
    """Stage the operational tables that have changed; their numbers of rows."""
    return {n: store.stage(f"operational_{n}", t[n]).count() for n in sorted(t.changed)}


def _captured(store: Store, df: DataFrame, feed: str) -> DataFrame:
    """Keep each row of a feed raw, whatever becomes of it, and mark it with the hash of its payload."""
    _merged(store, f"raw_{feed}", feeds.raw(df, feed).drop("_ordinal"), RAW_KEY)
    own = [c for c in df.columns if not c.startswith("_")]
    return df.withColumn("row_hash", keys.row_hash(*own)) if own else df.withColumn("row_hash", F.lit(None).cast("string"))


def _split(store: Store, args, feed: str, rows: DataFrame, limit: bool = True) -> tuple[DataFrame, dict]:
    """Accepted rows, staged; rejects are staged, and written as CSV below ``--rejects``. Too many rejects end the run."""
    if limit:
        gates.rate_gate(rows, F.col("reject_reason").isNotNull(), args.max_reject_rate, "rejected rows")
    good, bad = gates.split(rows)
    store.stage(f"rejects_{feed}", bad)
    if args.rejects:
        gates.write_rejects(bad, f"{args.rejects}/{feed}")
    counts = gates.counters(rows, rows_rejected=F.col("reject_reason").isNotNull()).first().asDict()
    return store.stage(f"staged_{feed}", good), counts


def _torn(store: Store, args, feed: str, rejects: DataFrame) -> int:
    """Stage the rows that could not be resolved, and count them."""
    out = store.stage(f"unresolved_{feed}", rejects)
    if args.rejects:
        gates.write_rejects(out, f"{args.rejects}/{feed}_unresolved")
    return out.count()


def _today(args) -> Column:
    return F.lit(args.today).cast("date")


@mode
def owner_export(spark, store, args):
    """Owners, their boats and entries of the event that --event-name, --host-club and --season-year name."""
    df = _captured(store, feeds.scan(spark, "owners", args.input["owners"]), "owners")
    good, counts = _split(store, args, "owners", ingest.staged_owners(df))
    if args.event_name:
        t = _tables(spark, store)
        event = {"club_name": args.host_club, "series_name": args.event_name, "display_name": args.event_display_name or args.event_name, "season_year": args.season_year}
        rejects = operational.ingest_owners(t, good, event, today=_today(args))
        counts |= {"rows_unresolved": _torn(store, args, "owners", rejects)} | _keep(store, t)
    return counts


@mode
def public_scrape(spark, store, args):
    """Public events and entries."""
    shown = _captured(store, feeds.scan(spark, "public_events", args.input["public_events"]), "public_events")
    events = store.stage("staged_public_events", ingest.staged_events(shown, args.base_url))
    df = _captured(store, feeds.scan(spark, "public_entries", args.input["public_entries"]), "public_entries")
    good, counts = _split(store, args, "public_entries", ingest.staged_entries(df, events, args.base_url, not args.no_synthesize))
    t = _tables(spark, store)
    rejects = operational.ingest_public(t, events, good)
    lost = _torn(store, args, "public_entries", rejects)
    if counts["rows_read"] and lost / counts["rows_read"] > args.max_unresolved_rate:
        raise gates.GateError(f"unresolved rows: {lost} of {counts['rows_read']}")
    return counts | {"events_without_race_id": shown.count() - events.count(), "rows_unresolved": lost} | _keep(store, t)


@mode
def waivers(spark, store, args):
    """Waivers: people, contacts, guardians, the entry of --event-instance and the paper --requirement."""
    df = _captured(store, feeds.scan(spark, "waivers", args.input["waivers"]), "waivers")
    good, counts = _split(store, args, "waivers", ingest.staged_waivers(df))
    related = dict(x.split("=", 1) for x in args.related)
    t = _tables(spark, store)
    linked = operational.ingest_waivers(t, good, related, args.requirement, args.event_instance)
    if "link_warning" in linked.columns:
        counts["link_warnings"] = [r.warning for r in gates.warnings(linked, F.col("link_warning").isNotNull(), F.col("link_warning"), "_ordinal", 20).collect()]
    return counts | _keep(store, t)


@mode
def audience_contacts(spark, store, args):
    """Audience files: states, tags, provider ids and people by the strict identity policy."""
    parts = []
    for feed, status, at in feeds.AUDIENCE:
        df = _captured(store, feeds.scan(spark, feed, args.input[feed]), feed)
        parts.append(df.withColumns({"audience_status": F.lit(status), "status_at_raw": F.col(at), "_ordinal": F.col("_ordinal") + (len(parts) << 52)}))
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    good, counts = _split(store, args, "audience", ingest.staged_audience(rows))
    t = _tables(spark, store)
    quarantined = operational.ingest_audience(t, good, args.allow_missing_name)
    counts["quarantined"] = {r.reason_code: r["count"] for r in quarantined.groupBy("reason_code").count().collect()}
    return counts | _keep(store, t)


@mode
def base_copy(spark, store, args):
    """The six files of a base copy; a missing file ends the run before anything is written."""
    scans = {feed: feeds.scan(spark, feed, args.input[feed]) for feed in feeds.BASE_ORDER}
    counts, staged = {}, {}
    for feed, df in scans.items():
        staged[feed], found = _split(store, args, feed, ingest.staged_base(_captured(store, df, feed), feed), limit=False)
        counts |= {feed: found["rows_read"] - found["rows_rejected"], f"{feed}_rejected": found["rows_rejected"]}
    counts["odd_source_tags"] = staged["base_events"].where(~F.coalesce("source_ok", F.lit(False))).count()
    t = _tables(spark, store)
    for feed, rejects in operational.ingest_base(t, staged, F.lit(args.today), _today(args)).items():
        counts[f"{feed}_unresolved"] = _torn(store, args, feed, rejects)
    return counts | _keep(store, t)


@mode
def race_scoring(spark, store, args):
    """All race-scoring files below a folder, or those named; files of unknown kind are only kept raw."""
    where = args.input["race_files"]
    found = feeds.race_scan(spark, where.split(",") if "," in where or where.lower().endswith(".csv") else feeds.discovered(spark, where))
    counts, t, seen = {}, _tables(spark, store), F.lit(args.today)
    for kind in feeds.RACE_ORDER:
        if kind not in found:
            continue
        df = _captured(store, found[kind], kind)
        counts[kind] = df.count()
        if kind == "race_events":
            lost = operational.ingest_race_events(t, df, seen)
        elif kind == "race_yachts":
            lost = operational.ingest_race_yachts(t, df, seen)
        elif kind == "unknown":
            continue
        else:
            lost = operational.ingest_race_entries(t, store.stage(f"staged_{kind}", ingest.staged_race_entries(df, kind)), seen)
        counts[f"{kind}_rejected"] = _torn(store, args, kind, lost)
    return counts | _keep(store, t)


@mode
def directory_profiles(spark, store, args):
    """Pages (member_id, html, card) that a crawl has landed, to candidates in review."""
    rows = spark.read.parquet(args.input["pages"]).select("member_id", pages.profile(F.col("html")).alias("p"), pages.vcard(F.col("card")).alias("v"))
    members, household = ingest.profile_candidates(pages.merged_profile(rows))
    return {"members": store.stage("directory_members", members).count(), "household": store.stage("directory_household", household).count()}


def _people(rows: DataFrame, name: str, shown: str, mail: str, phone: str, pk: str, place: str = "null") -> DataFrame:
    exprs = {"normalized_name": name, "display_name": shown, "best_email": mail, "best_phone": phone, "address_raw": place, "source_pk": pk}
    out = rows.selectExpr(*[f"cast({e} as string) as {c}" for c, e in exprs.items()])
    return out.withColumns({"date_of_birth": F.lit(None).cast("date"), "seq": F.col("source_pk")})


#: People in staged feeds: columns, the role they are seen in, and whether rows without e-mail join others of their name.
PEOPLE = (
    ("waivers", ("name_key", "Name", "email", "phone", "submission_id"), "registrant", True),
    ("base_participants", ("name_key", "full_name", "email", "phone", "source_id", "address_raw"), None, False),
    ("base_owners", ("name_key", "full_name", "email", "phone", "source_id", "address_raw"), None, False),
    ("race_entries_plain", ("name_key", "full_name", "null", "null", "row_hash"), "owner", True),
    ("race_entries", ("name_key", "full_name", "null", "null", "row_hash"), "owner", True),
)


@mode
def source_to_candidate(spark, store, args):
    """Candidates of all kinds: first from the operational tables, then from feeds, and links from raw rows to what they became."""
    held = {n: store.read(n) for n in ("source_links", *[f"candidate_{k}" for k in (*candidates.SCHEMAS, *candidates.CHILDREN)]) if store.has(n)}
    b, t = candidates.Builder(spark, held), _tables(spark, store)
    candidates.from_operational(b, t)
    for feed, exprs, role, prevent in PEOPLE:
        if store.has(f"staged_{feed}"):
            b.add_people(_people(store.read(f"staged_{feed}"), *exprs), feed, role, prevent)
    candidates.from_audience(b, t["audience_state"], t["identity_queue"])
    seen = t["related_contact"].withColumn("pk", F.concat_ws("|", "participant_id", "related_type", "name_key"))
    for kind in ("guardian", "emergency_contact"):
        b.add_people(_people(seen.where(F.col("related_type") == kind), "name_key", "full_name", "null", "null", "pk"), f"related_{kind}", kind)
    out: dict = {"bridges": {}}
    if not args.no_bridges:
        for feed in candidates.BRIDGES:
            rows = _bridged_rows(store, feed)
            if rows is not None:
                lost = candidates.bridge(b, feed, rows, t, "race_scoring" if feed.startswith("race") else "base_copy")
                out["bridges"][feed] = {str(r.failed_hop or "linked"): r.n for r in lost.collect()}
    states = {"resolution_state": F.lit(None).cast("string"), "quality_score": F.lit(None).cast("decimal(5,4)"), "is_promoted": F.lit(False), "promoted_canonical_id": F.lit(None).cast("string")}
    for kind, df in b.kinds.items():
        df = df.withColumn("id", keys.entity_id(f"candidate_{kind}", F.col("stable_fingerprint")))
        if f"candidate_{kind}" in held:
            old = held[f"candidate_{kind}"]
            extra = [c for c in old.columns if c not in df.columns]
            df = df.join(old.select("id", *extra), "id", "left").withColumn("is_promoted", F.coalesce("is_promoted", F.lit(False)))
        else:
            df = df.withColumns(states)
        out[f"{kind}_candidates"] = store.stage(f"candidate_{kind}", df).count()
    for name, df in b.children.items():
        out[f"{name}_rows"] = store.stage(f"candidate_{name}", df).count()
    out["source_links"] = store.stage("source_links", b.links).count()
    out["ambiguous_names"] = b.warned.count() if b.warned is not None else 0
    if b.warned is not None:
        out["warnings"] = [r.warning for r in gates.warnings(b.warned, F.lit(True), F.concat(F.lit("several candidates share the name "), "normalized_name"), "source_pk", 20).collect()]
    out["skipped_tables"] = {r.table: r.reason for r in candidates.skipped(spark).collect()}
    return out


def _bridged_rows(store: Store, feed: str) -> DataFrame | None:
    """Raw rows of a feed with the key that leads to what they became."""
    if feed in ("race_events", "race_yachts"):
        if not store.has(f"raw_{feed}"):
            return None
        raw = store.read(f"raw_{feed}")
        get = lambda n: F.get_json_object("payload", f"$['{n}']")
        if feed == "race_events":
            return raw.select("row_hash", urls.number_after(get("title-small href"), "emenu").alias("event_id"))
        return raw.select("row_hash", keys.yacht_key(get("yachtName"), get("sailNumber")).alias("boat_key"))
    if not store.has(f"staged_{feed}"):
        return None
    rows = store.read(f"staged_{feed}")
    if feed == "race_entries_plain":
        rows = rows.withColumn("entry_key", F.when(F.col("entry_id").isNotNull(), F.concat_ws("|", "event_id", "entry_id")))
    return rows


def _decisions(spark: SparkSession, args, feed: str, needs: list[str], kind_column: str) -> DataFrame:
    """Rows of a decision file in order, with trimmed fields, and why they are invalid, if they are."""
    return lifecycle.dispatched(feeds.scan(spark, feed, args.input["decisions"]), needs, kind_column).withColumn("seq", F.col("_ordinal"))


def _audited(store: Store, args, rows: DataFrame) -> None:
    _appended(store, "audit", rows.withColumns({"run_id": F.lit(args.run_id), "decided_on": F.lit(args.today)}))


def _links(spark: SparkSession, store: Store, kind: str) -> DataFrame:
    return store.read(f"links_{kind}") if store.has(f"links_{kind}") else spark.createDataFrame([], "candidate_id string, canonical_id string")


@mode
def manual_apply(spark, store, args):
    """Decisions (candidate_entity_type, candidate_entity_id, action, actor) in order; those that apply change states, and kinds can be scored again."""
    d = _decisions(spark, args, "manual_decisions", ["candidate_entity_type", "candidate_entity_id", "action", "actor"], "candidate_entity_type")
    invalid = d.where("invalid is not null")
    out: dict = {"invalid": invalid.count()}
    audit = invalid.select(F.col("candidate_entity_type").alias("entity_type"), F.col("action").alias("action_type"), F.col("candidate_entity_id").alias("entity_id"), F.lit(None).cast("string").alias("target_id"), "seq", F.col("invalid").alias("status"))
    for kind in KINDS:
        rows = d.where((F.col("candidate_entity_type") == kind) & F.col("invalid").isNull())
        if not store.has(f"candidate_{kind}") or not rows.limit(1).count():
            continue
        people, links = store.read(f"candidate_{kind}"), _links(spark, store, kind)
        people = lifecycle.relinked(people, links, store.read(f"canonical_{kind}") if store.has(f"canonical_{kind}") else None)
        done = store.stage(f"manual_outcomes_{kind}", lifecycle.manual(people, rows.select(F.col("candidate_entity_id").alias("candidate_id"), F.lower("action").alias("action"), "seq")))
        new = done.where("new_state is not null").select(F.col("candidate_id").alias("id"), "new_state")
        people = people.join(new, "id", "left").withColumn("resolution_state", F.coalesce("new_state", "resolution_state")).select(*people.columns)
        if args.rescore:
            rescored = scoring.scored(people, kind)
            keep = new.withColumnRenamed("new_state", "_n")
            people = rescored.join(keep, "id", "left").withColumn("resolution_state", F.coalesce("_n", "resolution_state")).drop("_n")
        store.stage(f"candidate_{kind}", people)
        told = done.select(F.lit(kind).alias("entity_type"), F.col("action").alias("action_type"), F.col("candidate_id").alias("entity_id"), F.lit(None).cast("string").alias("target_id"), F.col("seq").cast("long").alias("seq"), F.col("outcome").alias("status"))
        audit = audit.unionByName(told)
        out |= {f"{kind}_{r.outcome}": r["count"] for r in done.groupBy("outcome").count().collect()}
    _audited(store, args, audit)
    return out


def _registrations(spark: SparkSession, store: Store) -> DataFrame:
    if store.has("canonical_registration"):
        return store.read("canonical_registration")
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in ("id", *lifecycle.REFERENCES.values())))


def _lifecycle(spark, store, args, feed: str, needs: list[str], kind_column: str, names: dict[str, str], apply) -> dict:
    """Apply decisions of a file kind by kind: tables, audit, and dismissal of actions on the candidates concerned."""
    d = _decisions(spark, args, feed, needs, kind_column)
    invalid = d.where("invalid is not null")
    out: dict = {"invalid": invalid.count()}
    audit = None
    for kind in KINDS:
        rows = d.where((F.col(kind_column) == kind) & F.col("invalid").isNull()).select(*[F.col(c).alias(n) for c, n in names.items()], "seq")
        if not store.has(f"canonical_{kind}") or not rows.limit(1).count():
            continue
        canon, links, people = (store.read(f"{n}_{kind}") for n in ("canonical", "links", "candidate"))
        regs = canon if kind == "registration" else _registrations(spark, store)
        done = apply(kind, canon, links, people, regs, rows)
        for name, part in (("canonical", "canonicals"), ("links", "links"), ("candidate", "candidates")):
            if part in done:
                store.stage(f"{name}_{kind}", done[part])
        if kind in lifecycle.REFERENCES and "registrations" in done and store.has("canonical_registration"):
            store.stage("canonical_registration", done["registrations"])
        if "dismissed" in done and store.has(f"actions_{kind}"):
            store.stage(f"actions_{kind}", lifecycle.dismissed(store.read(f"actions_{kind}"), done["dismissed"]))
        audit = done["audit"] if audit is None else audit.unionByName(done["audit"])
        out |= {f"{kind}_{r.status}": r["count"] for r in done["audit"].groupBy("status").count().collect()}
    if audit is not None:
        _audited(store, args, audit)
    return out


@mode
def lifecycle_merge(spark, store, args):
    """Merge decisions (canonical_entity_type, keep_canonical_id, merge_canonical_id, reason_code, actor), one after another."""
    names = {"keep_canonical_id": "keep_id", "merge_canonical_id": "merge_id"}
    return _lifecycle(spark, store, args, "merge_decisions", ["canonical_entity_type", *names, "reason_code", "actor"], "canonical_entity_type", names, lifecycle.merged)


DETACH = {"candidate_entity_id": "candidate_id"}


@mode
def lifecycle_demote(spark, store, args):
    """Demote candidates: back to review, and canonicals without links left go."""
    return _lifecycle(spark, store, args, "demote_decisions", ["candidate_entity_type", *DETACH, "reason_code", "actor"], "candidate_entity_type", DETACH, lambda *a: lifecycle.detached(*a, delete=True))


@mode
def lifecycle_unlink(spark, store, args):
    """Unlink candidates: back to review, canonicals and actions stay."""
    return _lifecycle(spark, store, args, "demote_decisions", ["candidate_entity_type", *DETACH, "reason_code", "actor"], "candidate_entity_type", DETACH, lambda *a: lifecycle.detached(*a, delete=False))


@mode
def lifecycle_split(spark, store, args):
    """Split candidates off their canonical, to one clone per canonical."""
    names = {"old_canonical_id": "old_id", "candidate_entity_id": "candidate_id"}

    def apply(kind, canon, links, people, regs, rows):
        done = lifecycle.split(kind, canon, links, rows)
        moved = done["moved"].select(F.col("candidate_id").alias("id"), F.col("canonical_id").alias("_to"))
        done["candidates"] = people.join(moved, "id", "left").withColumn("promoted_canonical_id", F.coalesce("_to", "promoted_canonical_id")).select(*people.columns)
        return done

    return _lifecycle(spark, store, args, "split_decisions", ["canonical_entity_type", *names, "reason_code", "actor"], "canonical_entity_type", names, apply)


@mode
def score(spark, store, args):
    """Score all kinds; a kind that fails leaves the others as they are scored. Rule sets and runs are recorded."""
    out, runs, failed = {}, [], {}
    registry = [r.asDict() for r in store.read("rule_sets").collect()] if store.has("rule_sets") else []
    for kind in ("club", "event", "yacht", "participant", "registration"):
        name, began = f"candidate_{kind}", dt.datetime.now().isoformat()
        if not store.has(name):
            continue
        try:
            rules = load(open(args.input[f"rules_{kind}"]).read()) if f"rules_{kind}" in args.input else SHIPPED[kind]
            registry, rule_id = register(registry, rules)
            rows = store.read(name).drop("quality_score", "confidence_reasons", "staged")
            if kind == "participant" and store.has("candidate_contact") and store.has("candidate_address"):
                seen = scoring.child_evidence(store.read("candidate_contact"), store.read("candidate_address")).withColumnRenamed("candidate_id", "id")
                rows = rows.drop("child_email", "child_phone", "child_address").join(seen, "id", "left")
            rows = store.stage(name, scoring.scored(rows, kind, rules))
            fresh = scoring.suggestions(rows, kind, rules)
            store.stage(f"actions_{kind}", scoring.refreshed_suggestions(store.read(f"actions_{kind}"), fresh) if store.has(f"actions_{kind}") else fresh)
            states = {r.resolution_state: r["count"] for r in rows.groupBy("resolution_state").count().collect()}
            out |= {f"{kind}_{k}": v for k, v in states.items()}
            runs.append((args.run_id, kind, rule_id, "ok", began, dt.datetime.now().isoformat(), json.dumps(states, sort_keys=True)))
        except Exception as e:  # one kind's rules or rows must not stop the others; the run's status tells
            for n in (name, f"actions_{kind}"):
                store.unstage(n)
            failed[kind] = str(e).splitlines()[0][:200]
            runs.append((args.run_id, kind, None, "failed", began, dt.datetime.now().isoformat(), json.dumps({"error": failed[kind]})))
    if runs:
        _appended(store, "score_runs", spark.createDataFrame(runs, "run_id string, entity_type string, rule_set_id string, status string, started_at string, ended_at string, counters string"))
    if registry:
        store.stage("rule_sets", spark.createDataFrame([tuple(r[k] for k in RULE_SET) for r in registry], ", ".join(f"{k} {'boolean' if k == 'is_active' else 'string'}" for k in RULE_SET)))
    return out | ({"failed": failed} if failed else {})


RULE_SET = ("id", "entity_type", "source_system", "version", "digest", "is_active")
#: What a registration's candidates refer to.
NEEDS = {"candidate_event_id": "event", "candidate_yacht_id": "yacht", "candidate_primary_participant_id": "participant"}


@mode
def promote(spark, store, args):
    """Promote what scoring marked: registrations after what they refer to, with provenance and audit."""
    out, origin, told = {}, None, None
    made: dict[str, DataFrame] = {}
    for kind in ("club", "event", "yacht", "participant", "registration"):
        if store.has(f"candidate_{kind}"):
            rows, links = store.read(f"candidate_{kind}"), _links(spark, store, kind)
            needs = {c: made.get(k, _links(spark, store, k)) for c, k in NEEDS.items()} if kind == "registration" else {}
            if "quality_score" not in rows.columns:
                rows = rows.withColumn("quality_score", F.lit(None).cast("decimal(5,4)"))
            done = lifecycle.promote(kind, rows, links, [c for c in lifecycle.TRACKED[kind] if c in rows.columns], needs, ("candidate_yacht_id", "candidate_primary_participant_id"))
            made[kind] = store.stage(f"links_{kind}", links.unionByName(done["links"]))
            fresh = done["canonicals"].withColumnsRenamed({f"canonical_{c}": f"canonical_{c.removeprefix('candidate_')}" for c in needs})
            canon = store.stage(f"canonical_{kind}", store.read(f"canonical_{kind}").unionByName(fresh, allowMissingColumns=True) if store.has(f"canonical_{kind}") else fresh)
            store.stage(f"candidate_{kind}", done["candidates"].select(*rows.columns))
            audit = done["audit"].select("entity_type", "action_type", F.col("candidate_id").alias("entity_id"), F.col("canonical_id").alias("target_id"), F.lit(None).cast("long").alias("seq"), F.lit("applied").alias("status"))
            new = lifecycle.provenance(kind, canon.join(done["audit"].select(F.col("canonical_id").alias("id")), "id", "left_semi"), made[kind], rows, args.run_id, "promote")
            origin, told = (new, audit) if origin is None else (origin.unionByName(new), told.unionByName(audit))
            out[f"{kind}_promoted"] = audit.count()
    if origin is not None:
        on = ["entity_type", "canonical_id", "attribute_name"]
        store.stage("provenance", merge.overwrite_merge(store.read("provenance"), origin, on) if store.has("provenance") else origin)
        _audited(store, args, told)
    return out


def _coverage(spark, store, args) -> DataFrame | None:
    """Coverage of each kind; registrations whose event isn't promoted are unresolved."""
    rows = None
    for kind in KINDS:
        if store.has(f"candidate_{kind}"):
            people = store.read(f"candidate_{kind}")
            lost = 0
            if kind == "registration":
                ready = people.where("resolution_state = 'auto_promote' and not coalesce(is_promoted, false)")
                lost = expect.orphans(ready, "candidate_event_id", _links(spark, store, "event"), "candidate_id").count()
            one = lifecycle.coverage(kind, people, _links(spark, store, kind), lost, args.lineage_threshold)
            rows = one if rows is None else rows.unionByName(one)
    return rows


def _snapshot(spark, store, args) -> dict:
    rows = _coverage(spark, store, args)
    if rows is None:
        return {}
    rows = table(rows, "coverage")
    _appended(store, "lineage_snapshots", rows.withColumns({"run_id": F.lit(args.run_id), "taken_on": F.lit(args.today)}))
    return {r.entity_type: r.asDict() for r in rows.collect()}


@mode
def lineage_report(spark, store, args):
    return _snapshot(spark, store, args)


@mode
def purge_check(spark, store, args):
    """Like the report, but a kind below the threshold ends the run with an error; its snapshot is kept all the same."""
    found = _snapshot(spark, store, args)
    failed = [k for k, v in found.items() if not v["passed"]]
    if failed:
        store.publish(args.dry_run)
        raise gates.GateError(f"coverage below {args.lineage_threshold} %: {', '.join(failed)}")
    return found


@mode
def refresh_views(spark, store, args):
    """Build the standing views over the operational tables and publish them together."""
    t = _tables(spark, store)
    entries = t["entry"].select("id", F.col("instance_id").alias("event_instance_id"), "yacht_id")
    instances = t["instance"].withColumnRenamed("series_id", "event_series_id")
    crew = t["crew"].select(F.col("entry_id").alias("event_entry_id"), "participant_id", "role")
    out = {"returners": store.stage("view_returners", views.returners(t["participant"], t["series"], instances, entries, crew)).count()}
    people = t["participant"].withColumn("date_of_birth", F.lit(None).cast("date"))
    out["participants"] = store.stage("view_participants", views.enriched(people, _today(args))).count()
    if store.has("document_requirements") and store.has("document_types"):
        held = t["document_status"].withColumns({"id": F.col("status_at").cast("string"), "event_entry_id": F.lit(None).cast("string")})
        view = views.missing_documents(store.read("document_requirements"), store.read("document_types"), instances, entries, crew, held)
        out["missing_documents"] = store.stage("view_missing_documents", view).count()
    if store.has("identity_matches"):
        out["review_queue"] = store.stage("view_review_queue", views.review_queue(store.read("identity_matches"))).count()
    return out


@mode
def hold_geo_prepare(spark, store, args):
    """Readiness of held candidates with an address: stale rows are invalidated, --max-candidates limits who is looked at, others stay."""
    people, contacts, places = (store.read(f"candidate_{n}") for n in ("participant", "contact", "address"))
    fresh = geo_ready.readiness(people, contacts, places, limit=args.max_candidates)
    if store.has("readiness"):
        old = geo_ready.invalidated(store.read("readiness"), people, places)
        fresh = merge.overwrite_merge(old, table(fresh, "readiness"), ["candidate_id"])
    hints = geo_ready.hints(places)
    store.stage("geo_hints", merge.overwrite_merge(store.read("geo_hints"), hints, ["candidate_id", "address_raw"]) if store.has("geo_hints") else hints)
    rows = store.stage("readiness", fresh)
    return {r.readiness_status: r["count"] for r in rows.groupBy("readiness_status").count().collect()}


#: Clients by name that a caller registers for modes that reach a provider; without one, modes skip it.
CLIENTS: dict[str, Callable] = {}


@mode
def person_lookup(spark, store, args):
    """Ask the provider about the best held candidates, apply what passes the gates, and record the run."""
    people = store.read("candidate_participant")
    if "updated_at" not in people.columns:
        people = people.withColumn("updated_at", F.lit(None).cast("timestamp"))
    none = spark.createDataFrame([], "run_id string, candidate_id string, row_status string, verdict string, provider_person_id string, applied_field_mask array<string>, created_at timestamp")
    before = store.read("lookups") if store.has("lookups") else none
    ready = store.read("readiness") if args.only_ready else None
    picked = table(enrich.mode(enrich.chosen(people, before, _today(args), missing=args.missing, cooldown=args.cooldown_days, limit=args.max_candidates, ready=ready)), "picked")
    client = enrich.null_client if args.dry_run or "person_lookup" not in CLIENTS else CLIENTS["person_lookup"]
    asked = picked.where("search_mode = 'email_lookup'").select("id", "display_name", "best_email")
    answers = table(enrich.looked_up(asked, client), "answers")
    gated = table(enrich.gated(picked, answers), "gated")
    filled, contacts = enrich.applied(gated)
    filled = table(filled, "filled")
    told = gated.drop("best_email", "best_phone").join(filled.select("id", "applied_field_mask"), "id", "left")
    rows = store.stage("lookups", before.unionByName(enrich.lookup_rows(told, args.run_id, _today(args).cast("timestamp"))))
    run = enrich.run_row(rows.where(F.col("run_id") == args.run_id), args.run_id, args.max_api_failure_rate)
    _appended(store, "lookup_runs", run)
    given = filled.select("id", F.col("best_email").alias("_m"), F.col("best_phone").alias("_t"))
    store.stage("candidate_participant", people.join(given, "id", "left").withColumns({"best_email": F.coalesce("best_email", "_m"), "best_phone": F.coalesce("best_phone", "_t")}).drop("_m", "_t"))
    b = candidates.Builder(spark, {n: store.read(n) for n in ("source_links", "candidate_contact") if store.has(n)})
    b.add_contacts(contacts.withColumn("raw_value", F.col("normalized_value")))
    b._linked(enrich.person_links(gated))
    store.stage("candidate_contact", b.children["contact"])
    store.stage("source_links", b.links)
    by_mode = {r.search_mode: r["count"] for r in picked.groupBy("search_mode").count().collect()}
    return run.first().asDict() | {"modes": by_mode}


@mode
def under_combination_remediation(spark, store, args):
    people = store.read("candidate_participant")
    losers = lifecycle.remediation(people)
    out = lifecycle.absorbed(people, {"candidate_contact": (store.read("candidate_contact"), ["contact_type", "normalized_value"])}, losers, ["best_phone", "date_of_birth"])
    store.stage("candidate_participant", out["candidates"])
    store.stage("candidate_contact", out["candidate_contact"])
    return {"losers": losers.count()}


@mode
def event_activation(spark, store, args):
    """Audience of an event: segments, one row per e-mail, suppression, export to --export, audit, and delivery by a registered client."""
    needed = ("people", "registrations", "events", "yachts", "contact_states")
    if missing := [n for n in needed if not store.has(n)]:
        raise gates.GateError(f"missing tables: {', '.join(missing)}")
    today, t = _today(args), {n: store.read(n) for n in needed}
    parts = [audience.upcoming_registrants(t["people"], t["registrations"], t["events"], t["yachts"], today, args.event_window_days), audience.likely_registrants(t["people"], t["registrations"], t["events"], today, args.event_window_days)]
    chosen = {"all": parts, "upcoming": parts[:1], "likely": parts[1:]}[args.segment]
    merged = table(audience.merged_segments(*chosen), "segments")
    rows = store.stage("activation", audience.activated(merged, audience.suppression(t["contact_states"])))
    counts = gates.counters(rows, suppressed=F.col("is_suppressed")).first().asDict() | {"dropped_duplicates": merged.count() - rows.count()}
    _appended(store, "activation_rows", audience.audit(rows, args.run_id))
    _appended(store, "activation_runs", spark.createDataFrame([(args.run_id, args.segment, args.today, json.dumps(counts, sort_keys=True))], "run_id string, segment string, run_on string, counters string"))
    if args.export and not args.dry_run:
        audience.export(rows, args.today).coalesce(1).write.option("header", True).option("escape", '"').mode("overwrite").csv(args.export)
    if "audience" in CLIENTS and not args.dry_run:
        sent = store.stage("deliveries", audience.deliver(rows, CLIENTS["audience"]))
        counts["deliveries"] = {r.status: r["count"] for r in sent.groupBy("status").count().collect()}
        known = store.read("contact_ids") if store.has("contact_ids") else spark.createDataFrame([], "participant_id string, email string, contact_id string")
        got = sent.where("contact_id is not null").select("participant_id", "email", "contact_id")
        verdict = table(match.provider_ids(got, known, "contact_id"), "contact-ids")
        fresh = verdict.where("verdict = 'write'").drop("verdict")
        store.stage("contact_ids", merge.overwrite_merge(known, fresh, ["participant_id", "email"]))
        counts["contact_id_conflicts"] = verdict.where("verdict = 'conflict'").count()
    return counts


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--mode", required=True, choices=sorted(MODES))
    p.add_argument("--store", required=True)
    p.add_argument("--input", action="append", default=[], metavar="NAME=PATH")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--max-reject-rate", type=float, default=0.05)
    p.add_argument("--event-window-days", type=int, default=45)
    p.add_argument("--segment", choices=("all", "upcoming", "likely"), default="all")
    p.add_argument("--lineage-threshold", type=float, default=90.0)
    p.add_argument("--max-candidates", type=int, default=500)
    p.add_argument("--max-unresolved-rate", type=float, default=0.05)
    p.add_argument("--max-api-failure-rate", type=float, default=0.10)
    p.add_argument("--cooldown-days", type=int, default=30)
    p.add_argument("--missing", choices=("email", "phone", "either", "none"), default="either")
    p.add_argument("--only-ready", action="store_true")
    p.add_argument("--allow-missing-name", action="store_true")
    p.add_argument("--rescore", action="store_true")
    p.add_argument("--no-bridges", action="store_true")
    p.add_argument("--event-name", default=None)
    p.add_argument("--event-display-name", default=None)
    p.add_argument("--host-club", default="Unknown")
    p.add_argument("--season-year", type=int, default=dt.date.today().year)
    p.add_argument("--event-instance", default=None)
    p.add_argument("--requirement", default=None)
    p.add_argument("--related", action="append", default=[], metavar="COLUMN=KIND")
    p.add_argument("--rejects", default=None, help="folder for rejects as CSV")
    p.add_argument("--export", default=None, help="folder for the audience file")
    p.add_argument("--text", action="store_true", help="print a text report")
    p.add_argument("--no-synthesize", action="store_true")
    p.add_argument("--base-url", default="https://example.org/entries")
    p.add_argument("--today", default=dt.date.today().isoformat())
    return p


def run(spark: SparkSession, argv: list[str]) -> str:
    """Run a mode and return its report as JSON."""
    args = parser().parse_args(argv)
    args.input = dict(x.split("=", 1) for x in args.input)
    args.run_id = uuid.uuid4().hex
    store, began = Store(spark, args.store), dt.datetime.now().isoformat()
    values = MODES[args.mode](spark, store, args)
    store.publish(args.dry_run)
    if args.text:
        return gates.text_report(args.mode, values)
    return gates.report(args.run_id, args.mode, began, dt.datetime.now().isoformat(), args.dry_run, json.loads(json.dumps(values, default=str)))


if __name__ == "__main__":
    import sys

    print(run(SparkSession.builder.getOrCreate(), sys.argv[1:]))
