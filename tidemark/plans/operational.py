"""Operational tables from staged feeds: people, contacts, clubs, boats, events, entries and crews.

Each feed is a function from the tables as they are and its accepted rows to new
versions of the tables and the rows it had to reject. Rows count in the order of
their file, as if taken one by one: a row meets people and boats that earlier
rows brought in. Every table has keys that follow from natural keys, so a rerun
changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, keys, text, urls
from tidemark.lineage import table
from tidemark.operators import merge
from tidemark.operators.match import Lookup, Offer, in_order
from tidemark.sources import feeds

SCHEMAS = {
    "participant": "id string, full_name string, normalized_full_name string, first_name string, last_name string",
    "contact": "participant_id string, contact_type string, contact_subtype string, raw string, normalized string, is_primary boolean, source_system string",
    "address": "participant_id string, address_raw string, source_system string",
    "club": "id string, name string, slug string, website string, vitality string",
    "membership": "participant_id string, club_id string, membership_role string, effective_start date, effective_end date, source_system string",
    "yacht": "id string, name string, yacht_slug string, sail_number string, sail_slug string, yacht_type string, length_feet decimal(6,2)",
    "ownership": "participant_id string, yacht_id string, role string, is_primary_contact boolean, effective_start date, effective_end date, source_system string",
    "series": "id string, club_id string, name string, slug string",
    "instance": "id string, series_id string, display_name string, season_year int, registration_open_at timestamp",
    "entry": "id string, instance_id string, yacht_id string, entry_status string, registration_source string, registration_external_id string, registered_at timestamp",
    "crew": "entry_id string, participant_id string, role string, participation_state string, source_system string",
    "xref": "kind string, source_system string, source_id string, entity_id string, last_seen string",
    "related_contact": "participant_id string, related_type string, full_name string, name_key string",
    "document_status": "document_requirement_id string, participant_id string, status string, status_at date, links array<string>",
    "audience_state": "participant_id string, email string, audience_status string, status_at timestamp, source_file string, row_hash string, ingest_seq long",
    "audience_tag": "participant_id string, email string, tag string, source_file string",
    "provider_identity": "participant_id string, email string, leid string, euid string",
    "identity_queue": "source_file string, row_hash string, email string, reason_code string, payload string",
}
STATUSES = ("confirmed", "submitted")
#: People by feed: tiers in order.
BY_CONTACT = (Lookup("email", "email", "email"), Lookup("home_phone", "phone", "home_phone"), Lookup("cell_phone", "phone", "cell_phone"))
PEOPLE = {
    "owners": (*BY_CONTACT, Lookup("name", "name", "name_key", "least")),
    "by_name": (Lookup("name", "name", "name_key", "least"),),
    "strict": (Lookup("xref", "xref", "xref_key"), Lookup("email", "email", "email"), Lookup("phone", "phone", "phone"), Lookup("name", "name", "name_key")),
    "strict_name": (Lookup("xref", "xref", "xref_key"), Lookup("name", "name", "name_key")),
}
PERSON_KEYS = (Offer("email", "email", True), Offer("phone", "home_phone", True), Offer("phone", "cell_phone", True), Offer("phone", "phone", True), Offer("xref", "xref_key", True), Offer("name", "name_key"))
#: Boats: a row's own fields choose the one key that it is looked up by; a boat offers all of its keys.
BOAT_KEYS = (Offer("xref", "xref_key", True), Offer("sail", "by_sail"), Offer("length", "by_length"), Offer("type", "by_type"), Offer("name", "by_name"), Offer("entry", "by_entry", True))


@dataclass
class Tables:
    """Tables by name, empty where there is none yet; ``put`` replaces one by a version that is written and read back."""

    spark: SparkSession
    held: dict[str, DataFrame] = field(default_factory=dict)
    changed: set[str] = field(default_factory=set)

    def __getitem__(self, name: str) -> DataFrame:
        return self.held[name] if name in self.held else self.spark.createDataFrame([], SCHEMAS[name])

    def put(self, name: str, df: DataFrame) -> None:
        self.held[name] = table(df.select(*[c.split()[0] for c in SCHEMAS[name].split(", ")]), name)
        self.changed.add(name)

    def add(self, name: str, new: DataFrame, on: list[str], seq: str | None = None) -> None:
        """Append rows whose key isn't there yet; of several new ones the first by ``seq``."""
        order = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        fresh = merge.insert_absent(self[name], new.select(*order, *([seq] if seq else [])), on, seq)
        self.put(name, self[name].unionByName(fresh.select(*order)))


def _with(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with text columns of these names, null where they lack."""
    return rows.withColumns({n: F.lit(None).cast("string") for n in names if n not in rows.columns})


def known_people(t: Tables, source: str, kind: str) -> DataFrame:
    """(space, key, entity) of all people."""
    contacts = t["contact"].select(F.col("contact_type").alias("space"), F.col("normalized").alias("key"), F.col("participant_id").alias("entity"))
    names = t["participant"].select(F.lit("name").alias("space"), F.col("normalized_full_name").alias("key"), F.col("id").alias("entity"))
    return contacts.unionByName(names).unionByName(_known_xrefs(t, source, kind)).distinct()


def _known_xrefs(t: Tables, source: str, kind: str) -> DataFrame:
    x = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == kind))
    return x.select(F.lit("xref").alias("space"), F.col("source_id").alias("key"), F.col("entity_id").alias("entity"))


def people(t: Tables, rows: DataFrame, tiers: str, source: str, kind: str = "participant", seq: str = "_ordinal", group: str | None = None) -> DataFrame:
    """Resolve people (full_name, name_key and contact keys) and add the new ones; ``rows`` get participant_id, null where ambiguous."""
    rows = _with(rows, "email", "home_phone", "cell_phone", "phone", "xref_key", "name_key")
    own = keys.entity_id("participant", F.coalesce(F.concat(F.lit("n:"), "name_key"), F.concat(F.lit("e:"), "email"), F.concat(F.lit(f"{source}:"), F.col(seq).cast("string"))))
    found = table(in_order(rows, seq, PEOPLE[tiers], PERSON_KEYS, known_people(t, source, kind), own, group), "people")
    new = found.where("is_new").withColumn("_p", text.name_parts(F.col("full_name")))
    new = new.select(F.col("entity_id").alias("id"), text.squeezed(F.col("full_name")).alias("full_name"), F.col("name_key").alias("normalized_full_name"), F.col("_p.first").alias("first_name"), F.col("_p.last").alias("last_name"), seq)
    t.add("participant", new, ["id"], seq)
    return found.withColumnRenamed("entity_id", "participant_id")


def boat_keys(rows: DataFrame) -> DataFrame:
    """Keys of boats: name with sail, with length, with type, and alone."""
    rows = _with(rows, "yacht_slug", "sail_slug", "yacht_type", "xref_key", "by_entry")
    if "length_feet" not in rows.columns:
        rows = rows.withColumn("length_feet", F.lit(None).cast("decimal(6,2)"))
    both = lambda c: F.when(F.col("yacht_slug").isNotNull() & F.col(c).isNotNull(), F.concat_ws("|", "yacht_slug", F.col(c).cast("string")))
    return rows.withColumns({"by_sail": both("sail_slug"), "by_length": both("length_feet"), "by_type": both("yacht_type"), "by_name": F.col("yacht_slug")})


#: Boats by feed: the ways that a row may be looked up, the first whose key it has; xrefs come before.
BOATS: dict[str, tuple[tuple[str, str], ...]] = {
    "owners": (("length", "least"), ("name", "least")),
    "scrape": (("sail", "reject"), ("entry", "least")),
    "strict": (("sail", "reject"), ("length", "reject"), ("name", "reject")),
    "race": (("sail", "reject"), ("type", "reject"), ("name", "reject")),
}


def boats(t: Tables, rows: DataFrame, ways: str, source: str, kind: str = "yacht", seq: str = "_ordinal") -> DataFrame:
    """Resolve boats, add the new ones and fill null types and lengths; ``rows`` get yacht_id, null where ambiguous.

    Each row is looked up by one key, that of the first way which its fields
    allow. A boat without a sail number in a public entry is that of the entry.
    """
    rows = boat_keys(rows)
    lookups, before = [Lookup("xref", "xref", "xref_key")], F.lit(True)
    for space, many in BOATS[ways]:
        c = F.col(f"by_{space}")
        rows = rows.withColumn(f"_ask_{space}", F.when(before, c))
        before = before & c.isNull()
        lookups.append(Lookup(space, space, f"_ask_{space}", many))
    old = boat_keys(t["yacht"])
    known = _known_xrefs(t, source, kind)
    for space in ("sail", "length", "type", "name"):
        known = known.unionByName(old.select(F.lit(space).alias("space"), F.col(f"by_{space}").alias("key"), F.col("id").alias("entity")))
    entries = t["entry"].select(F.lit("entry").alias("space"), F.concat_ws("|", "instance_id", "registration_external_id").alias("key"), F.col("yacht_id").alias("entity"))
    known = known.unionByName(entries)
    named = F.concat_ws("|", "yacht_slug", F.coalesce(F.concat(F.lit("s:"), "sail_slug"), F.concat(F.lit("e:"), "by_entry"), F.concat(F.lit("l:"), F.col("length_feet").cast("string")), F.concat(F.lit("t:"), "yacht_type")))
    found = in_order(rows, seq, lookups, BOAT_KEYS, known.distinct(), keys.entity_id("yacht", F.coalesce(named, F.col(seq).cast("string"))))
    found = table(_with(found, "yacht_name", "sail_number"), "boats")
    seen = found.where("entity_id is not null").select(F.col("entity_id").alias("id"), "yacht_name", "yacht_slug", "sail_number", "sail_slug", "yacht_type", "length_feet", "is_new", seq)
    made = seen.where("is_new").select("id", F.col("yacht_name").alias("name"), "yacht_slug", "sail_number", "sail_slug", "yacht_type", "length_feet", seq)
    t.add("yacht", made, ["id"], seq)
    fill = merge.first_values(seen, ["id"], ["yacht_type", "length_feet"], seq).select("id", F.col("yacht_type").alias("_t"), F.col("length_feet").alias("_l"))
    t.put("yacht", t["yacht"].join(fill, "id", "left").withColumns({"yacht_type": F.coalesce("yacht_type", "_t"), "length_feet": F.coalesce("length_feet", "_l")}))
    return found.withColumnRenamed("entity_id", "yacht_id").drop(*[f"_ask_{s}" for s, _ in BOATS[ways]], "by_sail", "by_length", "by_type", "by_name")


def contacts(t: Tables, rows: DataFrame, columns: Mapping[str, tuple[str, str, str]], source: str, by_subtype: bool = True, seq: str = "_ordinal") -> None:
    """Add contacts of resolved rows: ``columns`` maps a normalised column to (type, subtype, raw column); once per person and key."""
    parts = [F.struct(F.lit(kind).alias("contact_type"), F.lit(sub).alias("contact_subtype"), F.col(f"`{raw}`").cast("string").alias("raw"), F.col(c).alias("normalized"), F.lit(kind == "email").alias("is_primary")) for c, (kind, sub, raw) in columns.items()]
    live = rows.where(F.col("participant_id").isNotNull()).select("participant_id", seq, F.inline(F.array(*parts))).where("normalized is not null")
    on = ["participant_id", "contact_type", *(["contact_subtype"] if by_subtype else []), "normalized"]
    t.add("contact", live.withColumns({"raw": text.trimmed(F.col("raw")), "source_system": F.lit(source)}), on, seq)


def addresses(t: Tables, rows: DataFrame, source: str, seq: str = "_ordinal") -> None:
    live = rows.where(F.col("participant_id").isNotNull() & F.col("address_raw").isNotNull())
    t.add("address", live.withColumn("source_system", F.lit(source)), ["participant_id", "address_raw"], seq)


def clubs(t: Tables, rows: DataFrame, source: str, vitality: str = "unknown", seq: str = "_ordinal") -> DataFrame:
    """Resolve clubs (club_name, and club_source_id if the feed has one): by cross-reference, by name, else a new one; null websites are filled.

    Rows get club_id, null without a club. ``active`` clubs take the latest name.
    """
    rows = _with(rows, "club_source_id", "website").withColumn("club_slug", text.slug(F.col("club_name")))
    ids = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == "club")).select(F.col("source_id").alias("club_source_id"), F.col("entity_id").alias("_x")).distinct()
    named = t["club"].select(F.col("slug").alias("club_slug"), F.col("id").alias("_n"))
    found = rows.join(ids, "club_source_id", "left").join(named, "club_slug", "left")
    own = F.when(F.col("club_slug").isNotNull(), keys.entity_id("club", F.col("club_slug")))
    found = table(found.withColumn("club_id", F.coalesce("_x", "_n", own)).drop("_x", "_n"), "clubs")
    seen = found.where("club_id is not null")
    new = seen.where("club_slug is not null").select(own.alias("id"), text.squeezed(F.col("club_name")).alias("name"), F.col("club_slug").alias("slug"), "website", F.lit(vitality).alias("vitality"), "club_id", seq)
    t.add("club", new.where("id = club_id"), ["id"], seq)
    web = merge.first_values(seen, ["club_id"], ["website"], seq).select(F.col("club_id").alias("id"), F.col("website").alias("_w"))
    out = t["club"].join(web, "id", "left").withColumn("website", F.coalesce("website", "_w"))
    if vitality == "active":
        last = seen.groupBy(F.col("club_id").alias("id")).agg(F.max_by(text.squeezed(F.col("club_name")), F.col(seq)).alias("_name"))
        out = out.join(last, "id", "left").withColumns({"vitality": F.when(F.col("_name").isNotNull(), "active").otherwise(F.col("vitality")), "name": F.coalesce("_name", "name")})
    t.put("club", out)
    return found


def memberships(t: Tables, rows: DataFrame, source: str, seq: str = "_ordinal") -> None:
    """Members of clubs from now on, unless they are already."""
    live = _dated(rows).where("participant_id is not null and club_id is not null")
    live = live.groupBy("participant_id", "club_id").agg(F.min_by("effective_start", seq).alias("effective_start"))
    new = merge.insert_unless_open(t["membership"], live, ["participant_id", "club_id"], "effective_end")
    t.put("membership", t["membership"].unionByName(new.select("participant_id", "club_id", F.lit("member").alias("membership_role"), "effective_start", F.lit(None).cast("date").alias("effective_end"), F.lit(source).alias("source_system"))))


def _dated(rows: DataFrame) -> DataFrame:
    return rows if "effective_start" in rows.columns else rows.withColumn("effective_start", F.lit(None).cast("date"))


def ownerships(t: Tables, rows: DataFrame, source: str, seq: str = "_ordinal") -> None:
    """Owners of boats (role, is_primary_contact) from now on, unless they are already."""
    live = _dated(rows).where("participant_id is not null and yacht_id is not null")
    live = live.groupBy("participant_id", "yacht_id", "role").agg(F.min_by("effective_start", seq).alias("effective_start"), F.min_by("is_primary_contact", seq).alias("is_primary_contact"))
    new = merge.insert_unless_open(t["ownership"], live, ["participant_id", "yacht_id", "role"], "effective_end")
    names = [c.split()[0] for c in SCHEMAS["ownership"].split(", ")]
    t.put("ownership", t["ownership"].unionByName(new.withColumns({"effective_end": F.lit(None).cast("date"), "source_system": F.lit(source)}).select(*names)))


def events(t: Tables, rows: DataFrame, source: str, vitality: str = "unknown", overwrite: bool = False, seq: str = "_ordinal") -> DataFrame:
    """Events of rows (club_name, series_name, display_name, season_year, race_key): club, then series, then instance.

    A known race key leads to its instance and adds nothing. With ``overwrite``
    an instance takes the latest display name and the earliest time at which
    registration opened. Rows get instance_id.
    """
    if "registration_open_at" not in rows.columns:
        rows = rows.withColumn("registration_open_at", F.lit(None).cast("timestamp"))
    rows = _with(rows, "race_key", "club_source_id")
    known = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == "event")).select(F.col("source_id").alias("race_key"), F.col("entity_id").alias("_x")).distinct()
    rows = table(rows.join(known, "race_key", "left"), "event-rows")
    fresh = clubs(t, rows.where("_x is null").drop("_x"), source, vitality, seq)
    fresh = fresh.withColumn("series_slug", text.slug(F.col("series_name"))).where("club_id is not null and series_slug is not null and season_year is not null")
    fresh = fresh.withColumn("series_id", keys.entity_id("series", F.col("club_id"), F.col("series_slug"))).withColumn("instance_id", keys.entity_id("instance", F.col("series_id"), F.col("season_year")))
    t.add("series", fresh.select(F.col("series_id").alias("id"), "club_id", F.col("series_name").alias("name"), F.col("series_slug").alias("slug"), seq), ["id"], seq)
    batch = fresh.groupBy(F.col("instance_id").alias("id")).agg(F.min_by("series_id", seq).alias("series_id"), F.min_by("display_name", seq).alias("_first"), F.max_by("display_name", seq).alias("_last"), F.min_by("season_year", seq).alias("season_year"), F.min("registration_open_at").alias("registration_open_at"))
    batch = batch.withColumn("display_name", F.col("_last") if overwrite else F.col("_first"))
    o, n = t["instance"].alias("o"), batch.alias("n")
    both = o.join(n, F.col("o.id") == F.col("n.id"), "full_outer")
    first = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)
    name = F.coalesce(F.col("n.display_name"), F.col("o.display_name")).alias("display_name") if overwrite else first("display_name")
    opened = F.least(F.col("o.registration_open_at"), F.col("n.registration_open_at")).alias("registration_open_at") if overwrite else first("registration_open_at")
    t.put("instance", both.select(first("id"), first("series_id"), name, first("season_year"), opened))
    done = rows.where("_x is not null").select(*[c for c in rows.columns if c != "_x"], F.col("_x").alias("instance_id"))
    return table(done.unionByName(fresh.select(*done.columns)), "event-instances")


def entries(t: Tables, rows: DataFrame, source: str, seq: str = "_ordinal") -> DataFrame:
    """One entry per instance and boat: the better status, the earliest registration, the first external id. Rows get entry_id."""
    rows = rows.withColumn("entry_id", F.when(F.col("instance_id").isNotNull() & F.col("yacht_id").isNotNull(), keys.entity_id("entry", F.col("instance_id"), F.col("yacht_id"))))
    live = rows.where("entry_id is not null").select(F.col("entry_id").alias("id"), "instance_id", "yacht_id", "entry_status", F.lit(source).alias("registration_source"), "registration_external_id", "registered_at", (F.col(seq) + 1).alias("_at"))
    every = live.unionByName(t["entry"].withColumn("_at", F.lit(0).cast("long")))
    kept = merge.status_precedence(every, ["id", "instance_id", "yacht_id"], "entry_status", STATUSES, "registered_at", "registration_external_id", "_at")
    origin = every.groupBy("id").agg(F.min_by("registration_source", "_at").alias("registration_source"))
    t.put("entry", kept.join(origin, "id"))
    return rows


def crews(t: Tables, rows: DataFrame, role: str, state: str, source: str) -> None:
    live = rows.where("entry_id is not null and participant_id is not null").select("entry_id", "participant_id", F.lit(role).alias("role"), F.lit(state).alias("participation_state"), F.lit(source).alias("source_system"))
    t.add("crew", live, ["entry_id", "participant_id", "role"])


def xrefs(t: Tables, rows: DataFrame, kind: str, source: str, source_id: str, entity: str, seen: Column) -> None:
    """Cross-references: new ones are added, known ones keep their entity and get the later ``seen``."""
    live = rows.where(F.col(source_id).isNotNull() & F.col(entity).isNotNull())
    batch = live.groupBy(F.col(source_id).alias("source_id")).agg(F.min_by(entity, "_ordinal").alias("entity_id"))
    batch = batch.select(F.lit(kind).alias("kind"), F.lit(source).alias("source_system"), "source_id", "entity_id", seen.cast("string").alias("last_seen"))
    t.put("xref", merge.refresh_seen(t["xref"], batch, ["kind", "source_system", "source_id"], "entity_id", "last_seen"))


def _rejected(rows: DataFrame, reason: str | Column) -> DataFrame:
    return rows.withColumn("reject_reason", F.lit(reason) if isinstance(reason, str) else reason)


def _both(t: Tables, rows: DataFrame, ways: str, tiers: str, source: str, boat_kind: str, person_kind: str) -> tuple[DataFrame, DataFrame]:
    """Boats and people of the same rows; a row that is ambiguous in either brings in neither. Rows with both ids, and rejects.

    Boats come first. If people then reject rows, both are resolved again
    without these; rejects only grow, so this ends.
    """
    before = dict(t.held)
    live = rows
    while True:
        b = boats(t, live, ways, source, boat_kind)
        ok = b.where("yacht_id is not null").drop("is_new", "match_tier", "match_status", "xref_key").withColumnRenamed("person_xref", "xref_key")
        p = people(t, ok.where("name_key is not null"), tiers, source, person_kind)
        torn = p.where("participant_id is null").select("_ordinal")
        if not torn.limit(1).count():
            named = p.select(*ok.columns, "participant_id")
            bare = ok.where("name_key is null").withColumn("participant_id", F.lit(None).cast("string"))
            done = table(named.unionByName(bare.select(*named.columns)), "resolved")
            return done, _rejected(rows.join(done.select("_ordinal"), "_ordinal", "left_anti"), "ambiguous_match")
        live = table(live.join(torn, "_ordinal", "left_anti"), "resolvable")
        t.held = dict(before)


def ingest_owners(t: Tables, rows: DataFrame, event: Mapping[str, object], source: str = "owner_export", today: Column | None = None) -> DataFrame:
    """Owner export (rows of ``staged_owners``, accepted): owners, contacts, addresses, clubs, boats, ownership, entries and their contacts.

    ``event``: club_name, series_name, display_name and season_year. A row whose
    e-mail or phone several people share is rejected whole. Returns the rejects.
    """
    one = t.spark.createDataFrame([(0, event["club_name"], event["series_name"], event["display_name"], event["season_year"])], "_ordinal long, club_name string, series_name string, display_name string, season_year int")
    opened = rows.agg(F.min("registered_at").alias("registration_open_at"))
    instance = events(t, one.join(opened, F.lit(True)), source, "active", True).first().instance_id
    spread = rows.select("*", F.posexplode("owners").alias("_pos", "_o")).withColumn("_q", F.col("_ordinal") * 4096 + F.col("_pos"))
    lead = F.col("_pos") == 0
    spread = spread.withColumns({"full_name": F.col("_o.full_name"), "role": F.col("_o.role"), "name_key": text.person_key(F.col("_o.full_name")), **{c: F.when(lead, F.col(c)) for c in ("email", "home_phone", "cell_phone")}})
    who = people(t, spread, "owners", source, seq="_q", group="_ordinal")
    first = who.where("_pos = 0")
    rejects = _rejected(rows.join(first.where("participant_id is null").select("_ordinal"), "_ordinal", "left_semi"), "ambiguous_contact_match")
    contacts(t, first, {"email": ("email", "primary", "Email"), "home_phone": ("phone", "home", "owner_hphone"), "cell_phone": ("phone", "mobile", "owner_cphone")}, source)
    addresses(t, first, source)
    ok = who.where("participant_id is not null")
    start = F.to_date("registered_at")
    joined = clubs(t, ok.where(lead).withColumn("club_name", F.when(~feeds.placeholder_club(F.col("org_name"), F.col("org_abbrev")), F.col("org_name"))).where("club_name is not null"), source)
    memberships(t, joined.withColumn("effective_start", start), source)
    ships = boats(t, ok.where(lead).drop("is_new", "match_tier", "match_status").withColumn("yacht_name", text.squeezed(F.col("Yacht Name"))), "owners", source)
    afloat = ok.join(ships.select("_ordinal", "yacht_id"), "_ordinal")
    since = F.coalesce(start, today) if today is not None else start
    ownerships(t, afloat.withColumns({"is_primary_contact": lead, "effective_start": since}), source, "_q")
    entered = entries(t, ships.withColumns({"instance_id": F.lit(instance), "registration_external_id": F.col("external_id")}), source)
    crews(t, afloat.join(entered.select("_ordinal", "entry_id"), "_ordinal"), "owner_contact", "non_participating_contact", source)
    return rejects


def ingest_public(t: Tables, staged_events: DataFrame, rows: DataFrame, source: str = "public_scrape") -> DataFrame:
    """Public events and entries (staged, accepted): events, people by name, boats, entries as submitted, registrants. Returns the rejects."""
    year = F.coalesce(dates.tag_year(F.col("source")), F.col("race.yr"))
    shown = staged_events.select("_ordinal", "canonical_url", F.col("`Host Club`").alias("club_name"), F.col("`Event Name`").alias("series_name"), year.alias("season_year"))
    made = rows.where("event_synthesized").groupBy("canonical_url").agg(F.min("_ordinal").alias("_ordinal"), F.min_by("Event Name", "_ordinal").alias("series_name"), F.min_by("season_year", "_ordinal").alias("season_year"))
    made = made.select("_ordinal", "canonical_url", F.lit("Unknown").alias("club_name"), "series_name", "season_year").where("canonical_url is not null")
    every = shown.unionByName(made)
    every = events(t, every.withColumns({"display_name": F.col("series_name"), "race_key": F.col("canonical_url")}), source, "active", True)
    found = rows.drop("season_year").join(every.select("canonical_url", "instance_id").distinct(), "canonical_url", "left")
    live = found.where("instance_id is not null").withColumns({"yacht_name": text.squeezed(F.col("`Yacht Name`")), "full_name": F.col("Name"), "by_entry": F.concat_ws("|", "instance_id", "external_id"), "person_xref": F.lit(None).cast("string")})
    live = _with(live, "Sail Num", "Boat Type").withColumns({"sail_number": text.trimmed(F.col("`Sail Num`")), "yacht_type": text.trimmed(F.col("`Boat Type`"))})
    done, torn = _both(t, table(live, "scraped"), "scrape", "by_name", source, "yacht", "participant")
    done = done.withColumns({"entry_status": F.lit("submitted"), "registration_external_id": F.col("external_id"), "registered_at": F.lit(None).cast("timestamp")})
    crews(t, entries(t, done, source), "registrant", "non_participating_contact", source)
    lost = _rejected(found.where("instance_id is null"), "unresolved_event_link")
    return lost.unionByName(torn.select(*[c for c in torn.columns if c in lost.columns]), allowMissingColumns=True)


def ingest_waivers(t: Tables, rows: DataFrame, related: Mapping[str, str], requirement: str | None = None, instance: str | None = None, source: str = "waiver_form") -> DataFrame:
    """Waivers (staged, accepted): people by name, contacts, guardians and emergency contacts, the entry they belong to, and the paper's status.

    An entry of ``instance`` is linked by sail, else by boat name, if just one has it. Returns the linked rows.
    """
    from tidemark.plans import ingest

    who = people(t, rows.withColumn("full_name", F.col("Name")), "by_name", source)
    contacts(t, who, {"email": ("email", "primary", "Competitor E mail"), "phone": ("phone", "primary", "phone")}, source, by_subtype=False)
    if related:
        t.add("related_contact", ingest.related_contacts(who, related), ["participant_id", "related_type", "full_name"])
    linked = _with(who, "Boat Name", "Sail Number").withColumns({"yacht_slug": text.slug(F.col("`Boat Name`")), "sail_slug": text.slug(F.col("`Sail Number`"))})
    if instance is not None:
        from tidemark.operators.match import unique_link

        at = t["entry"].where(F.col("instance_id") == instance).join(t["yacht"].select(F.col("id").alias("yacht_id"), "yacht_slug", "sail_slug"), "yacht_id")
        linked = unique_link(linked, at.select("id", "yacht_slug", "sail_slug"), ["sail_slug", "yacht_slug"], "id").withColumnRenamed("linked_id", "entry_id")
        crews(t, linked, "registrant", "participating", source)
    if requirement is not None:
        new = ingest.signed_documents(who, requirement)
        t.put("document_status", merge.replace_if_newer(t["document_status"], new.select(*t["document_status"].columns), ["document_requirement_id", "participant_id"], "status_at"))
    return linked


def ingest_audience(t: Tables, rows: DataFrame, allow_missing_name: bool = False, source: str = "audience") -> DataFrame:
    """Audience rows (staged, accepted, with row_hash): identity policy, states, tags and provider ids; quarantined rows go to the queue.

    New people are known by e-mail to all rows of the batch. Returns the rows that were quarantined.
    """
    from tidemark.operators import match

    own = keys.entity_id("participant", F.concat(F.lit("e:"), "email"))
    emails = t["contact"].where("contact_type = 'email'").select(F.col("normalized").alias("email"), "participant_id").distinct()
    phones = t["contact"].where("contact_type = 'phone'").groupBy("participant_id").agg(F.min("normalized").alias("phone"))
    places = t["address"].groupBy("participant_id").agg(F.min("address_raw").alias("address"))
    known = t["participant"].select(F.col("id").alias("participant_id"), F.col("normalized_full_name").alias("name_key")).join(phones, "participant_id", "left").join(places, "participant_id", "left")
    seen = table(match.strict_identity(rows, known, emails, allow_missing_name), "identities")
    quarantined = seen.where("reason_code is not null")
    t.add("identity_queue", quarantined.select(F.col("_source_file").alias("source_file"), "row_hash", "email", "reason_code", F.to_json(F.struct("name_key", "phone", "address", "audience_status")).alias("payload")), ["source_file", "row_hash"])
    ok = seen.where("reason_code is null").withColumn("is_new", F.col("participant_id").isNull()).withColumn("participant_id", F.coalesce("participant_id", own))
    full = text.full_name(F.col("`First Name`"), F.col("`Last Name`"))
    new = ok.where("is_new").select(F.col("participant_id").alias("id"), F.coalesce(full, F.col("email")).alias("full_name"), F.col("name_key").alias("normalized_full_name"), text.trimmed(F.col("`First Name`")).alias("first_name"), text.trimmed(F.col("`Last Name`")).alias("last_name"), "_ordinal")
    t.add("participant", new, ["id"], "_ordinal")
    contacts(t, ok, {"email": ("email", "primary", "Email Address"), "phone": ("phone", "primary", "phone")}, source, by_subtype=False)
    addresses(t, ok.withColumn("address_raw", F.col("address")), source)
    state = ok.select("participant_id", "email", "audience_status", "status_at", F.col("_source_file").alias("source_file"), "row_hash", F.col("_ordinal").alias("ingest_seq"))
    t.add("audience_state", state, ["source_file", "row_hash"])
    tags = ok.select("participant_id", "email", F.explode("tags").alias("tag"), F.col("_source_file").alias("source_file"))
    t.add("audience_tag", tags, ["participant_id", "email", "tag", "source_file"])
    mine = ok.groupBy("participant_id", "email").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_ordinal"))).alias(c) for c in ("leid", "euid")])
    for c in ("leid", "euid"):
        verdict = match.provider_ids(mine, t["provider_identity"], c)
        clash = verdict.where("verdict = 'conflict'")
        t.add("identity_queue", clash.select(F.lit(source).alias("source_file"), F.concat(F.lit(f"{c}:"), F.col(c)).alias("row_hash"), "email", F.lit(f"{c}_conflict").alias("reason_code"), F.to_json(F.struct("participant_id", c)).alias("payload")), ["source_file", "row_hash"])
        mine = verdict.withColumn(c, F.when(F.col("verdict") == "write", F.col(c))).drop("verdict")
    t.put("provider_identity", merge.fill_null_merge(t["provider_identity"], mine.withColumn("_s", F.lit(1)), ["participant_id", "email"], ["leid", "euid"], "_s"))
    return quarantined


def ingest_base(t: Tables, staged: Mapping[str, DataFrame], seen: Column, today: Column, source: str = "base_copy") -> dict[str, DataFrame]:
    """The six files of a base copy (staged, accepted), in the order in which they depend on each other. Returns the rejects by file."""
    out: dict[str, DataFrame] = {}
    c = clubs(t, staged["base_clubs"].withColumns({"club_name": F.col("Name"), "club_source_id": F.col("source_id")}), source)
    xrefs(t, c, "club", source, "source_id", "club_id", seen)

    e = _with(staged["base_events"], "Host Club", "club_global_id_lookup")
    e = e.withColumns({"club_name": F.col("`Host Club`"), "club_source_id": text.trimmed(F.col("club_global_id_lookup")), "series_name": text.squeezed(F.col("`Event Name`")), "display_name": text.squeezed(F.col("`Event Name`")), "race_key": F.col("source_id")})
    e = events(t, e, source)
    xrefs(t, e, "event", source, "race_key", "instance_id", seen)
    out["base_events"] = _rejected(staged["base_events"].join(e.select("_ordinal"), "_ordinal", "left_anti"), "missing_required_identity")

    y = staged["base_yachts"].withColumns({"xref_key": F.col("source_id"), "yacht_name": text.squeezed(F.col("yachtName"))})
    y = boats(t, _with(y, "sailNumber").withColumn("sail_number", text.trimmed(F.col("sailNumber"))), "strict", source)
    xrefs(t, y.where("yacht_id is not null"), "yacht", source, "source_id", "yacht_id", seen)
    out["base_yachts"] = _rejected(y.where("yacht_id is null"), "ambiguous_yacht_match")

    for feed, kind in (("base_owners", "owner"), ("base_participants", "participant")):
        rows = staged[feed].withColumn("xref_key", F.col("source_id"))
        p = people(t, rows, "strict", source, kind)
        xrefs(t, p, kind, source, "source_id", "participant_id", seen)
        mail = "ownerEmail" if kind == "owner" else "competitorE"
        phones = {"home_phone": ("phone", "home", "home_phone"), "cell_phone": ("phone", "mobile", "cell_phone")} if kind == "owner" else {"phone": ("phone", "primary", "phone")}
        if kind == "owner":
            p = _with(p, "ownerEmail", "ownerAffiliation", "club_global_id_lookup", "yacht_global_id_lookup")
        contacts(t, _with(p, mail), {"email": ("email", "primary", mail)} | phones, source, by_subtype=False)
        addresses(t, p, source)
        out[feed] = _rejected(p.where("participant_id is null"), "ambiguous_participant_match")
        if kind == "owner":
            live = p.where("participant_id is not null")
            m = clubs(t, live.withColumns({"club_name": text.squeezed(F.col("ownerAffiliation")), "club_source_id": text.trimmed(F.col("club_global_id_lookup"))}).where("club_name is not null"), source)
            memberships(t, m, source)
            ships = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == "yacht")).select(F.col("source_id").alias("_ship"), F.col("entity_id").alias("yacht_id")).distinct()
            own = live.withColumn("_ship", text.trimmed(F.col("yacht_global_id_lookup"))).join(ships, "_ship")
            ownerships(t, own.withColumns({"role": F.lit("owner"), "is_primary_contact": F.lit(True), "effective_start": today}), source)

    r = staged["base_entries"]
    races = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == "event")).select(F.col("source_id").alias("event_key"), F.col("entity_id").alias("instance_id")).distinct()
    r = _with(r.join(races, "event_key", "left"), "Sail Num", "Boat Type").withColumns({"yacht_name": text.squeezed(F.col("`Yacht Name`")), "sail_number": text.trimmed(F.col("`Sail Num`")), "yacht_type": text.trimmed(F.col("`Boat Type`")), "full_name": F.col("Name"), "person_xref": F.lit(None).cast("string")})
    done, torn = _both(t, table(r.where("instance_id is not null"), "base-entries"), "strict", "strict_name", source, "entry_yacht", "entry_person")
    done = done.withColumns({"entry_status": F.lit("submitted"), "registration_external_id": F.col("external_id"), "registered_at": F.lit(None).cast("timestamp")})
    crews(t, entries(t, done, source), "skipper", "participating", source)
    out["base_entries"] = _rejected(r.where("instance_id is null"), "unresolved_event_link").unionByName(torn.select(*r.columns, "reject_reason"))
    return out


def ingest_race_events(t: Tables, rows: DataFrame, seen: Column, host: str = "Race Scoring", source: str = "race_scoring") -> DataFrame:
    """Race-scoring events: one made-up host club, series by title without its year. Returns the rejects."""
    url = F.col("`title-small href`")
    rows = _with(rows, "title-small", "w-[20%]").withColumn("race_key", urls.number_after(url, "emenu"))
    title = F.coalesce(text.squeezed(F.col("`title-small`")), F.concat(F.lit("Event "), "race_key"))
    year = F.coalesce(dates.word_year(F.col("`w-[20%]`")), dates.word_year(title))
    rows = rows.withColumns({"display_name": title, "series_name": F.coalesce(dates.without_year(title), title), "season_year": year, "club_name": F.lit(host)})
    done = events(t, rows.where("race_key is not null"), source)
    xrefs(t, done, "event", source, "race_key", "instance_id", seen)
    lost = rows.join(done.select("_ordinal"), "_ordinal", "left_anti")
    return _rejected(lost, F.when(F.col("race_key").isNull(), "unparseable_event_url").otherwise("missing_season_year"))


def ingest_race_entries(t: Tables, rows: DataFrame, seen: Column, source: str = "race_scoring") -> DataFrame:
    """Race-scoring entries (rows of ``staged_race_entries``): known entries are only seen again; others bring boats, owners, clubs and entries. Returns the rejects."""
    events_of = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == "event")).select(F.col("source_id").alias("event_id"), F.col("entity_id").alias("instance_id")).distinct()
    known = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == "entry")).select(F.col("source_id").alias("entry_key"), F.col("entity_id").alias("_known")).distinct()
    key = F.when(F.col("entry_id").isNotNull(), F.concat_ws("|", "event_id", "entry_id"))
    rows = rows.withColumn("entry_key", key).join(events_of, "event_id", "left").join(known, "entry_key", "left")
    rows = table(rows, "race-entries")
    xrefs(t, rows.where("_known is not null"), "entry", source, "entry_key", "_known", seen)
    new = rows.where("_known is null and instance_id is not null and yacht_slug is not null and reject_reason is null").drop("_known", "reject_reason")
    new = new.withColumns({"person_xref": F.col("xref_key"), "xref_key": keys.yacht_key(F.col("yacht_name"), F.col("sail_number"))})
    done, torn = _both(t, table(new, "race-entries-new"), "race", "strict_name", source, "yacht", "participant")
    xrefs(t, done.withColumn("boat_key", keys.yacht_key(F.col("yacht_name"), F.col("sail_number"))), "yacht", source, "boat_key", "yacht_id", seen)
    xrefs(t, done, "participant", source, "xref_key", "participant_id", seen)
    members = clubs(t, done.where("participant_id is not null").withColumn("club_name", F.col("affiliation")).where("club_name is not null"), source)
    memberships(t, members, source)
    done = done.withColumns({"entry_status": F.lit("submitted"), "registration_external_id": F.col("entry_id"), "registered_at": F.lit(None).cast("timestamp")}).drop("entry_id")
    entered = entries(t, done, source)
    xrefs(t, entered, "entry", source, "entry_key", "entry_id", seen)
    crews(t, entered, "owner_contact", "non_participating_contact", source)
    lost = rows.where("_known is null").join(new.select("_ordinal"), "_ordinal", "left_anti").drop("_known")
    reason = F.coalesce(F.col("reject_reason"), F.when(F.col("instance_id").isNull(), "unresolved_event_link").otherwise("missing_required_identity"))
    return lost.withColumn("reject_reason", reason).unionByName(torn.select(*[c for c in torn.columns if c in lost.columns]), allowMissingColumns=True)


def ingest_race_yachts(t: Tables, rows: DataFrame, seen: Column, source: str = "race_scoring") -> DataFrame:
    """Unique boats of race-scoring: boats and their cross-references, no entries. Returns the rejects."""
    y = _with(rows, "sailNumber", "yachtType").withColumns({"yacht_name": text.squeezed(F.col("yachtName")), "sail_number": text.trimmed(F.col("sailNumber")), "yacht_type": text.trimmed(F.col("yachtType"))})
    y = y.withColumns({"yacht_slug": text.slug(F.col("yacht_name")), "sail_slug": text.slug(F.col("sail_number")), "xref_key": keys.yacht_key(F.col("yacht_name"), F.col("sail_number"))})
    done = boats(t, y.where("yacht_slug is not null"), "race", source)
    xrefs(t, done.where("yacht_id is not null"), "yacht", source, "xref_key", "yacht_id", seen)
    return _rejected(y.where("yacht_slug is null"), "missing_required_identity").unionByName(_rejected(done.where("yacht_id is null").select(*y.columns), "ambiguous_match"))
