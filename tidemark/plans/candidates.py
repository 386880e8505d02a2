"""Candidates of five kinds from operational rows and feeds, their evidence and their links to sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keys
from tidemark.lineage import table
from tidemark.operators import lifecycle, merge

#: Roles of entries as candidates name them.
ROLES = {"skipper": "skipper", "owner": "owner", "co_owner": "co_owner", "owner_contact": "owner", "crew": "crew", "registrant": "registrant"}
FINGERPRINTS = {
    "club": lambda: keys.club_fingerprint(F.col("normalized_name")),
    "yacht": lambda: keys.yacht_fingerprint(F.col("normalized_name"), F.col("normalized_sail_number")),
    "event": lambda: keys.event_fingerprint(F.col("normalized_event_name"), F.col("season_year"), F.col("event_external_id")),
    "participant": lambda: keys.participant_fingerprint(F.col("normalized_name"), F.col("best_email")),
    "registration": lambda: keys.registration_fingerprint(F.col("registration_external_id"), F.col("candidate_event_id"), F.col("candidate_yacht_id")),
}


def upserted(kind: str, old: DataFrame, rows: DataFrame, fields: Sequence[str], source: str, score: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """New version of the candidates of a kind, and link rows from each source row to its candidate.

    ``rows`` have the fields, ``source_pk`` and ``seq``. Rows of one fingerprint
    are one candidate, whose null fields the first non-null values fill; its id
    follows from the fingerprint.
    """
    marked = rows.withColumn("stable_fingerprint", FINGERPRINTS[kind]())
    new = merge.fill_null_merge(old, marked, ["stable_fingerprint"], fields, "seq").withColumn("id", keys.entity_id(f"candidate_{kind}", F.col("stable_fingerprint")))
    links = marked.select(keys.entity_id(f"candidate_{kind}", F.col("stable_fingerprint")).alias("candidate_id"), F.lit(kind).alias("entity_type"), F.lit(source).alias("source_table"), F.col("source_pk").cast("string").alias("source_pk"), F.lit(score).cast("decimal(5,4)").alias("link_score"))
    return new, links.dropDuplicates(["entity_type", "candidate_id", "source_table", "source_pk"])


def participants(old: DataFrame, rows: DataFrame, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like :func:`upserted`, but a row without e-mail joins the one candidate of its name that has one.

    The third result are rows whose name several such candidates share: they
    stand alone, with a warning.
    """
    fields = ["normalized_name", "display_name", "best_email", "best_phone", "date_of_birth"]
    known = old.select(keys.entity_id("candidate_participant", F.col("stable_fingerprint")).alias("id"), "normalized_name", "best_email")
    batch = rows.select(keys.entity_id("candidate_participant", keys.participant_fingerprint(F.col("normalized_name"), F.col("best_email"))).alias("id"), "normalized_name", "best_email")
    checked = lifecycle.prevented(rows, known.unionByName(batch).distinct())
    by_id = known.unionByName(batch).where(F.col("best_email").isNotNull()).select(F.col("id").alias("reuse_id"), F.col("best_email").alias("_e")).distinct()
    joined = checked.join(by_id, "reuse_id", "left").withColumn("best_email", F.coalesce("best_email", "_e")).drop("_e", "reuse_id")
    new, links = upserted("participant", old, joined.drop("ambiguous_name"), fields, source)
    return new, links, joined.where("ambiguous_name").select("source_pk", "normalized_name")


def evidence(links: DataFrame, rows: DataFrame, column: str, kind: str) -> DataFrame:
    """Contact rows of candidates from a column of source rows."""
    value = rows.select(F.col("source_pk").cast("string").alias("source_pk"), F.col(column).alias("normalized_value")).where(F.col(column).isNotNull())
    return links.join(value, "source_pk").select("candidate_id", F.lit(kind).alias("contact_type"), "normalized_value").distinct()


def registrations(entries: DataFrame, crew: DataFrame, links: DataFrame) -> DataFrame:
    """Registrations of entries whose event is a candidate; the skipper is primary, else the owner's contact.

    ``links``: entity_type, source_table, source_pk, candidate_id. Entries of
    unknown events are left out; their number is the difference of counts.
    """
    of = lambda kind, name: links.where(F.col("entity_type") == kind).groupBy(F.col("source_pk").alias(name)).agg(F.min("candidate_id").alias(f"candidate_{kind}_id"))
    first: Column = F.when(F.col("role") == "skipper", 0).when(F.col("role") == "owner_contact", 1)
    lead = crew.where(first.isNotNull()).groupBy("entry_id").agg(F.min_by("participant_id", F.struct(first, "seq")).alias("participant_id"))
    d = entries.join(of("event", "event_id"), "event_id").join(of("yacht", "yacht_id"), "yacht_id", "left").join(lead, "entry_id", "left").join(of("participant", "participant_id"), "participant_id", "left")
    return d.select(F.col("entry_id").alias("source_pk"), "registration_external_id", "entry_status", "registered_at", "candidate_event_id", "candidate_yacht_id", F.col("candidate_participant_id").alias("candidate_primary_participant_id"))


def bridged(raw: DataFrame, *hops: tuple[DataFrame, str, str]) -> DataFrame:
    """Follow a chain of lookups from raw rows; ``failed_hop`` numbers the first that finds nothing, from 1.

    Each hop is (table, key column, value column); a key leads to its least value.
    """
    d, failed = raw, None
    for i, (table, key, value) in enumerate(hops, 1):
        per = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
        d = d.join(per, key, "left")
        miss = F.when(F.col(value).isNull(), i)
        failed = miss if failed is None else F.coalesce(failed, miss)
    return d.withColumn("failed_hop", failed if failed is not None else F.lit(None).cast("int"))


def roles(crew: DataFrame) -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    return crew.withColumn("role", F.coalesce(table[F.col("role")], F.lit("other"))).dropDuplicates(["entry_id", "participant_id", "role"])


SCHEMAS = {
    "club": "stable_fingerprint string, normalized_name string, name string, website string, phone string, state_usa string",
    "event": "stable_fingerprint string, normalized_event_name string, event_name string, season_year int, event_external_id string, start_date date, end_date date",
    "yacht": "stable_fingerprint string, normalized_name string, name string, sail_number string, normalized_sail_number string, yacht_type string, length_feet decimal(6,2)",
    "participant": "stable_fingerprint string, normalized_name string, display_name string, best_email string, best_phone string, date_of_birth date",
    "registration": "stable_fingerprint string, registration_external_id string, entry_status string, registered_at timestamp, candidate_event_id string, candidate_yacht_id string, candidate_primary_participant_id string",
}
LINK = "entity_type string, candidate_id string, source_table string, source_pk string, link_score decimal(5,4)"
CHILDREN = {
    "contact": ("candidate_id string, contact_type string, normalized_value string, raw_value string", ["candidate_id", "contact_type", "_key"]),
    "address": ("candidate_id string, address_raw string, seq long", ["candidate_id", "address_raw"]),
    "role": ("candidate_id string, role string, entry_id string, source_table string", ["candidate_id", "role", "entry_id"]),
}

# Tables that no candidates are made from, and why.
SKIPPED = {
    "looked at through another table": ("series", "contact", "address", "membership", "ownership", "audience_state", "audience_tag"),
    "tracks documents": ("document_type", "document_requirement", "document_status"),
    "says where sources went": ("xref", "raw_assets", "identity_queue", "provider_identity"),
    "is the candidate layer": tuple(f"candidate_{k}" for k in (*SCHEMAS, *CHILDREN)) + ("source_links",),
    "is the canonical layer": tuple(f"canonical_{k}" for k in SCHEMAS) + tuple(f"links_{k}" for k in SCHEMAS) + ("provenance",),
    "governs runs": ("rule_sets", "score_runs", "audit", "lineage_snapshots", "lookups", "lookup_runs", "activation_runs", "activation_rows"),
}


def skipped(spark: SparkSession) -> DataFrame:
    """(table, reason) of each table that is left out on purpose."""
    return spark.createDataFrame([(t, why) for why, names in SKIPPED.items() for t in names], "table string, reason string")


class Builder:
    """Candidates by kind, links and evidence as they are, and as steps add to them; nothing known is ever overwritten."""

    def __init__(self, spark: SparkSession, held: Mapping[str, DataFrame]):
        self.spark, self.warned = spark, None
        empty = lambda schema: spark.createDataFrame([], schema)
        names = {k: [c.split()[0] for c in v.split(", ")] for k, v in SCHEMAS.items()}
        self.kinds = {k: held[f"candidate_{k}"].select(*names[k]) if f"candidate_{k}" in held else empty(v) for k, v in SCHEMAS.items()}
        self.links = held["source_links"] if "source_links" in held else empty(LINK)
        self.children = {k: held[f"candidate_{k}"] if f"candidate_{k}" in held else empty(v[0]) for k, v in CHILDREN.items()}

    def _linked(self, new: DataFrame) -> None:
        order = [c.split()[0] for c in LINK.split(", ")]
        fresh = merge.insert_absent(self.links, new.select(*order), ["entity_type", "candidate_id", "source_table", "source_pk"])
        self.links = table(self.links.unionByName(fresh), "source-links")

    def add(self, kind: str, rows: DataFrame, source: str, score: float = 1.0) -> None:
        """Candidates from rows with the kind's fields, source_pk and seq."""
        names = [c.split()[0] for c in SCHEMAS[kind].split(", ")][1:]
        new, links = upserted(kind, self.kinds[kind], rows, names, source, score)
        self.kinds[kind] = table(new.select("stable_fingerprint", *names), f"candidate-{kind}")
        self._linked(links)

    def add_people(self, rows: DataFrame, source: str, role: str | None = None, prevent: bool = True) -> None:
        """Candidates from people (normalized_name, display_name, best_email, best_phone, date_of_birth, source_pk, seq), with what they show as evidence.

        Unless ``prevent`` is off, a row without e-mail joins the one candidate of its name that has one.
        """
        rows = table(rows.where("normalized_name is not null"), "people")
        if prevent:
            new, links, warned = participants(self.kinds["participant"], rows, source)
            self.warned = warned if self.warned is None else self.warned.unionByName(warned)
        else:
            new, links = upserted("participant", self.kinds["participant"], rows, ["normalized_name", "display_name", "best_email", "best_phone", "date_of_birth"], source)
        self.kinds["participant"] = table(new.select(*[c.split()[0] for c in SCHEMAS["participant"].split(", ")]), "candidate-participant")
        mine = table(links, "links")
        self._linked(mine)
        self.add_contacts(evidence(mine, rows, "best_email", "email").unionByName(evidence(mine, rows, "best_phone", "phone")).withColumn("raw_value", F.col("normalized_value")))
        if "address_raw" in rows.columns:
            places = mine.join(rows.select(F.col("source_pk").cast("string").alias("source_pk"), "address_raw"), "source_pk").where("address_raw is not null")
            self.add_addresses(places)
        if role is not None:
            self.add_roles(mine.select("candidate_id", F.lit(role).alias("role"), F.lit(None).cast("string").alias("entry_id"), F.lit(source).alias("source_table")))

    def add_contacts(self, rows: DataFrame) -> None:
        """Contacts, once per candidate, kind and normal form, or raw text where there is none."""
        keyed = lambda df: df.withColumn("_key", merge.contact_key(F.col("normalized_value"), F.col("raw_value")))
        new = keyed(rows.select("candidate_id", "contact_type", "normalized_value", "raw_value")).where("_key is not null")
        fresh = merge.insert_absent(keyed(self.children["contact"]), new, CHILDREN["contact"][1]).drop("_key")
        self.children["contact"] = table(self.children["contact"].unionByName(fresh), "contacts")

    def add_addresses(self, rows: DataFrame) -> None:
        fresh = merge.insert_absent(self.children["address"], rows.select("candidate_id", "address_raw", F.xxhash64("address_raw").alias("seq")), CHILDREN["address"][1])
        self.children["address"] = table(self.children["address"].unionByName(fresh), "addresses")

    def add_roles(self, rows: DataFrame) -> None:
        fresh = merge.insert_absent(self.children["role"], rows.select("candidate_id", "role", "entry_id", "source_table"), CHILDREN["role"][1])
        self.children["role"] = table(self.children["role"].unionByName(fresh), "roles")

    def of(self, kind: str, source: str, name: str) -> DataFrame:
        """(name, candidate_id) of a source table's rows: the least candidate each is linked to."""
        live = self.links.where((F.col("entity_type") == kind) & (F.col("source_table") == source))
        return live.groupBy(F.col("source_pk").alias(name)).agg(F.min("candidate_id").alias("candidate_id"))


def from_operational(b: Builder, t: Mapping[str, DataFrame]) -> None:
    """Clubs, events, boats, people and registrations of the operational tables, in this order."""
    none = lambda kind: F.lit(None).cast(kind)
    b.add("club", t["club"].select(F.col("slug").alias("normalized_name"), "name", "website", none("string").alias("phone"), none("string").alias("state_usa"), F.col("id").alias("source_pk"), F.col("id").alias("seq")).where("normalized_name is not null"), "club")
    held = t["instance"].join(t["series"].select(F.col("id").alias("series_id"), "slug"), "series_id")
    b.add("event", held.select(F.col("slug").alias("normalized_event_name"), F.col("display_name").alias("event_name"), "season_year", none("string").alias("event_external_id"), none("date").alias("start_date"), none("date").alias("end_date"), F.col("id").alias("source_pk"), F.col("id").alias("seq")), "instance")
    b.add("yacht", t["yacht"].select(F.col("yacht_slug").alias("normalized_name"), "name", "sail_number", F.col("sail_slug").alias("normalized_sail_number"), "yacht_type", "length_feet", F.col("id").alias("source_pk"), F.col("id").alias("seq")), "yacht")

    best = lambda kind: t["contact"].where(F.col("contact_type") == kind).groupBy(F.col("participant_id").alias("id")).agg(F.min_by("normalized", F.struct(~F.coalesce("is_primary", F.lit(False)), "normalized")).alias(f"best_{kind}"))
    people = t["participant"].join(best("email"), "id", "left").join(best("phone"), "id", "left")
    b.add_people(people.select(F.col("normalized_full_name").alias("normalized_name"), F.col("full_name").alias("display_name"), "best_email", "best_phone", none("date").alias("date_of_birth"), F.col("id").alias("source_pk"), F.col("id").alias("seq")), "participant")
    who = table(b.of("participant", "participant", "participant_id"), "who")
    b.add_contacts(t["contact"].join(who, "participant_id").select("candidate_id", "contact_type", F.col("normalized").alias("normalized_value"), F.col("raw").alias("raw_value")))
    b.add_addresses(t["address"].join(who, "participant_id").select("candidate_id", "address_raw"))

    crew = t["crew"].withColumn("seq", F.xxhash64("participant_id"))
    links = b.links.where(F.col("source_table").isin("instance", "yacht", "participant"))
    held = t["entry"].select(F.col("id").alias("entry_id"), F.col("instance_id").alias("event_id"), "yacht_id", "registration_external_id", "entry_status", "registered_at")
    b.add("registration", registrations(held, crew, links).withColumn("seq", F.col("source_pk")), "entry")
    sailing = roles(crew).join(who, "participant_id")
    b.add_roles(sailing.select("candidate_id", "role", "entry_id", F.lit("crew").alias("source_table")))


def from_audience(b: Builder, states: DataFrame, queue: DataFrame) -> None:
    """Evidence of audience rows: those of resolved people belong to these people's candidates; quarantined rows are left out."""
    who = b.of("participant", "participant", "participant_id")
    live = table(states.join(queue.select("source_file", "row_hash").distinct(), ["source_file", "row_hash"], "left_anti").join(who, "participant_id"), "audience-rows")
    b._linked(live.select(F.lit("participant").alias("entity_type"), "candidate_id", F.lit("audience_state").alias("source_table"), F.col("row_hash").alias("source_pk"), F.lit(1).cast("decimal(5,4)").alias("link_score")))
    b.add_contacts(live.select("candidate_id", F.lit("email").alias("contact_type"), F.col("email").alias("normalized_value"), F.col("email").alias("raw_value")).distinct())


#: From raw rows of a feed to candidates: the cross-reference's kind, the key in the staged row, the kind and table of the link.
BRIDGES = {
    "base_clubs": ("club", "source_id", "club", "club"),
    "base_events": ("event", "source_id", "event", "instance"),
    "base_yachts": ("yacht", "source_id", "yacht", "yacht"),
    "base_entries": ("event", "event_key", "registration", "entry"),
    "race_events": ("event", "event_id", "event", "instance"),
    "race_entries_plain": ("entry", "entry_key", "registration", "entry"),
    "race_yachts": ("yacht", "boat_key", "yacht", "yacht"),
}


def bridge(b: Builder, feed: str, rows: DataFrame, t: Mapping[str, DataFrame], source: str) -> DataFrame:
    """Link the raw rows of a feed (row_hash and its key) to the candidates that they became; returns how many each hop lost.

    Entries of the base copy go from the event's key to the entry with their external id.
    """
    xref, key, kind, origin = BRIDGES[feed]
    ids = t["xref"].where((F.col("source_system") == source) & (F.col("kind") == xref)).select(F.col("source_id").alias(key), F.col("entity_id").alias("_entity"))
    hops = [(ids, key, "_entity")]
    if feed == "base_entries":
        per = t["entry"].select(F.concat_ws("|", "instance_id", "registration_external_id").alias("_pair"), F.col("id").alias("_entry"))
        rows = rows.join(ids.groupBy(key).agg(F.min("_entity").alias("_entity")), key, "left").withColumn("_pair", F.when(F.col("_entity").isNotNull(), F.concat_ws("|", "_entity", "external_id")))
        hops = [(per, "_pair", "_entry")]
    hops.append((b.of(kind, origin, hops[-1][2]), hops[-1][2], "candidate_id"))
    found = table(bridged(rows.select("row_hash", hops[0][1]), *hops), "bridged")
    b._linked(found.where("candidate_id is not null").select(F.lit(kind).alias("entity_type"), "candidate_id", F.lit(f"raw_{feed}").alias("source_table"), F.col("row_hash").alias("source_pk"), F.lit(1).cast("decimal(5,4)").alias("link_score")).distinct())
    return found.groupBy("failed_hop").agg(F.count("*").alias("n")).select(F.lit(feed).alias("feed"), "failed_hop", "n")
