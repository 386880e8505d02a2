"""From feed rows to staged rows: keys and parts by one projection, and the first reason to reject a row.

:mod:`tidemark.plans.operational` takes the accepted rows from there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, keys, text, urls
from tidemark.operators import gates, latest
from tidemark.sources import feeds

def staged_owners(df: DataFrame) -> DataFrame:
    """Owner export: keys and parts of each row; rows without sku, owner or yacht are rejected, in that order."""
    c = lambda n: text.trimmed(F.col(f"`{n}`"))
    rules = [(c("sku").isNull(), "missing_sku"), (c("ownername").isNull(), "missing_ownername"), (c("Yacht Name").isNull(), "missing_yacht_name")]
    d = gates.with_reason(df, rules)
    return d.withColumns(
        {
            "external_id": c("sku"), "owners": text.owners(F.col("ownername"), F.col("Name")), "email": text.email(F.col("Email")), "home_phone": text.phone(F.col("owner_hphone")), "cell_phone": text.phone(F.col("owner_cphone")),
            "name_key": text.person_key(F.col("ownername")), "address_raw": text.joined_address(*[F.col(x) for x in ("owner_address", "City", "owner_state", "owner_zip", "ccode")]), "yacht_slug": text.slug(F.col("Yacht Name")),
            "length_feet": text.decimal(F.col("LOA"), 6, 2), "registered_at": dates.timestamp(F.col("date_entered")), "entry_status": feeds.entry_status(),
            "club_slug": F.when(~feeds.placeholder_club(F.col("Club"), F.col("org_abbrev")), text.slug(F.col("Club"))),
        }
    )


def earliest_open(staged: DataFrame) -> DataFrame:
    """Earliest entry time of accepted rows: when registration opened."""
    return staged.where(F.col("reject_reason").isNull()).agg(F.min("registered_at").alias("registration_open_at"))


def staged_events(df: DataFrame, base: str) -> DataFrame:
    """Public events by canonical URL, the last row of each; rows without a race id are left out."""
    d = df.withColumns({"canonical_url": urls.entries_url(F.col("entries_url"), base), "race": urls.race(F.col("entries_url")), "series_slug": text.slug(F.col("Event Name")), "club_slug": text.slug(F.col("Host Club"))})
    d = d.where(F.col("race.race_id").isNotNull() & F.col("canonical_url").isNotNull())
    return latest.latest_per_key(d, ["canonical_url"], [F.desc("_ordinal")])


def staged_entries(df: DataFrame, events: DataFrame, base: str, synthesize: bool = True) -> DataFrame:
    """Public entries with their event; the first of an external id counts, and unknown events are synthesized or rejected.

    The external id is the sku of the history link, else a hash of the row's
    identifying fields.
    """
    blank = lambda n: F.coalesce(F.col(f"`{n}`"), F.lit(""))
    sku = urls.sku(F.col("Hist")) if "Hist" in df.columns else F.lit(None).cast("string")
    sail = blank("Sail Num") if "Sail Num" in df.columns else F.lit("")
    d = df.withColumns(
        {
            "external_id": F.coalesce(sku, keys.entry_hash(blank("source"), blank("entries_url"), blank("Fleet"), blank("Name"), blank("Yacht Name"), sail)), "canonical_url": urls.entries_url(F.col("entries_url"), base),
            "name_key": text.person_key(F.col("Name")), "yacht_slug": text.slug(F.col("`Yacht Name`")), "sail_slug": text.slug(sail), "season_year": F.coalesce(dates.tag_year(F.col("source")), urls.race(F.col("entries_url"))["yr"]),
        }
    )
    d = latest.first_wins(d, "external_id", "_ordinal", "duplicate_external_id").withColumnRenamed("reject_reason", "_dup")
    d = d.join(events.select("canonical_url", F.lit(True).alias("_known")), "canonical_url", "left")
    rules = [(F.col("_dup").isNotNull(), F.col("_dup")), (F.col("name_key").isNull(), "missing_name"), (F.col("yacht_slug").isNull(), "missing_yacht_name"), (F.col("_known").isNull() & F.lit(not synthesize), "unknown_event")]
    return gates.with_reason(d, rules).withColumn("event_synthesized", F.col("_known").isNull()).drop("_dup", "_known")


def staged_waivers(df: DataFrame) -> DataFrame:
    """Waivers: every row is kept raw; those without a name resolve to nobody."""
    phone_col = "Numbers only, No dashes. Start with area code"
    number = F.col(f"`{phone_col}`") if phone_col in df.columns else F.lit(None).cast("string")
    return gates.with_reason(df, [(text.trimmed(F.col("Name")).isNull(), "missing_name")]).withColumns(
        {"submission_id": text.trimmed(F.col("`Submission ID`")), "submitted_on": dates.day(F.col("`Submission Date`")), "name_key": text.person_key(F.col("Name")), "email": text.email(F.col("`Competitor E mail`")), "phone": text.phone(number)}
    )


def staged_audience(df: DataFrame) -> DataFrame:
    """Audience rows: blank and malformed addresses are rejected, tags are a list."""
    mail = text.email(F.col("`Email Address`"))
    get = lambda n: F.col(f"`{n}`") if n in df.columns else F.lit(None).cast("string")
    d = gates.with_reason(df, [(mail.isNull(), "missing_email"), (~text.email_ok(mail), "invalid_email")])
    return d.withColumns(
        {
            "email": mail, "name_key": text.person_key(text.full_name(get("First Name"), get("Last Name"))), "phone": text.phone(get("Phone Number")), "address": text.trimmed(get("Address")), "tags": text.tags(get("TAGS")),
            "leid": text.trimmed(get("LEID")), "euid": text.trimmed(get("EUID")), "rating": text.whole_number(get("MEMBER_RATING")), "status_at": dates.timestamp(F.col("status_at_raw")),
        }
    )


def staged_race_entries(df: DataFrame, kind: str) -> DataFrame:
    """Race-scoring rows: ids by kind of file, owner and boat keys; rows without ids or boat are rejected."""
    event_id, entry_id = feeds.race_ids(kind)
    plain = kind == "race_entries_plain"
    get = lambda a, b: F.col(f"`{a if plain else b}`") if (a if plain else b) in df.columns else F.lit(None).cast("string")
    owner, yacht, sail, kind_of, club, place = get("ownerName", "flex"), get("yachtName", "title-small 2"), get("sailNumber", "title-small"), get("yachtType", "tablescraper-selected-row 3"), get("ownerAffiliation", "tablescraper-selected-row"), get("ownerLocation", "tablescraper-selected-row 2")
    d = df.withColumns({"event_id": event_id, "entry_id": entry_id, "xref_key": keys.owner_key(owner, club, place), "name_key": text.person_key(owner), "yacht_slug": text.slug(yacht), "sail_slug": text.slug(sail), "yacht_type": text.trimmed(kind_of), "full_name": text.squeezed(owner), "yacht_name": text.squeezed(yacht), "sail_number": text.trimmed(sail), "affiliation": text.trimmed(club)})
    return gates.with_reason(d, [(F.col("event_id").isNull(), "missing_event_id"), (F.col("yacht_slug").isNull() & F.col("sail_slug").isNull(), "missing_yacht")])


def staged_base(df: DataFrame, feed: str) -> DataFrame:
    """Rows of a base-copy file: source id, keys and parts by feed, and the first reason to reject."""
    get = lambda n: text.trimmed(F.col(f"`{n}`")) if n in df.columns else F.lit(None).cast("string")
    member = lambda c, k: F.get_json_object(c, f"$.{k}")  # noqa: E731  numbers and texts alike
    if feed == "base_clubs":
        d, needs = df.withColumns({"source_id": get("club_global_id"), "club_slug": text.slug(get("Name")), "website": get("Website"), "phone": text.phone(get("Phone")), "state_usa": get("stateUSA")}), ("club_slug",)
    elif feed == "base_events":
        ids, ref = get("event_global_id"), urls.race(get("entries_url"))
        race, yr = F.coalesce(member(ids, "race_id"), ref["race_id"]), F.coalesce(dates.tag_year(get("source")), member(ids, "yr").try_cast("int"), ref["yr"])
        d, needs = df.withColumns({"source_id": keys.race_key(race, yr), "series_slug": text.slug(dates.without_year(get("Event Name"))), "season_year": yr, "club_slug": text.slug(get("Host Club")), "source_ok": get("source").rlike(r"_\d{4}$")}), ("series_slug", "season_year")
    elif feed == "base_yachts":
        d, needs = df.withColumns({"source_id": get("yacht_global_id"), "yacht_slug": text.slug(get("yachtName")), "sail_slug": text.slug(get("sailNumber")), "length_feet": text.decimal(get("yachtLoa"), 6, 2), "yacht_type": get("yachtType")}), ("yacht_slug",)
    elif feed in ("base_owners", "base_participants"):
        own = feed == "base_owners"
        mail = get("ownerEmail" if own else "competitorE")
        name = F.coalesce(get("ownerName"), get("skipperName")) if own else F.coalesce(get("name"), mail)
        home, cell = text.phone(get("ownerHomePhone")), text.phone(get("ownerCellPhone"))
        tel = F.coalesce(home, cell) if own else text.phone(get("numbersOnly"))
        place = text.joined_address(*[get(x) for x in (("ownerAddressLine1", "ownerAddressLine2", "ownerCity", "ownerState", "ownerPostal") if own else ("address", "postalCode"))])
        d, needs = df.withColumns({"source_id": get("owner_global_id" if own else "participant_global_id"), "full_name": F.coalesce(text.squeezed(name), mail), "name_key": text.person_key(name), "email": text.email(mail), "phone": tel, "address_raw": place}), ("full_name",)
        if own:
            d = d.withColumns({"home_phone": home, "cell_phone": cell})
    elif feed == "base_entries":
        ids = get("eventUuid")
        sku = F.coalesce(get("entriesSku"), urls.sku(get("Hist")), keys.entry_hash(*[get(x) for x in ("source", "entries_url", "Fleet", "Name", "Yacht Name", "Sail Num")]))
        race = keys.race_key(F.coalesce(member(ids, "race_id"), urls.parameter(get("entries_url"), "race_id")), F.coalesce(member(ids, "yr").try_cast("int"), urls.race(get("entries_url"))["yr"]))
        d, needs = df.withColumns({"source_id": get("entries_global_id"), "external_id": sku, "event_key": race, "name_key": text.person_key(get("Name")), "yacht_slug": text.slug(get("Yacht Name")), "sail_slug": text.slug(get("Sail Num"))}), ("yacht_slug",)
    else:
        raise ValueError(feed)
    return gates.with_reason(d, [(F.col(n).isNull(), f"missing_{n}") for n in needs])


def related_contacts(waivers: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Guardians and emergency contacts of waivers: ``columns`` maps a name column to its kind; once per participant, kind and name."""
    rows = F.array(*[F.struct(F.lit(kind).alias("related_type"), text.squeezed(F.col(f"`{c}`")).alias("full_name")) for c, kind in columns.items()])
    out = waivers.where(F.col("participant_id").isNotNull()).select("participant_id", F.explode(rows).alias("r")).select("participant_id", "r.*")
    return out.where(F.col("full_name").isNotNull()).withColumn("name_key", text.person_key(F.col("full_name"))).dropDuplicates(["participant_id", "related_type", "full_name"])


def signed_documents(waivers: DataFrame, requirement: str) -> DataFrame:
    """Status rows that waivers give: received on the day of submission, with the links to the signed papers."""
    links = text.lines(F.col("`Signed Document`")) if "Signed Document" in waivers.columns else F.array().cast("array<string>")
    live = waivers.where(F.col("participant_id").isNotNull() & F.col("submitted_on").isNotNull())
    rows = live.select(F.lit(requirement).alias("document_requirement_id"), "participant_id", F.lit("received").alias("status"), F.col("submitted_on").alias("status_at"), links.alias("links"))
    return latest.latest_per_key(rows, ["document_requirement_id", "participant_id"], [F.desc("status_at")])


def profile_candidates(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates in review from merged member profiles (member_id and the columns of ``merged_profile``): members, and their household.

    Members link to their page at 0.95, household members at 0.7.
    """
    mail = text.email(F.get("all_emails", F.lit(0)))
    tel = F.get(F.transform("all_phones", lambda x: x["key"]), F.lit(0))
    base = profiles.where(text.person_key(F.col("display_name")).isNotNull())
    state, score = F.lit("review"), lambda v: F.lit(v).cast("decimal(5,4)")
    members = base.select("member_id", text.squeezed(F.col("display_name")).alias("display_name"), text.person_key(F.col("display_name")).alias("normalized_name"), mail.alias("best_email"), tel.alias("best_phone"), F.lit("member").alias("role"), state.alias("resolution_state"), score(0.95).alias("link_score"))
    others = profiles.select("member_id", F.explode("p.household").alias("h"))
    none = F.lit(None).cast("string")
    home = others.select("member_id", text.squeezed(F.col("h.name")).alias("display_name"), text.person_key(F.col("h.name")).alias("normalized_name"), none.alias("best_email"), none.alias("best_phone"), F.col("h.relationship").alias("role"), state.alias("resolution_state"), score(0.7).alias("link_score"))
    return members, home.where(F.col("normalized_name").isNotNull()).dropDuplicates(["member_id", "normalized_name", "role"])
