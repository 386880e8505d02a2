"""Feeds that resolve and write, candidates from tables, and bridges, over rows shaped like the feeds' own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import lifecycle
from tidemark.plans import candidates, ingest, operational
from tidemark.queries import query, read
from tidemark.sources import feeds


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _rows(df: DataFrame, seq: Column, **columns: Column) -> DataFrame:
    """Feed rows with text columns (a name may be given as ``_`` for each space) in the order of ``seq``."""
    return df.select(*[c.cast("string").alias(n) for n, c in columns.items()], F.lit("f").alias("_source_file"), seq.cast("long").alias("_ordinal"))


@query("""
with r as (select c_custkey as k, c_custkey % 40 as b, case when c_custkey % 3 <> 0 then 'Mail ' || min(c_custkey) over (partition by c_custkey % 500, c_custkey % 3 <> 0) else 'Solo ' || c_custkey % 97 end as who from customer),
e as (select b, 's' || min(k) as external_id, case when bool_or(k % 6 = 0 or k % 7 = 0) then 'confirmed' else 'submitted' end as entry_status, min(1 + k % 28)::bigint as day from r group by b),
c as (select b, who from r union select b, 'Mate ' || k % 50 from r where k % 10 = 0)
select 'boat-' || c.b as yacht_slug, who as full_name, external_id, entry_status, day from c join e using (b)
""")
def ingest_owners(spark, d):
    """Owners meet by e-mail whatever their name is, others by name; boats, entries and crews follow."""
    k = F.col("c_custkey")
    mail = k % 3 != 0
    name = F.when(mail, _text("Mail ", k)).otherwise(_text("Solo ", k % 97))
    blank = F.lit("")
    rows = _rows(
        read(spark, d, "customer"), k, date_entered=_text("2025-05-", F.lpad((1 + k % 28).cast("string"), 2, "0"), " 8:00:00"), sku=_text("s", k), date_paid=F.when(k % 6 == 0, "2025-06-01 09:00:00").otherwise(""),
        **{"Paid Type": F.when(k % 7 == 0, "Free").otherwise("")}, ownername=name, Name=F.when(k % 10 == 0, F.concat(name, _text(" & Mate ", k % 50))).otherwise(""), owner_address=_text("Street ", k % 11), City=blank, owner_state=blank, ccode=blank,
        owner_zip=blank, owner_hphone=blank, owner_cphone=blank, Email=F.when(mail, _text("U", k % 500, "@x.org")).otherwise(""), org_name=_text("Club ", k % 30), Club=_text("Club ", k % 30), org_abbrev=F.when(k % 4 == 0, "RMS").otherwise(""),
        **{"Yacht Name": _text("Boat ", k % 40), "Boat  Type": blank}, LOA=F.when(k % 40 % 5 == 0, "").otherwise((20 + k % 4).cast("string")),
    )
    t = operational.Tables(spark)
    event = {"club_name": "Hull", "series_name": "Cup", "display_name": "Cup 2025", "season_year": 2025}
    operational.ingest_owners(t, ingest.staged_owners(rows).where("reject_reason is null").drop("reject_reason"), event, today=F.lit("2025-06-01").cast("date"))
    entry = t["entry"].select(F.col("id").alias("entry_id"), "yacht_id", "entry_status", F.col("registration_external_id").alias("external_id"), F.dayofmonth("registered_at").cast("long").alias("day"))
    boats, who = t["yacht"].select(F.col("id").alias("yacht_id"), "yacht_slug"), t["participant"].select(F.col("id").alias("participant_id"), "full_name")
    return t["crew"].join(entry, "entry_id").join(boats, "yacht_id").join(who, "participant_id").select("yacht_slug", "full_name", "external_id", "entry_status", "day")


@query("""
select 'Cup ' || o_orderkey % 40 as event, count(distinct (o_custkey % 500, o_custkey % 700)) as entries, count(distinct o_custkey) as registrants from orders group by 1
""")
def ingest_entries(spark, d):
    """Public entries of known and made-up events; people by name, boats by name and sail."""
    k, c, r = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderkey") % 40
    shown = spark.range(30)
    n = F.col("id")
    events = _rows(shown, n, source=F.lit("s_2025"), **{"Event Name": _text("Cup ", n), "Host Club": _text("Club ", n % 5)}, entries_url=_text("https://h/s?race_id=", n, "&yr=2025"))
    rows = _rows(
        read(spark, d, "orders"), k, source=F.lit("s_2025"), **{"Event Name": _text("Cup ", r), "Yacht Name": _text("Y ", c % 500), "Sail Num": _text("US ", c % 700)}, entries_url=_text("https://h/s?race_id=", r, "&yr=2025"), Fleet=F.lit("A"), Name=_text("P ", c), Hist=_text("x?sku=", k)
    )
    staged = ingest.staged_events(events, "b")
    good = ingest.staged_entries(rows, staged, "b").where("reject_reason is null").drop("reject_reason")
    t = operational.Tables(spark)
    operational.ingest_public(t, staged, good)
    crew = t["crew"].groupBy(F.col("entry_id").alias("id")).agg(F.collect_set("participant_id").alias("who"))
    per = t["entry"].join(crew, "id").groupBy(F.col("instance_id").alias("id")).agg(F.count("*").alias("entries"), F.size(F.array_distinct(F.flatten(F.collect_list("who")))).cast("long").alias("registrants"))
    return per.join(t["instance"], "id").select(F.col("display_name").alias("event"), "entries", "registrants")


@query("""
select 'club' as kind, count(*) as sources, count(distinct n_nationkey) as entities from nation union all select 'event', count(*), count(distinct n_nationkey) from nation
union all select 'yacht', count(*), count(distinct (s_suppkey % 60, s_suppkey % 80)) from supplier
union all select 'owner', count(*), count(distinct case when c_custkey % 2 = 0 then 'e' || c_custkey % 200 else 'n' || c_custkey % 300 end) from customer
union all select 'participant', count(*), count(distinct s_suppkey % 70) from supplier
union all select 'entry and crew', count(distinct (s_suppkey % 25, s_suppkey % 60, s_suppkey % 80)), count(distinct (s_suppkey % 25, s_suppkey % 60, s_suppkey % 80, s_suppkey % 70)) from supplier
""")
def ingest_base(spark, d):
    """A base copy: cross-references, and how many entities they lead to."""
    n, s, c = F.col("n_nationkey"), F.col("s_suppkey"), F.col("c_custkey")
    nation, supplier, customer = (read(spark, d, x) for x in ("nation", "supplier", "customer"))
    url = lambda k: _text("https://h?race_id=", k, "&yr=2024")
    even = c % 2 == 0
    rows = {
        "base_clubs": _rows(nation, n, Name=_text("Club ", n), club_global_id=_text("c", n), Website=_text("http://", n)),
        "base_events": _rows(nation, n, **{"Event Name": _text("2024 Cup ", n), "Host Club": _text("Club ", n)}, source=F.lit("s_2024"), entries_url=url(n)),
        "base_yachts": _rows(supplier, s, yachtName=_text("Boat ", s % 60), yacht_global_id=_text("y", s), sailNumber=_text("US ", s % 80), yachtLoa=F.lit("30"), yachtType=F.lit("J")),
        "base_owners": _rows(customer, c, ownerName=F.when(even, _text("Mail ", c)).otherwise(_text("Name ", c % 300)), owner_global_id=_text("o", c), ownerEmail=F.when(even, _text("m", c % 200, "@x.org")).otherwise(""), ownerAffiliation=_text("Club ", c % 25)),
        "base_participants": _rows(supplier, s, participant_global_id=_text("p", s), name=_text("Part ", s % 70), competitorE=F.lit(""), numbersOnly=F.lit("")),
        "base_entries": _rows(supplier, s, entries_global_id=_text("e", s), source=F.lit("s_2024"), **{"Event Name": F.lit("x"), "Yacht Name": _text("Boat ", s % 60), "Sail Num": _text("US ", s % 80)}, Name=_text("Part ", s % 70), entries_url=url(s % 25), entriesSku=_text("k", s)),
    }
    staged = {f: ingest.staged_base(df, f).where("reject_reason is null").drop("reject_reason") for f, df in rows.items()}
    t = operational.Tables(spark)
    operational.ingest_base(t, staged, F.lit("2025-01-01"), F.lit("2025-01-01").cast("date"))
    per = t["xref"].groupBy("kind").agg(F.count("*").alias("sources"), F.count_distinct("entity_id").alias("entities"))
    entries, crew = t["entry"].agg(F.count("*").alias("sources")), t["crew"].agg(F.count("*").alias("entities"))
    return per.unionByName(entries.join(crew, F.lit(True)).select(F.lit("entry and crew").alias("kind"), "sources", "entities"))


@query("""
with r as (select s_suppkey as s, s_suppkey % 30 as e from supplier)
select '2024 Race ' || e as event, count(distinct (s % 60, s % 80)) as entries, count(distinct s % 90) as owners, (select count(*) from r where e >= 25) as unresolved from r where e < 25 group by e
""")
def ingest_race(spark, d):
    """Race-scoring events and entries; rows of unknown events are rejected, a second run only sees entries again."""
    n, s = F.col("n_nationkey"), F.col("s_suppkey")
    t, seen = operational.Tables(spark), F.lit("2025-01-01")
    events = _rows(read(spark, d, "nation"), n, **{"title-small": _text("2024 Race ", n), "title-small href": _text("https://y/emenu/", n), "w-[20%]": F.lit("May 2024")})
    operational.ingest_race_events(t, events, seen)
    entries = _rows(read(spark, d, "supplier"), s, sailNumber=_text(s % 80), entryUrl=_text("https://y/boatdetail/", s % 30, "/", s), yachtName=_text("Boat ", s % 60), ownerName=_text("Own ", s % 90), ownerAffiliation=_text("Club ", s % 7), ownerLocation=F.lit("RI"), yachtType=F.lit("J"), eventUrl=F.lit(""))
    staged = ingest.staged_race_entries(entries, "race_entries_plain")
    lost = operational.ingest_race_entries(t, staged, seen).agg(F.count("*").alias("unresolved"))
    operational.ingest_race_entries(t, staged, F.lit("2025-01-02"))
    crew = t["crew"].join(t["entry"].select(F.col("id").alias("entry_id"), "instance_id"), "entry_id").groupBy("instance_id").agg(F.count_distinct("participant_id").alias("owners"))
    per = t["entry"].groupBy("instance_id").agg(F.count("*").alias("entries")).join(crew, "instance_id")
    return per.join(t["instance"].select(F.col("id").alias("instance_id"), F.col("display_name").alias("event")), "instance_id").join(lost, F.lit(True)).select("event", "entries", "owners", "unresolved")


@query("""
select 'W ' || c_custkey % 400 as full_name, count(distinct c_custkey % 600) as contacts, max(1 + c_custkey % 28)::bigint as day from customer group by 1
""")
def ingest_waivers(spark, d):
    """Waivers: people by name, their contacts, and the day of their latest paper."""
    k = F.col("c_custkey")
    rows = _rows(read(spark, d, "customer"), k, **{"Submission ID": _text("i", k), "Submission Date": _text("Jul ", 1 + k % 28, ", 2025"), "Competitor E mail": _text("w", k % 600, "@x.org"), "Signed Document": _text("u", k), "Guardian": _text("G ", k % 3)}, Name=_text("W ", k % 400))
    t = operational.Tables(spark)
    operational.ingest_waivers(t, ingest.staged_waivers(rows).where("reject_reason is null").drop("reject_reason"), {"Guardian": "guardian"}, "req")
    contacts = t["contact"].groupBy("participant_id").agg(F.count("*").alias("contacts"))
    papers = t["document_status"].select("participant_id", F.dayofmonth("status_at").cast("long").alias("day"))
    return t["participant"].select(F.col("id").alias("participant_id"), "full_name").join(contacts, "participant_id").join(papers, "participant_id").select("full_name", "contacts", "day")


@query("""
with r as (select c_custkey as k, c_custkey % 5 = 0 as known, c_custkey % 10 = 0 as wrong from customer)
select case when known and wrong then 'quarantined' when known then 'known' else 'new' end as what, count(*) as states, sum(case when (known and wrong) or k % 2 = 0 then 0 else 2 end)::bigint as tags from r group by 1
""")
def ingest_audience(spark, d):
    """Audience rows under the strict identity policy: known people, new ones, and rows whose name disagrees."""
    k = F.col("c_custkey")
    base = read(spark, d, "customer")
    t = operational.Tables(spark)
    old = base.where(k % 5 == 0)
    t.put("participant", old.select(_text("k", k).alias("id"), _text("Known ", k).alias("full_name"), _text("known ", k).alias("normalized_full_name"), F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name")))
    t.put("contact", old.select(_text("k", k).alias("participant_id"), F.lit("email").alias("contact_type"), F.lit("primary").alias("contact_subtype"), _text("a", k, "@x.org").alias("raw"), _text("a", k, "@x.org").alias("normalized"), F.lit(True).alias("is_primary"), F.lit("s").alias("source_system")))
    first = F.when(k % 10 == 0, "Other").when(k % 5 == 0, "Known").otherwise("New")
    rows = _rows(base, k, **{"Email Address": _text("A", k, "@x.org"), "First Name": first, "Last Name": _text(k)}, TAGS=F.when(k % 2 == 1, "t1,t2").otherwise(""), audience_status=F.lit("subscribed"), status_at_raw=F.lit("2025-01-01 00:00:00"), row_hash=_text("h", k))
    operational.ingest_audience(t, ingest.staged_audience(rows).where("reject_reason is null").drop("reject_reason"))
    tags = t["audience_tag"].groupBy("participant_id").agg(F.count("*").alias("n"))
    what = F.when(F.col("participant_id").startswith("k") & (F.length("participant_id") < 20), "known").otherwise("new")
    per = t["audience_state"].select("participant_id", what.alias("what")).join(tags, "participant_id", "left").groupBy("what").agg(F.count("*").alias("states"), F.sum(F.coalesce("n", F.lit(0))).alias("tags"))
    queue = t["identity_queue"].groupBy().agg(F.count("*").alias("states"))
    return per.unionByName(queue.select(F.lit("quarantined").alias("what"), "states", F.lit(0).cast("long").alias("tags")))


@query("select count(*) as n, count(distinct row_hash) as hashes, count(*) filter (row_hash = sha256('{\"priority\":\"1-URGENT\",\"status\":null}')) as urgent from (select distinct sha256('{\"priority\":\"' || o_orderpriority || '\",\"status\":' || case when o_orderstatus = 'F' then 'null' else '\"' || o_orderstatus || '\"' end || '}') as row_hash from orders)")
def raw_capture(spark, d):
    """Raw rows of a feed, each once, by the hash of their payload."""
    rows = _rows(read(spark, d, "orders"), F.col("o_orderkey"), priority=F.col("o_orderpriority"), status=F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")))
    kept = feeds.raw(rows, "unknown")
    urgent = F.sha2(F.lit('{"priority":"1-URGENT","status":null}'), 256)
    return kept.agg(F.count("*").alias("n"), F.count_distinct("row_hash").alias("hashes"), F.count_if(F.col("row_hash") == urgent).alias("urgent"))


def _tables(spark, d) -> dict[str, DataFrame]:
    """Operational tables that the benchmark's stand for."""
    t = operational.Tables(spark)
    n, s, c, o = F.col("n_nationkey"), F.col("s_suppkey"), F.col("c_custkey"), F.col("o_orderkey")
    nation, supplier, customer, orders = (read(spark, d, x) for x in ("nation", "supplier", "customer", "orders"))
    none = lambda kind: F.lit(None).cast(kind)
    held = {name: t[name] for name in operational.SCHEMAS}
    held["club"] = nation.select(_text("c", n).alias("id"), F.col("n_name").alias("name"), F.lower("n_name").alias("slug"), none("string").alias("website"), F.lit("active").alias("vitality"))
    held["series"] = nation.select(_text("s", n).alias("id"), _text("c", n).alias("club_id"), _text("Series ", n).alias("name"), _text("series-", n % 20).alias("slug"))
    held["instance"] = nation.select(_text("i", n).alias("id"), _text("s", n).alias("series_id"), _text("Event ", n).alias("display_name"), (2000 + n % 2).cast("int").alias("season_year"), none("timestamp").alias("registration_open_at"))
    held["yacht"] = supplier.select(_text("y", s).alias("id"), _text("Boat ", s % 50).alias("name"), _text("boat-", s % 50).alias("yacht_slug"), _text(s % 8).alias("sail_number"), _text(s % 8).alias("sail_slug"), none("string").alias("yacht_type"), none("decimal(6,2)").alias("length_feet"))
    key = F.when(c % 4 == 0, _text("twin ", c % 100)).otherwise(_text("name ", c))
    held["participant"] = customer.select(_text("p", c).alias("id"), key.alias("full_name"), key.alias("normalized_full_name"), none("string").alias("first_name"), none("string").alias("last_name"))
    mail = F.when(c % 4 == 0, _text("twin", c % 100)).otherwise(_text("m", c))
    held["contact"] = customer.where(c % 8 != 0).select(_text("p", c).alias("participant_id"), F.lit("email").alias("contact_type"), F.lit("primary").alias("contact_subtype"), mail.alias("raw"), mail.alias("normalized"), F.lit(True).alias("is_primary"), F.lit("s").alias("source_system"))
    held["address"] = customer.where(c % 3 == 0).select(_text("p", c).alias("participant_id"), _text("Street ", c % 7).alias("address_raw"), F.lit("s").alias("source_system"))
    held["entry"] = orders.select(_text("e", o).alias("id"), _text("i", F.col("o_custkey") % 30).alias("instance_id"), _text("y", o % 9 + 1).alias("yacht_id"), F.lit("submitted").alias("entry_status"), F.lit("s").alias("registration_source"), _text("x", o).alias("registration_external_id"), none("timestamp").alias("registered_at"))
    held["crew"] = orders.select(_text("e", o).alias("entry_id"), _text("p", F.col("o_custkey")).alias("participant_id"), F.lit("skipper").alias("role"), F.lit("participating").alias("participation_state"), F.lit("s").alias("source_system"))
    return held


@query("""
with p as (select c_custkey as c, case when c_custkey % 4 = 0 then 'twin ' || c_custkey % 100 else 'name ' || c_custkey end as nm, case when c_custkey % 8 = 0 then null when c_custkey % 4 = 0 then 'twin' || c_custkey % 100 else 'm' || c_custkey end as mail from customer),
g as (select nm, max(mail) as best from p group by nm), f as (select nm, coalesce(mail, best) as mail from p join g using (nm)),
live as (select * from orders where o_custkey % 30 in (select n_nationkey from nation))
select 'club' as kind, count(distinct lower(n_name)) as candidates, count(*) as links from nation
union all select 'event', count(distinct (n_nationkey % 20, n_nationkey % 2)), count(*) from nation
union all select 'yacht', count(distinct (s_suppkey % 50, s_suppkey % 8)), count(*) from supplier
union all select 'participant', count(distinct (nm, coalesce(mail, ''))), (select count(*) from p) from f
union all select 'registration', count(*), count(*) from live
""")
def candidates_from_tables(spark, d):
    """Candidates of all kinds from operational tables, and their links; people without e-mail join the one of their name that has one."""
    b = candidates.Builder(spark, {})
    candidates.from_operational(b, _tables(spark, d))
    links = b.links.groupBy(F.col("entity_type").alias("kind")).agg(F.count("*").alias("links"))
    out = None
    for kind, df in b.kinds.items():
        one = df.agg(F.lit(kind).alias("kind"), F.count("*").alias("candidates"))
        out = one if out is None else out.unionByName(one)
    return out.join(links, "kind").select("kind", "candidates", "links")


@query("""
select 'base_clubs' as feed, case when s_suppkey % 40 >= 25 then 1 else 0 end as failed_hop, count(*) as n from supplier group by 2
union all select 'base_entries', case when s_suppkey % 40 >= 25 then 1 when s_suppkey % 3 = 0 then 2 else 0 end, count(*) from supplier group by 2
""")
def candidate_bridges(spark, d):
    """From raw rows through cross-references to candidates; the first hop that finds nothing is counted."""
    s, n = F.col("s_suppkey"), F.col("n_nationkey")
    t = _tables(spark, d)
    nation, supplier = read(spark, d, "nation"), read(spark, d, "supplier")
    x = lambda kind, key, to: nation.select(F.lit(kind).alias("kind"), F.lit("base_copy").alias("source_system"), _text(key, n).alias("source_id"), _text(to, n).alias("entity_id"), F.lit("").alias("last_seen"))
    t["xref"] = x("club", "k", "c").unionByName(x("event", "r", "i"))
    t["entry"] = supplier.where(s % 3 != 0).select(_text("e", s).alias("id"), _text("i", s % 40).alias("instance_id"), _text("y", s).alias("yacht_id"), F.lit("submitted").alias("entry_status"), F.lit("s").alias("registration_source"), _text("x", s).alias("registration_external_id"), F.lit(None).cast("timestamp").alias("registered_at"))
    t["crew"] = t["crew"].limit(0)
    b = candidates.Builder(spark, {})
    candidates.from_operational(b, t)
    clubs = candidates.bridge(b, "base_clubs", supplier.select(_text("h", s).alias("row_hash"), _text("k", s % 40).alias("source_id")), t, "base_copy")
    entries = candidates.bridge(b, "base_entries", supplier.select(_text("h", s).alias("row_hash"), _text("r", s % 40).alias("event_key"), _text("x", s).alias("external_id")), t, "base_copy")
    # the lookup of an entry's event is no hop of its own: it fails where no entry is found
    lost = F.when(F.col("failed_hop").isNull(), 0).otherwise(F.col("failed_hop"))
    odd = supplier.where(s % 40 >= 25).agg(F.count("*").alias("odd"))
    e = entries.join(odd, F.lit(True)).select("feed", lost.alias("failed_hop"), "n", "odd")
    split = e.where("failed_hop = 1").select("feed", F.inline(F.array(F.struct(F.lit(1).alias("failed_hop"), F.col("odd").alias("n")), F.struct(F.lit(2).alias("failed_hop"), (F.col("n") - F.col("odd")).alias("n")))))
    return clubs.select("feed", lost.alias("failed_hop"), "n").unionByName(e.where("failed_hop <> 1").drop("odd")).unionByName(split).where("n > 0")


@query("""
select c_custkey as seq, case c_custkey % 4 when 0 then 'invalid: merge_id not found' when 1 then 'applied' when 2 then 'invalid: merge_id not found' else 'invalid: keep_id not found' end as status from customer
where c_custkey - c_custkey % 4 in (select c_custkey from customer) and c_custkey - c_custkey % 4 + 1 in (select c_custkey from customer)
""")
def lifecycle_merge_checked(spark, d):
    """Unknown ids, valid merges, ids merged before and merges into what is gone, one after another."""
    k = F.col("c_custkey")
    base = read(spark, d, "customer")
    whole = base.select((k - k % 4).alias("q")).where(k % 4 == 1).distinct().join(base.select(k.alias("q")), "q")
    canon = base.select(_text(k).alias("id"))
    links = canon.select(F.col("id").alias("candidate_id"), F.col("id").alias("canonical_id"))
    first = k - k % 4
    keep = F.when(k % 4 == 3, first + 1).otherwise(first)
    gone = F.when(k % 4 == 0, "?").when(k % 4 == 1, _text(k)).when(k % 4 == 2, _text(k - 1)).otherwise(_text(k))
    rows = base.join(whole.select(F.col("q").alias("_q")), F.col("_q") == first, "left_semi").select(_text(keep).alias("keep_id"), gone.alias("merge_id"), k.alias("seq"))
    return lifecycle.checked_merges(rows, canon, links).select("seq", "status")
