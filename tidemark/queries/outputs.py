"""Views, audience, readiness, enrichment and diagnostics over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.plans import audience, enrich, geo_ready, views
from tidemark.queries import query, read


@query("""
with e as (select o_custkey as p, o_orderpriority as s, year(o_orderdate) as y from orders), t as (select s, max(y) as y from e group by s)
select c_custkey as participant_id, c_name as full_name, e.s as event_series_id, lower(e.s) as event_series_name, e.s || '/' || t.y as current_event_instance_id, 'Season ' || t.y as current_event_display_name, t.y::bigint as current_season_year, max(e.y)::bigint as last_participated_year
from e join t on e.s = t.s and e.y < t.y join customer on c_custkey = e.p where not exists (select 1 from e n where n.p = e.p and n.s = e.s and n.y = t.y) group by all
""")
def returners_not_in_latest_season(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").cast("long").alias("y"), "o_orderdate")
    instance = F.concat_ws("/", "o_orderpriority", F.col("y").cast("string"))
    instances = orders.groupBy("o_orderpriority", "y").agg(F.min("o_orderdate").alias("registration_open_at")).select(instance.alias("id"), F.col("o_orderpriority").alias("event_series_id"), F.concat(F.lit("Season "), F.col("y").cast("string")).alias("display_name"), F.col("y").alias("season_year"), "registration_open_at")
    series = instances.select(F.col("event_series_id").alias("id"), F.lower("event_series_id").alias("name")).distinct()
    entries = orders.select(F.col("o_orderkey").alias("id"), instance.alias("event_instance_id"))
    crew = orders.select(F.col("o_orderkey").alias("event_entry_id"), F.col("o_custkey").alias("participant_id"))
    people = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"))
    return views.returners(people, series, instances, entries, crew)


@query("""
with ee as (select o_orderkey as id, year(o_orderdate) || '-' || (month(o_orderdate) - 1) // 3 as ev, o_custkey % 50 as yacht from orders),
eep as (select distinct l_orderkey as entry, l_suppkey as p, l_returnflag as role from lineitem),
dr as (select n_nationkey as id, (1992 + n_nationkey % 7) || '-' || n_nationkey % 4 as ev, n_nationkey % 3 as scope, case when n_nationkey % 4 = 0 then null else ['A', 'N', 'R'][n_nationkey % 3 + 1] end as role from nation where n_nationkey % 5 <> 0),
ds as (select event_id as id, user_id % 25 as req, case when event_id % 3 = 0 then event_id % 100 end as p, case when event_id % 3 <> 0 then event_id end as entry, case when event_type = 'purchase' or event_type = 'click' then 'received' else event_type end as status, ts from events),
lp as (select req, p, arg_max(status, (ts, id)) as status from ds where p is not null and entry is null group by all), le as (select req, entry, arg_max(status, (ts, id)) as status from ds where entry is not null and p is null group by all),
ly as (select req, yacht, arg_max(status, (ts, ds.id)) as status from ds join ee on ee.id = ds.entry group by all)
select distinct dr.id as document_requirement_id, eep.p as participant_id, null::bigint as event_entry_id, null::bigint as yacht_id, lp.status as latest_status from dr join ee on ee.ev = dr.ev join eep on eep.entry = ee.id left join lp on lp.req = dr.id and lp.p = eep.p
  where scope = 0 and (dr.role is null or dr.role = eep.role) and (lp.status is null or lp.status <> 'received')
union all select dr.id, null, ee.id, null, le.status from dr join ee on ee.ev = dr.ev left join le on le.req = dr.id and le.entry = ee.id where scope = 1 and (le.status is null or le.status <> 'received')
union all select distinct dr.id, null, null, ee.yacht, ly.status from dr join ee on ee.ev = dr.ev left join ly on ly.req = dr.id and ly.yacht = ee.yacht where scope = 2 and (ly.status is null or ly.status <> 'received')
""")
def missing_requirements_by_scope(spark, d):
    o = read(spark, d, "orders")
    event = F.concat_ws("-", F.year("o_orderdate").cast("string"), F.floor((F.month("o_orderdate") - 1) / 3).cast("string"))
    entries = o.select(F.col("o_orderkey").alias("id"), event.alias("event_instance_id"), (F.col("o_custkey") % 50).alias("yacht_id"))
    crew = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_entry_id"), F.col("l_suppkey").alias("participant_id"), F.col("l_returnflag").alias("role"))
    k = F.col("n_nationkey")
    roles = F.array(*[F.lit(x) for x in "ANR"])
    needs = read(spark, d, "nation").select(
        k.alias("id"), F.concat_ws("-", (1992 + k % 7).cast("string"), (k % 4).cast("string")).alias("event_instance_id"), (k % 3).alias("document_type_id"), F.when(k % 4 != 0, F.get(roles, k % 3)).alias("required_for_role"),
        (k % 5 != 0).alias("is_mandatory"), F.lit(None).cast("timestamp").alias("due_at"),
    )
    types = spark.createDataFrame([(0, "waiver", "participant"), (1, "entry form", "entry"), (2, "rating", "yacht")], "id int, name string, scope string")
    instances = needs.select(F.col("event_instance_id").alias("id"), F.lit("e").alias("display_name"), F.lit(1).alias("season_year")).distinct()
    i = F.col("event_id")
    statuses = read(spark, d, "events").select(
        i.alias("id"), (F.col("user_id") % 25).cast("int").alias("document_requirement_id"), F.when(i % 3 == 0, i % 100).alias("participant_id"), F.when(i % 3 != 0, i).alias("event_entry_id"),
        F.when(F.col("event_type").isin("purchase", "click"), "received").otherwise(F.col("event_type")).alias("status"), F.col("ts").alias("status_at"),
    )
    return views.missing_documents(needs, types, instances, entries, crew, statuses).select("document_requirement_id", "participant_id", "event_entry_id", "yacht_id", "latest_status")


@query("select c_custkey as match_id, c_custkey as left_entity_id, c_custkey + 1 as right_entity_id from customer where c_mktsegment = 'BUILDING'")
def review_queue(spark, d):
    rows = read(spark, d, "customer").select(F.col("c_custkey").alias("match_id"), F.col("c_custkey").alias("left_entity_id"), (F.col("c_custkey") + 1).alias("right_entity_id"), F.when(F.col("c_mktsegment") == "BUILDING", "review").otherwise("match").alias("decision"))
    return views.review_queue(rows)


@query("""
select o_orderkey, date_diff('year', b, date '2012-02-28') - (strftime(date '2012-02-28', '%m%d') < strftime(b, '%m%d'))::int as age_years, date_diff('year', b, date '2012-02-28') - (strftime(date '2012-02-28', '%m%d') < strftime(b, '%m%d'))::int < 18 as is_minor
from (select o_orderkey, case when o_orderkey % 9 <> 0 then o_orderdate::date end as b from orders)
""")
def enriched_age_minor(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate").cast("date")).alias("date_of_birth"))
    return views.enriched(rows, F.lit("2012-02-28").cast("date")).select("o_orderkey", F.col("age_years").cast("long").alias("age_years"), "is_minor")


_STATE = "case event_type when 'error' then 'unsubscribed' when 'signup' then 'cleaned' else 'subscribed' end"


def _states(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "unsubscribed").when(F.col("event_type") == "signup", "cleaned").otherwise("subscribed")
    return read(spark, d, "events").select(F.concat(F.lit("u"), (F.col("user_id") % 120).cast("string"), F.lit("@x.org")).alias("email"), status.alias("audience_status"), F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp")).alias("status_at"), F.col("event_id").alias("ingest_seq"))


@query(f"select distinct on (email) email, audience_status, ingest_seq from (select 'u' || user_id % 120 || '@x.org' as email, {_STATE} as audience_status, event_id as ingest_seq, case when event_id % 10 <> 0 then ts end as st from events) order by email, st desc nulls last, ingest_seq desc")
def latest_status_per_email(spark, d):
    return latest_per_key(_states(spark, d), ["email"], [F.desc_nulls_last("status_at"), F.desc("ingest_seq")]).select("email", "audience_status", "ingest_seq")


_SUPPRESSED = f"select email, audience_status as suppression_reason from (select distinct on (email) email, audience_status from (select 'u' || user_id % 120 || '@x.org' as email, {_STATE} as audience_status, event_id as seq, case when event_id % 10 <> 0 then ts end as st from events) order by email, st desc nulls last, seq desc) where audience_status <> 'subscribed'"


@query(_SUPPRESSED)
def suppression_map(spark, d):
    return audience.suppression(_states(spark, d))


_PEOPLE = "select c_custkey as id, case when c_custkey % 7 <> 0 then 'u' || (c_custkey % 200) || '@x.org' end as best_email, c_name as display_name, (c_custkey % 10) / 10.0 as score, case when c_custkey % 13 <> 0 then date '2020-01-01' + (c_custkey % 900)::int end as updated from customer"
_REGS = "select o_custkey as pid, l_partkey as ev, l_suppkey as yacht from lineitem join orders on o_orderkey = l_orderkey"
_EVENTS = "select p_partkey as id, p_name as event_name, date '2001-06-01' + (p_partkey % 120)::int - 60 as start_date, 1997 + p_partkey % 6 as season from part"
_SEGMENTS = f"""
  people as ({_PEOPLE}), regs as ({_REGS}), ev as ({_EVENTS}), soon as (select * from ev where start_date between date '2001-06-01' and date '2001-06-11'),
  a as (select people.id as participant_id, best_email as email, display_name, score, updated, count(distinct regs.ev) as upcoming, (select count(*) from regs r where r.pid = people.id) as historical, max(s_name) as yacht_name, max(event_name) as last_event
    from people join regs on regs.pid = people.id join soon on soon.id = regs.ev left join supplier on s_suppkey = regs.yacht where best_email is not null group by all),
  b as (select people.id as participant_id, best_email as email, display_name, score, updated, 0 as upcoming, count(*) as historical, max(event_name) as last_event
    from people join regs on regs.pid = people.id join ev on ev.id = regs.ev where best_email is not null and start_date < date '2001-06-01' and season between 1998 and 2001 and people.id not in (select pid from regs join soon on soon.id = regs.ev) group by all)"""


def _audience_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    k = F.col("c_custkey")
    people = read(spark, d, "customer").select(
        k.alias("id"), F.when(k % 7 != 0, F.concat(F.lit("u"), (k % 200).cast("string"), F.lit("@x.org"))).alias("best_email"), F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name"),
        F.col("c_name").alias("display_name"), ((k % 10) / 10.0).alias("canonical_confidence_score"), F.when(k % 13 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int")).cast("timestamp")).alias("updated_at"),
    )
    lines = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    regs = lines.select(F.col("o_custkey").alias("participant_id"), F.col("l_partkey").alias("event_id"), F.col("l_suppkey").alias("yacht_id"))
    p = F.col("p_partkey")
    events = read(spark, d, "part").select(p.alias("id"), F.col("p_name").alias("event_name"), F.date_add(F.lit("2001-06-01").cast("date"), (p % 120 - 60).cast("int")).alias("start_date"), (1997 + p % 6).alias("season_year"))
    yachts = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return people, regs, events, yachts


def _segments(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    people, regs, events, yachts = _audience_inputs(spark, d)
    today = F.lit("2001-06-01").cast("date")
    return audience.upcoming_registrants(people, regs, events, yachts, today, 10), audience.likely_registrants(people, regs, events, today, 10)


@query(f"with {_SEGMENTS} select participant_id, email, upcoming as upcoming_event_count, historical as historical_registration_count, yacht_name, last_event as last_registered_event_name from a")
def segment_upcoming(spark, d):
    return _segments(spark, d)[0].select("participant_id", "email", "upcoming_event_count", "historical_registration_count", "yacht_name", "last_registered_event_name")


@query(f"with {_SEGMENTS} select participant_id, email, historical as historical_registration_count, last_event as last_registered_event_name from b")
def segment_likely(spark, d):
    return _segments(spark, d)[1].select("participant_id", "email", "historical_registration_count", "last_registered_event_name")


_RANKED = f"""with {_SEGMENTS}, u as (select participant_id, email, score, updated, 'upcoming_registrants' as seg, upcoming, historical from a union all select participant_id, email, score, updated, 'likely_registrants', upcoming, historical from b),
  r as (select *, row_number() over (partition by email order by score desc, coalesce(updated, date '1970-01-01') desc, participant_id) as rn from u),
  w as (select email, arg_min(participant_id, rn) as participant_id, string_agg(participant_id::varchar, ',' order by rn) as contributing, string_agg(distinct seg, ',' order by seg) as segments, count(*) as n from r group by email)"""


@query(f"{_RANKED} select w.email, participant_id, contributing, segments, suppression_reason, suppression_reason is not null as is_suppressed from w left join ({_SUPPRESSED}) s on s.email = w.email")
def activation_winners(spark, d):
    rows = audience.activated(audience.merged_segments(*_segments(spark, d)), audience.suppression(_states(spark, d)))
    return rows.select("email", "participant_id", F.array_join(F.transform("contributing_participant_ids", lambda x: x.cast("string")), ",").alias("contributing"), F.array_join("segment_types", ",").alias("segments"), "suppression_reason", "is_suppressed")


@query(f"{_RANKED} select w.email, w.segments as segment_types, w.contributing as contributing_participant_ids, '' as club_name from w left join ({_SUPPRESSED}) s on s.email = w.email where suppression_reason is null")
def audience_export(spark, d):
    rows = audience.activated(audience.merged_segments(*_segments(spark, d)), audience.suppression(_states(spark, d)))
    rows = rows.withColumn("contributing_participant_ids", F.transform("contributing_participant_ids", lambda x: x.cast("string")))
    return audience.export(rows, "2001-06-01").select("email", "segment_types", "contributing_participant_ids", "club_name")


@query("""
with c as (select c_custkey as id, case when c_custkey % 10 = 0 then 'm@x.org' end as mail, case when c_custkey % 8 <> 0 then 'n' end as nm from customer where c_custkey % 3 <> 0 and c_custkey % 9 <> 8),
a as (select c_custkey as id, 0 as seq, case c_custkey % 6 when 0 then 'Newport, RI, USA' when 1 then 'Paris France' when 2 then 'USA' when 3 then 'Sea Marina' when 4 then 'Boston MA' else 'Bristol RI US' end as k, c_custkey % 6 as h from customer
  union all select c_custkey, 1, 'Newport RI USA', 0 from customer where c_custkey % 6 in (0, 3) union all select c_custkey, 1, 'Troy NY USA', 9 from customer where c_custkey % 6 = 5),
g as (select id, list(distinct h) as hs from a group by id)
select c.id as candidate_id, case when mail is not null then 'already_has_contact' when 5 in hs and 9 in hs then 'multi_location_conflict' when not (0 in hs or 1 in hs or 5 in hs) and hs = [3] then 'junk_location' when not (0 in hs or 1 in hs or 5 in hs) then 'too_vague' when nm is null then 'too_vague' else 'enrichment_ready' end as readiness_status,
  case when 5 in hs and 9 in hs then null when 0 in hs then 'Newport' when 1 in hs then 'Paris' end as best_city
from c join g using (id)
""")
def geo_readiness(spark, d):
    k = F.col("c_custkey")
    base = read(spark, d, "customer")
    cands = base.select(
        k.alias("id"), F.when(k % 10 == 0, "m@x.org").alias("best_email"), F.lit(None).cast("string").alias("best_phone"), F.when(k % 8 != 0, "n").alias("normalized_name"), F.when(k % 3 == 0, "review").otherwise("hold").alias("resolution_state"), (k % 9 == 8).alias("is_promoted")
    )
    h = k % 6
    first = F.when(h == 0, "Newport, RI, USA").when(h == 1, "Paris France").when(h == 2, "USA").when(h == 3, "Sea Marina").when(h == 4, "Boston MA").otherwise("Bristol RI US")
    more = F.when(h.isin(0, 3), "Newport RI USA").when(h == 5, "Troy NY USA")
    addresses = base.select(k.alias("candidate_id"), first.alias("address_raw"), F.lit(0).alias("seq")).union(base.select(k, more, F.lit(1)))
    contacts = spark.createDataFrame([], "candidate_id long, contact_type string, normalized_value string")
    return geo_ready.readiness(cands, contacts, addresses).select("candidate_id", "readiness_status", "best_city")


@query("""
select c_custkey as id from customer where c_custkey % 5 <> 0 and c_custkey not in (select user_id from events where ts > timestamp '2024-01-15' - interval 10 day and event_type <> 'error') order by c_acctbal desc, c_custkey limit 25
""")
def enrichment_topk_cooldown(spark, d):
    k = F.col("c_custkey")
    cands = read(spark, d, "customer").select(k.alias("id"), F.when(k % 5 == 0, "review").otherwise("hold").alias("resolution_state"), F.lit(False).alias("is_promoted"), F.lit(None).cast("string").alias("best_email"), F.lit(None).cast("string").alias("best_phone"), F.col("c_acctbal").alias("quality_score"), F.lit(None).cast("timestamp").alias("updated_at"))
    looked = read(spark, d, "events").select(F.col("user_id").alias("candidate_id"), F.col("ts").cast("timestamp").alias("created_at"), F.when(F.col("event_type") == "error", "api_error").otherwise("no_match").alias("row_status"))
    return enrich.chosen(cands, looked, F.lit("2024-01-15").cast("date"), missing="either", cooldown=10, limit=25).select("id")


@query("""
select s_suppkey as id, case when s_suppkey % 6 = 0 then 'api_error' when s_suppkey % 4 = 0 then 'no_match' when s_suppkey % 4 = 3 then 'ambiguous' when s_suppkey % 100 < 50 then 'low_confidence' when s_suppkey % 5 = 0 then 'identity_conflict' else 'applied' end as verdict from supplier
""")
def enrichment_gates(spark, d):
    k = F.col("s_suppkey")
    base = read(spark, d, "supplier")
    cands = base.select(k.alias("id"), F.when(k % 5 == 0, "old@x.org").alias("best_email"), F.lit(None).cast("string").alias("best_phone"), F.lit("n").alias("normalized_name"))
    answers = base.select(
        k.alias("candidate_id"), F.when(k % 6 == 0, "api_error").otherwise("matched").alias("row_status"), F.lit("p").alias("provider_person_id"), F.lit("N").alias("name"), F.array(F.lit(" New@X.org")).alias("emails"), F.array(F.lit("555 123 4567")).alias("phones"),
        F.lit(None).cast("string").alias("linkedin_url"), (k % 100).cast("int").alias("confidence"), F.when(k % 4 == 0, 0).when(k % 4 == 3, 2).otherwise(1).alias("n_profiles"),
    )
    return enrich.gated(cands, answers).select("id", "verdict")
