"""Merges, cascades, scoring and the life cycle over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import expect, gates, latest, lifecycle, match, merge, scoring
from tidemark.queries import query, read

#: Candidates that the customer table stands for, in the SQL of both dialects.
_CANDIDATES = """
  select cast(c_custkey as varchar(20)) as id, case when c_custkey % 11 = 0 then null else concat('name ', cast(c_custkey % 400 as varchar(20))) end as normalized_name,
    case when c_custkey % 3 = 0 then null else concat('u', cast(c_custkey as varchar(20)), '@example.org') end as best_email, case when c_custkey % 4 = 0 then '' else concat('+1', cast(5550000000 + c_custkey as varchar(20))) end as best_phone,
    case when c_custkey % 5 = 0 then cast('1990-01-01' as date) end as date_of_birth, c_custkey % 9 = 0 as child_email, false as child_phone, c_custkey % 2 = 0 as child_address,
    c_custkey % 17 = 0 as is_promoted, case when c_custkey % 17 = 0 then 'auto_promote' when c_custkey % 2 = 0 then 'reject' else 'hold' end as resolution_state,
    cast(c_custkey % 1000 as bigint) as updated_at, cast(null as varchar(20)) as promoted_canonical_id
  from customer"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_CANDIDATES.replace("from customer", "from {customer}"), customer=read(spark, d, "customer"))


_MAIL, _TEL = "(coalesce(best_email, '') <> '' or child_email)", "(coalesce(best_phone, '') <> '' or child_phone)"
_SCORED = f"""
  raw as (select *, {_MAIL} as mail, {_TEL} as tel from ({_CANDIDATES}) c),
  weighed as (select *, (case when mail then 0.55 else 0 end + case when tel then 0.20 else 0 end + case when date_of_birth is not null then 0.15 else 0 end + case when normalized_name is not null then 0.10 else 0 end
    + case when child_address and not mail and not tel then 0.35 else 0 end)::decimal(6,4) as w from raw),
  fined as (select *, greatest(0, greatest(0, w - case when mail then 0 else 0.10 end) - case when tel then 0 else 0.05 end) as s0 from weighed),
  scored as (select *, least(1, s0)::decimal(5,4) as quality_score from fined),
  routed as (select *, case when quality_score >= 0.60 then 'auto_promote' when quality_score >= 0.50 then 'review' when quality_score >= 0.25 then 'hold' else 'reject' end as fresh,
    array_to_string(list_filter([case when mail then 'feature:email_exact:0.5500' end, case when tel then 'feature:phone_exact:0.2000' end, case when date_of_birth is not null then 'feature:dob_exact:0.1500' end,
      case when normalized_name is not null then 'feature:normalized_name_exact:0.1000' end, case when child_address and not mail and not tel then 'feature:address_present:0.3500' end,
      case when not mail then 'penalty:missing_email:0.1000' end, case when not tel then 'penalty:missing_phone:0.0500' end, case when child_email and coalesce(best_email, '') = '' then 'evidence:child_email' end], lambda x: x is not null), ';') as reasons from scored),
  final as (select * exclude (resolution_state), resolution_state as old_state, case when is_promoted then resolution_state else fresh end as resolution_state from routed)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.scored(_candidates(spark, d), "participant")


@query(f"with {_SCORED} select id, quality_score::double as quality_score, resolution_state, reasons, not is_promoted and old_state = 'reject' and fresh = 'auto_promote' as staged from final")
def score_participants(spark, d):
    return _scored(spark, d).select("id", F.col("quality_score").cast("double").alias("quality_score"), "resolution_state", F.array_join("confidence_reasons", ";").alias("reasons"), "staged")


@query("""
select p_partkey as id, s::double as quality_score, case when s >= 0.75 then 'auto_promote' when s >= 0.50 then 'review' when s >= 0.25 then 'hold' else 'reject' end as resolution_state from (
  select p_partkey, greatest(0, greatest(0, (sail::int * 0.5 + name::int * 0.3 + typ::int * 0.1 + len::int * 0.1)::decimal(6,4) - case when sail then 0 else 0.15 end) - case when name then 0 else 0.20 end)::decimal(5,4) as s from (
    select p_partkey, p_partkey % 2 = 0 as sail, p_partkey % 5 <> 0 as name, p_partkey % 3 <> 0 as typ, p_size % 4 <> 0 as len from part))
""")
def score_yachts(spark, d):
    k = F.col("p_partkey")
    rows = read(spark, d, "part").select(k.alias("id"), F.when(k % 2 == 0, "US 1").alias("normalized_sail_number"), F.when(k % 5 != 0, F.col("p_name")).otherwise("").alias("normalized_name"), F.when(k % 3 != 0, F.col("p_type")).alias("yacht_type"), (F.col("p_size") % 4).cast("decimal(6,2)").alias("length_feet"))
    return scoring.scored(rows, "yacht").select("id", F.col("quality_score").cast("double").alias("quality_score"), "resolution_state")


@query("""
select s_suppkey as id, s::double as quality_score, case when s >= 0.45 then 'auto_promote' when s >= 0.30 then 'review' when s >= 0.15 then 'hold' else 'reject' end as resolution_state from (
  select s_suppkey, greatest(0, ((s_suppkey % 7 <> 0)::int * 0.5 + (s_suppkey % 3 = 0)::int * 0.25 + (s_suppkey % 2 = 0)::int * 0.15 + (s_suppkey % 5 = 0)::int * 0.10)::decimal(6,4) - case when s_suppkey % 3 = 0 then 0 else 0.05 end)::decimal(5,4) as s from supplier)
""")
def score_clubs(spark, d):
    k = F.col("s_suppkey")
    rows = read(spark, d, "supplier").select(k.alias("id"), F.when(k % 7 != 0, F.col("s_name")).alias("normalized_name"), F.when(k % 3 == 0, "http://x").alias("website"), F.when(k % 2 == 0, "RI").alias("state_usa"), F.when(k % 5 == 0, "1").alias("phone"))
    return scoring.scored(rows, "club").select("id", F.col("quality_score").cast("double").alias("quality_score"), "resolution_state")


@query("""
select o_orderkey as id, s::double as quality_score, case when s >= 0.40 then 'auto_promote' when s >= 0.30 then 'review' when s >= 0.20 then 'hold' else 'reject' end as resolution_state from (
  select o_orderkey, greatest(0, greatest(0, (x::int * 0.4 + y::int * 0.25 + 0.25 + z::int * 0.1)::decimal(6,4) - case when x then 0 else 0.10 end) - case when y then 0 else 0.10 end)::decimal(5,4) as s from (
    select o_orderkey, o_orderkey % 3 = 0 as x, o_orderkey % 4 <> 0 as y, o_orderkey % 5 = 0 as z from orders))
""")
def score_events(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select(k.alias("id"), F.when(k % 3 == 0, "7").alias("event_external_id"), F.when(k % 4 != 0, F.year("o_orderdate")).alias("season_year"), F.lit("n").alias("normalized_event_name"), F.when(k % 5 == 0, F.col("o_orderdate")).alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    return scoring.scored(rows, "event").select("id", F.col("quality_score").cast("double").alias("quality_score"), "resolution_state")


@query("""
select l_orderkey as id, l_linenumber as line, s::double as quality_score, case when s >= 0.90 then 'auto_promote' when s >= 0.75 then 'review' when s >= 0.50 then 'hold' else 'reject' end as resolution_state from (
  select l_orderkey, l_linenumber, greatest(0, greatest(0, (x::int * 0.4 + 0.25 + y::int * 0.25 + z::int * 0.1)::decimal(6,4) - case when x then 0 else 0.10 end) - case when y then 0 else 0.10 end)::decimal(5,4) as s from (
    select l_orderkey, l_linenumber, l_orderkey % 3 = 0 as x, l_partkey % 4 <> 0 as y, l_suppkey % 5 = 0 as z from lineitem))
""")
def score_registrations(spark, d):
    rows = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.when(F.col("l_orderkey") % 3 == 0, "r").alias("registration_external_id"), F.lit("e").alias("candidate_event_id"),
        F.when(F.col("l_partkey") % 4 != 0, "y").alias("candidate_yacht_id"), F.when(F.col("l_suppkey") % 5 == 0, "p").alias("candidate_primary_participant_id"),
    )
    return scoring.scored(rows, "registration").select("id", "line", F.col("quality_score").cast("double").alias("quality_score"), "resolution_state")


@query(f"with {_SCORED} select 'participant' as entity_type, count(*) as n, min(quality_score)::double as min_score, quantile_cont(quality_score::double, 0.25) as p25, quantile_cont(quality_score::double, 0.5) as p50, quantile_cont(quality_score::double, 0.75) as p75, max(quality_score)::double as max_score from final")
def score_distribution(spark, d):
    return scoring.distribution(_scored(spark, d).withColumn("entity_type", F.lit("participant")))


@query(f"with {_SCORED} select 'participant' as entity_type, resolution_state, is_promoted, count(*) as n from final group by all")
def state_snapshot(spark, d):
    return scoring.state_counts(_scored(spark, d).withColumn("entity_type", F.lit("participant")))


@query(f"with {_SCORED} select 'participant' as entity_type, reason, count(*) as n from (select unnest(string_split(reasons, ';')) as reason from final where reasons <> '') group by reason order by n desc, reason limit 5")
def score_reasons_topk(spark, d):
    return scoring.top_reasons(_scored(spark, d).withColumn("entity_type", F.lit("participant")), 5)


@query(f"""with {_SCORED}, open as (select * from final where not is_promoted and resolution_state <> 'auto_promote')
select id as target_entity_id, 'missing_email_exact' as reason_code, 0.55::double as priority from open where not mail union all select id, 'missing_phone_exact', 0.20 from open where not tel
union all select id, 'missing_dob_exact', 0.15 from open where date_of_birth is null union all select id, 'missing_normalized_name_exact', 0.10 from open where normalized_name is null""")
def nba_missing_features(spark, d):
    return scoring.suggestions(_scored(spark, d), "participant").select("target_entity_id", "reason_code", F.col("priority").cast("double").alias("priority"))


@query(f"""with {_SCORED} select id, sha256('canonical_participant|' || id)[:32] as canonical_id, quality_score::double as canonical_confidence_score from final where resolution_state = 'auto_promote' and not is_promoted""")
def promotion(spark, d):
    out = lifecycle.promote("participant", _scored(spark, d), spark.createDataFrame([], "candidate_id string, canonical_id string"), ["best_email", "normalized_name"])
    made = out["links"].withColumnRenamed("candidate_id", "id").join(out["canonicals"].select(F.col("id").alias("canonical_id"), F.col("canonical_confidence_score").cast("double").alias("canonical_confidence_score")), "canonical_id")
    return made.select("id", "canonical_id", "canonical_confidence_score")


@query("""
with ev as (select distinct o_custkey % 100 as e from orders where o_custkey % 3 = 0)
select o_orderkey as id, 'C' || (o_custkey % 100)::varchar as canonical_event from orders where o_orderstatus = 'F' and o_custkey % 100 in (select e from ev)
""")
def promotion_with_dependencies(spark, d):
    orders = read(spark, d, "orders")
    links = orders.where("o_custkey % 3 = 0").select((F.col("o_custkey") % 100).cast("string").alias("candidate_id")).distinct().withColumn("canonical_id", F.concat(F.lit("C"), "candidate_id"))
    rows = orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "auto_promote").otherwise("hold").alias("resolution_state"), F.lit(False).alias("is_promoted"), F.lit(None).cast("string").alias("promoted_canonical_id"), F.lit(1).alias("quality_score"), (F.col("o_custkey") % 100).cast("string").alias("event_id"))
    out = lifecycle.promote("registration", rows, spark.createDataFrame([], "candidate_id long, canonical_id string"), ["event_id"], {"event_id": links})
    audit = out["audit"].select(F.col("candidate_id").alias("id"), "canonical_id")
    canon = out["canonicals"].select(F.col("id").alias("canonical_id"), F.col("canonical_event_id").alias("canonical_event"))
    return audit.join(canon, "canonical_id").select("id", "canonical_event")


@query("""
select id as canonical_id, a.attribute_name, a.attribute_value, id as source_candidate_id from (select c_custkey::varchar as id, c_name, c_mktsegment, c_custkey from customer) c,
  lateral (values ('display_name', c_name), ('normalized_name', lower(c_name)), ('best_email', case when c_custkey % 3 = 0 then null else c_mktsegment end)) a(attribute_name, attribute_value)
""")
def provenance_rows(spark, d):
    c = read(spark, d, "customer")
    canon = c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("display_name"), F.lower("c_name").alias("normalized_name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("best_email"))
    links = canon.select(F.col("id").alias("candidate_id"), F.col("id").alias("canonical_id"))
    return lifecycle.provenance("participant", canon, links, canon.select("id", F.lit(1).alias("quality_score")), "v1", "manual").select("canonical_id", "attribute_name", "attribute_value", "source_candidate_id")


@query(f"select 'participant' as entity_type, count(*) as candidates_total, count_if(is_promoted)::bigint as candidates_promoted, round(count_if(is_promoted) * 100.0 / count(*), 2)::double as pct_promoted, round(count_if(is_promoted) * 100.0 / count(*), 2) >= 90 as passed from ({_CANDIDATES}) c")
def lineage_coverage(spark, d):
    c = _candidates(spark, d)
    return lifecycle.coverage("participant", c, c.select("id")).select("entity_type", "candidates_total", "candidates_promoted", F.col("pct_promoted").cast("double").alias("pct_promoted"), "passed")


@query(f"select normalized_name, count(*) as n from ({_CANDIDATES}) c where normalized_name is not null group by 1 having bool_or(best_email is null) and bool_or(best_email is not null)")
def under_combination_groups(spark, d):
    return lifecycle.under_combined(_candidates(spark, d))


@query(f"""
with c as (select *, 0.5 as quality_score from ({_CANDIDATES}) c), g as (select normalized_name from c where normalized_name is not null group by 1 having bool_or(best_email is null) and bool_or(best_email is not null)),
r as (select *, first_value(id) over (partition by normalized_name order by best_email is not null desc, is_promoted desc, quality_score desc, updated_at desc, id) as winner_id from c where normalized_name in (select normalized_name from g))
select id as loser_id, winner_id from r where resolution_state = 'reject' and not is_promoted and best_email is null and id <> winner_id
""")
def remediation_winner_loser(spark, d):
    return lifecycle.remediation(_candidates(spark, d).withColumn("quality_score", F.lit(0.5)))


@query(f"""
with m as (select normalized_name, count(distinct id) as n, min(id) as k from ({_CANDIDATES}) c where best_email is not null and normalized_name is not null group by 1)
select c.id, case when best_email is null and n = 1 then k end as reuse_id, coalesce(best_email is null and n > 1, false) as ambiguous_name from ({_CANDIDATES}) c left join m using (normalized_name)
""")
def under_combination_prevention(spark, d):
    c = _candidates(spark, d)
    return lifecycle.prevented(c, c).select("id", "reuse_id", "ambiguous_name")


@query("""
with b as (select o_custkey as k, o_orderkey as seq, case when o_orderkey % 3 = 0 then o_orderstatus end as a, case when o_orderkey % 2 = 0 then o_orderpriority end as b from orders),
o as (select 2 * c_custkey as k, case when c_custkey % 2 = 0 then 'old' end as a, cast(null as varchar) as b from customer),
n as (select k, arg_min(a, seq) filter (a is not null) as a, arg_min(b, seq) filter (b is not null) as b from b group by k)
select coalesce(o.k, n.k) as k, coalesce(o.a, n.a) as a, coalesce(o.b, n.b) as b, o.k is null as inserted from o full join n on o.k = n.k
""")
def candidate_upsert_fill_null(spark, d):
    orders = read(spark, d, "orders")
    batch = orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("a"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("b"))
    old = read(spark, d, "customer").select((2 * F.col("c_custkey")).alias("k"), F.when(F.col("c_custkey") % 2 == 0, "old").alias("a"), F.lit(None).cast("string").alias("b"))
    return merge.fill_null_merge(old, batch, ["k"], ["a", "b"], "seq")


@query("""
select l_partkey, l_suppkey, min(l_orderkey) as l_orderkey from lineitem l where not exists (select 1 from lineitem o where o.l_linenumber = 1 and o.l_partkey = l.l_partkey and o.l_suppkey = l.l_suppkey) group by 1, 2
""")
def source_links_dedup(spark, d):
    rows = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    return merge.insert_absent(rows.where("l_linenumber = 1"), rows, ["l_partkey", "l_suppkey"], "l_orderkey").select("l_partkey", "l_suppkey", "l_orderkey")


@query("""
with a as (select user_id as k, min(ts) as t, arg_min(event_type, event_id) as v from events where event_id % 2 = 0 group by 1), b as (select user_id as k, max(ts) as t, arg_min(event_type, event_id) as v from events where event_id % 2 = 1 group by 1)
select coalesce(a.k, b.k) as user_id, coalesce(a.v, b.v) as event_type, strftime(greatest(coalesce(a.t, b.t), coalesce(b.t, a.t)), '%Y-%m-%d %H:%M:%S') as seen from a full join b on a.k = b.k
""")
def xref_refresh_last_seen(spark, d):
    e = read(spark, d, "events")
    part = lambda r, pick: e.where(f"event_id % 2 = {r}").groupBy("user_id").agg(pick("ts").alias("seen"), F.min_by("event_type", "event_id").alias("event_type"))
    return merge.refresh_seen(part(0, F.min), part(1, F.max), ["user_id"], "event_type", "seen").withColumn("seen", F.date_format("seen", "yyyy-MM-dd HH:mm:ss"))


@query("""
select user_id, strftime(day, '%Y-%m-%d') as day, event_id from (select *, row_number() over (partition by user_id order by day desc, is_new, event_id) as r from (select user_id, ts::date as day, event_id, (event_id % 2)::int as is_new from events)) where r = 1
""")
def document_status_if_newer(spark, d):
    e = read(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_id")
    one = lambda r: latest.latest_per_key(e.where(f"event_id % 2 = {r}"), ["user_id"], [F.desc("day"), F.asc("event_id")])
    return merge.replace_if_newer(one(0), one(1), ["user_id"], "day").withColumn("day", F.col("day").cast("string"))


@query("""
select l_orderkey, arg_min(st, rank * 100000000 + seq) as status, strftime(min(l_shipdate), '%Y-%m-%d') as at, arg_min(ext, seq) filter (ext is not null) as external_id from (
  select l_orderkey, l_linenumber * 1000000 + l_suppkey as seq, l_shipdate, case l_returnflag when 'A' then 'confirmed' when 'R' then 'submitted' else 'unknown' end as st, case l_returnflag when 'A' then 1 when 'R' then 2 else 3 end as rank, case when l_linenumber % 2 = 0 then l_suppkey end as ext from lineitem) group by 1
""")
def entry_status_precedence(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "A", "confirmed").when(F.col("l_returnflag") == "R", "submitted").otherwise("unknown").alias("status"), F.col("l_shipdate").alias("at"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).alias("external_id"), (F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("seq"))
    return merge.status_precedence(rows, ["l_orderkey"], "status", ["confirmed", "submitted"], "at", "external_id", "seq").withColumn("at", F.date_format("at", "yyyy-MM-dd"))


@query("""
select o_orderpriority as series, year(o_orderdate)::bigint as season, strftime(least(min(o_orderdate), timestamp '1996-06-01'), '%Y-%m-%d') as open_at, max(o_orderstatus) as display from orders group by 1, 2
""")
def event_context_earliest_open(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderpriority").alias("series"), F.year("o_orderdate").cast("long").alias("season"), F.col("o_orderdate").alias("at"), "o_orderstatus")
    per = o.groupBy("series", "season").agg(F.min("at").alias("at"), F.max("o_orderstatus").alias("display"))
    return per.select("series", "season", F.date_format(F.least("at", F.lit("1996-06-01").cast("timestamp_ntz")), "yyyy-MM-dd").alias("open_at"), "display")


@query("select distinct o_custkey from orders o where not exists (select 1 from orders p where p.o_custkey = o.o_custkey and p.o_orderstatus = 'O')")
def membership_open_row_anti(spark, d):
    o = read(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("end"))
    return merge.insert_unless_open(o, o.select("o_custkey"), ["o_custkey"], "end")


_BATCH = "select c_custkey as k, case when c_custkey % 2 = 0 then c_custkey % 150 end as email, case when c_custkey % 3 = 0 then c_custkey % 90 end as phone, c_nationkey as name from customer"
_KNOWN = "select s_suppkey as id, s_suppkey % 130 as email, s_suppkey % 60 as phone, s_nationkey % 20 as name from supplier"


@query(f"""
with b as ({_BATCH}), t as ({_KNOWN}), e as (select email, count(*) n, min(id) v from t group by 1), p as (select phone, count(*) n, min(id) v from t group by 1), m as (select name, min(id) v from t group by 1)
select k, case when e.n = 1 then e.v when e.n is null and p.n = 1 then p.v when e.n is null and p.n is null then m.v end as matched_id,
  case when e.n > 1 or (e.n is null and p.n > 1) then 'ambiguous' when e.n = 1 or p.n = 1 or m.v is not null then 'matched' else 'none' end as match_status,
  case when e.n >= 1 then 'email' when p.n >= 1 then 'phone' when m.v is not null then 'name' end as match_tier
from b left join e using (email) left join p using (phone) left join m using (name)
""")
def tiered_match(spark, d):
    b = spark.sql(_BATCH.replace("from customer", "from {t}"), t=read(spark, d, "customer"))
    t = spark.sql(_KNOWN.replace("from supplier", "from {t}"), t=read(spark, d, "supplier"))
    tiers = [match.Tier("email", ("email",), t.select("email", "id"), "id"), match.Tier("phone", ("phone",), t.select("phone", "id"), "id"), match.Tier("name", ("name",), t.select("name", "id"), "id", "least")]
    return match.tiered_match(b, tiers).select("k", "matched_id", "match_status", "match_tier")


@query(f"""
with b as (select *, case when k % 7 = 0 then null else 'n' || name end as nk, 'p' || (k % 3) as ph from ({_BATCH}) x), t as (select *, case when id % 5 = 0 then null else 'n' || name end as nk, 'p' || (id % 3) as ph from ({_KNOWN}) x),
e as (select email, count(*) n, min(id) v from t group by 1), m as (select nk, count(*) n, min(id) v from t where nk is not null group by 1),
j as (select b.*, coalesce(e.n, 0) as en, e.v as ev, x.nk as tn, x.ph as tp, m.n as mn, m.v as mv from b left join e using (email) left join t x on x.id = e.v left join m on m.nk = b.nk),
r as (select *, case when en > 1 then 'ambiguous_email_match' when en = 1 and (nk is null or tn is null) then 'missing_name_for_email_match' when en = 1 and nk <> tn then 'email_name_mismatch' when en = 1 and ph <> tp then 'email_phone_mismatch' when en = 0 and mn > 1 then 'ambiguous_name_match' end as reason_code from j)
select k, reason_code, case when reason_code is null then case when en = 1 then ev else mv end end as participant_id, coalesce(reason_code <> 'ambiguous_name_match', false) as quarantined from r
""")
def strict_identity_policy(spark, d):
    b = spark.sql(_BATCH.replace("from customer", "from {t}"), t=read(spark, d, "customer"))
    t = spark.sql(_KNOWN.replace("from supplier", "from {t}"), t=read(spark, d, "supplier"))
    b = b.select("k", "email", F.when(F.col("k") % 7 != 0, F.concat(F.lit("n"), "name")).alias("name_key"), F.concat(F.lit("p"), F.col("k") % 3).alias("phone"), F.lit(None).cast("string").alias("address"))
    people = t.select(F.col("id").alias("participant_id"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("n"), "name")).alias("name_key"), F.concat(F.lit("p"), F.col("id") % 3).alias("phone"), F.lit("1 Main").alias("address"))
    return match.strict_identity(b, people, t.select("email", F.col("id").alias("participant_id"))).select("k", "reason_code", "participant_id", "quarantined")


@query("""
with k as (select s_suppkey % 40 as leid, min(s_suppkey) as p from supplier group by 1)
select c_custkey, case when c_custkey % 2 = 0 or k.p is null then 'write' when k.p <> c_custkey % 100 then 'conflict' when c_custkey % 3 <> 0 then 'clear' else 'write' end as verdict from customer left join k on c_custkey % 2 = 1 and k.leid = c_custkey % 50
""")
def provider_id_verdicts(spark, d):
    known = read(spark, d, "supplier").groupBy((F.col("s_suppkey") % 40).alias("leid")).agg(F.min("s_suppkey").alias("participant_id")).withColumn("email", F.lit("e0"))
    k = F.col("c_custkey")
    b = read(spark, d, "customer").select("c_custkey", F.when(k % 2 == 1, k % 50).alias("leid"), (k % 100).alias("participant_id"), F.when(k % 3 == 0, "e0").otherwise("e1").alias("email"))
    return match.provider_ids(b, known, "leid").select("c_custkey", "verdict")


@query("""
with s as (select s_suppkey % 77 as sail, count(*) n, min(s_suppkey) v from supplier group by 1), m as (select s_nationkey as name, count(*) n, min(s_suppkey) v from supplier group by 1)
select c_custkey, coalesce(case when s.n = 1 then s.v end, case when m.n = 1 then m.v end) as linked_id, case when coalesce(case when s.n = 1 then s.v end, case when m.n = 1 then m.v end) is null then case when s.n > 1 then 'ambiguous_sail' when m.n > 1 then 'ambiguous_name' end end as link_warning
from customer left join s on s.sail = c_custkey % 90 left join m on m.name = c_nationkey
""")
def entry_unique_link(spark, d):
    left = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 90).alias("sail"), F.col("c_nationkey").alias("name"))
    right = read(spark, d, "supplier").select((F.col("s_suppkey") % 77).alias("sail"), F.col("s_nationkey").alias("name"), "s_suppkey")
    return match.unique_link(left, right, ["sail", "name"], "s_suppkey").select("c_custkey", "linked_id", "link_warning")


@query("""
select o_orderkey, case when o_totalprice < 50000 then 'too_small' when o_orderstatus = 'P' then 'pending:' || o_orderpriority when o_orderkey % 10 = 0 then 'tenth' end as reject_reason from orders
""")
def reject_reason_split(spark, d):
    rules = [(F.col("o_totalprice") < 50000, "too_small"), (F.col("o_orderstatus") == "P", F.concat(F.lit("pending:"), "o_orderpriority")), (F.col("o_orderkey") % 10 == 0, "tenth")]
    return gates.with_reason(read(spark, d, "orders"), rules).select("o_orderkey", "reject_reason")


@query("""
select o_orderkey, case when row_number() over (partition by o_custkey order by o_orderkey) > 1 then 'duplicate_key' end as reject_reason from orders
""")
def collision_first_wins(spark, d):
    return latest.first_wins(read(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey").select("o_orderkey", "reject_reason")


@query("select count(*) as rows_read, count_if(o_orderstatus = 'F')::bigint as filled, count_if(o_totalprice > 300000)::bigint as large from orders")
def run_counters(spark, d):
    return gates.counters(read(spark, d, "orders"), filled=F.col("o_orderstatus") == "F", large=F.col("o_totalprice") > 300000)


@query("select o_custkey, year(o_orderdate)::bigint as season, count(*) as n from orders group by all having count(*) > 1")
def unique_key_violations(spark, d):
    return expect.duplicates(read(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("season")), ["o_custkey", "season"])


@query(f"with {_SCORED} select id, old_state, fresh as new_state from final where old_state = 'reject' and fresh = 'auto_promote' and not is_promoted union all select id, old_state, fresh from final where is_promoted and old_state = 'auto_promote' and fresh <> 'auto_promote'")
def bad_state_transitions(spark, d):
    old = _candidates(spark, d)
    value, state, _ = scoring.score(scoring.SHIPPED["participant"], scoring.features("participant", old.columns))
    return expect.bad_transitions(old, old.withColumn("resolution_state", state)).select("id", "old_state", "new_state")


@query("select l_orderkey, l_linenumber from lineitem where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20)")
def foreign_key_orphans(spark, d):
    return expect.orphans(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", read(spark, d, "supplier").where("s_nationkey < 20"), "s_suppkey").select("l_orderkey", "l_linenumber")


@query("select c_custkey::varchar as old_id, (c_custkey - c_custkey % 8)::varchar as new_id from customer where c_custkey % 8 <> 0")
def merge_chain_closure(spark, d):
    """Chains of merges 8k+7 -> 8k+6 -> ... -> 8k, followed to their ends."""
    k = F.col("c_custkey")
    return merge.closed_map(read(spark, d, "customer").where("c_custkey % 8 <> 0").select(k.cast("string").alias("old_id"), (k - 1).cast("string").alias("new_id")))


@query("""
with m as (select c_custkey as id, c_custkey - 1 as keep from customer where c_custkey % 4 = 1), v as (select c_custkey as id, case when c_custkey % 3 = 0 then c_name end as a, case when c_custkey % 2 = 1 then c_mktsegment end as b from customer)
select v.id::varchar as id, coalesce(v.a, w.a) as a, coalesce(v.b, w.b) as b from v left join m on m.keep = v.id left join v w on w.id = m.id where v.id not in (select id from m)
""")
def lifecycle_merge(spark, d):
    k = F.col("c_custkey")
    canon = read(spark, d, "customer").select(k.cast("string").alias("id"), F.when(k % 3 == 0, F.col("c_name")).alias("a"), F.when(k % 2 == 1, F.col("c_mktsegment")).alias("b"))
    links = canon.select(F.col("id").alias("candidate_id"), F.col("id").alias("canonical_id"))
    decisions = read(spark, d, "customer").where("c_custkey % 4 = 1").select((k - 1).cast("string").alias("keep_id"), k.cast("string").alias("merge_id"), k.alias("seq"))
    people = canon.select("id", F.col("id").alias("promoted_canonical_id"))
    regs = canon.select(F.col("id").alias("canonical_primary_participant_id"))
    return lifecycle.merged("participant", canon, links, people, regs, decisions)["canonicals"]


@query("""
with l as (select c_custkey as candidate, c_custkey % 300 as canon from customer), g as (select candidate from l where candidate % 2 = 0)
select distinct canon::varchar as id from l where canon in (select canon from l where candidate not in (select candidate from g))
""")
def lifecycle_demote(spark, d):
    k = F.col("c_custkey")
    base = read(spark, d, "customer")
    links = base.select(k.cast("string").alias("candidate_id"), (k % 300).cast("string").alias("canonical_id"))
    cands = links.select(F.col("candidate_id").alias("id"), F.lit("auto_promote").alias("resolution_state"), F.lit(True).alias("is_promoted"), F.col("canonical_id").alias("promoted_canonical_id"))
    canon = links.select(F.col("canonical_id").alias("id")).distinct()
    gone = base.where("c_custkey % 2 = 0").select(k.cast("string").alias("candidate_id"))
    return lifecycle.detached("participant", canon, links, cands, canon.select(F.col("id").alias("canonical_primary_participant_id")), gone, delete=True)["canonicals"]


@query("""
select c_custkey::varchar as candidate_id, case when c_custkey % 5 = 0 then 'moved' else (c_custkey % 50)::varchar end as canonical from customer
""")
def lifecycle_split(spark, d):
    k = F.col("c_custkey")
    base = read(spark, d, "customer")
    links = base.select(k.cast("string").alias("candidate_id"), (k % 50).cast("string").alias("canonical_id"))
    canon = links.select(F.col("canonical_id").alias("id")).distinct()
    decisions = base.where("c_custkey % 5 = 0").select((k % 50).cast("string").alias("old_id"), k.cast("string").alias("candidate_id"))
    out = lifecycle.split("participant", canon, links, decisions)["links"]
    return out.select("candidate_id", F.when(F.length("canonical_id") == 32, "moved").otherwise(F.col("canonical_id")).alias("canonical"))


@query(f"""
select id as candidate_id, case when is_promoted then case id::bigint % 3 when 0 then 'skipped: already promoted' else 'invalid: promoted' end else 'applied' end as outcome,
  case when not is_promoted then case id::bigint % 3 when 0 then 'auto_promote' when 1 then 'reject' else 'hold' end end as new_state, not is_promoted and id::bigint % 3 = 0 and resolution_state = 'reject' as through_review from ({_CANDIDATES}) c
""")
def manual_decisions(spark, d):
    c = _candidates(spark, d)
    k = F.col("id").cast("long")
    last = c.select(F.col("id").alias("candidate_id"), F.when(k % 3 == 0, "promote").when(k % 3 == 1, "reject").otherwise("hold").alias("action"), F.lit(2).alias("seq"))
    first = c.select(F.col("id").alias("candidate_id"), F.lit("hold").alias("action"), F.lit(1).alias("seq"))
    return lifecycle.manual(c, first.unionByName(last)).select("candidate_id", "outcome", "new_state", "through_review")
