"""Column functions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, keys, places, text, urls
from tidemark.queries import query, read
from tidemark.sources.pages import profile


@query("""
select s_suppkey, lower(trim(raw)) as email, '+1555' || lpad((s_suppkey % 10000)::varchar, 4, '0') || '000' as phone,
  trim(regexp_replace(regexp_replace(lower(strip_accents(nm)), '[^a-z0-9_ ]', '', 'g'), ' +', ' ', 'g')) as person_key,
  nullif(trim(regexp_replace(lower(strip_accents(nm)), '[^a-z0-9]+', '-', 'g'), '-'), '') as slug,
  trim(regexp_replace(nm, ' +', ' ', 'g')) as squeezed,
  position('@' in trim(raw)) > 1 and position('@' in trim(raw)) < length(trim(raw)) and regexp_matches(trim(raw), '^[^@]+@.*\\.') as email_ok
from (select s_suppkey, '  ' || upper(s_name) || case when s_suppkey % 2 = 0 then '@Example.ORG ' else '.x@org ' end as raw, ' Éva ' || s_name || '  Núñez-O''Hara,  & Co. ' as nm from supplier)
""")
def normalize_contacts(spark, d):
    raw = F.concat(F.lit("  "), F.upper("s_name"), F.when(F.col("s_suppkey") % 2 == 0, "@Example.ORG ").otherwise(".x@org "))
    name = F.concat(F.lit(" Éva "), "s_name", F.lit("  Núñez-O'Hara,  & Co. "))
    phone = F.concat(F.lit("(555) "), F.lpad((F.col("s_suppkey") % 10000).cast("string"), 4, "0"), F.lit("-000"))
    return read(spark, d, "supplier").select(
        "s_suppkey", text.email(raw).alias("email"), text.phone(phone).alias("phone"), text.person_key(name).alias("person_key"), text.slug(name).alias("slug"), text.squeezed(name).alias("squeezed"), text.email_ok(text.trimmed(raw)).alias("email_ok")
    )


@query("""
with n as (select c_custkey, case c_custkey % 4 when 0 then 'Lee, ' || split_part(c_name, '#', 1) || ' Q' when 1 then split_part(c_name, '#', 1) when 2 then '  ' else 'Ann  Q ' || split_part(c_name, '#', 1) end as nm from customer),
s as (select *, trim(regexp_replace(nm, ' +', ' ', 'g')) as v from n)
select c_custkey,
  case when v = '' then null when contains(v, ',') then trim(v[position(',' in v) + 1:]) when not contains(v, ' ') then v else regexp_replace(v, ' [^ ]*$', '') end as first_name,
  case when v = '' then null when contains(v, ',') then trim(v[:position(',' in v) - 1]) when not contains(v, ' ') then null else regexp_extract(v, '([^ ]*)$', 1) end as last_name
from s
""")
def name_parts(spark, d):
    base = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat(F.lit("Lee, "), base, F.lit(" Q"))).when(k == 1, base).when(k == 2, "  ").otherwise(F.concat(F.lit("Ann  Q "), base))
    p = text.name_parts(name)
    return read(spark, d, "customer").select("c_custkey", p["first"].alias("first_name"), p["last"].alias("last_name"))


@query("""
with n as (select s_suppkey, 'Ann Lee' as owner, case s_suppkey % 3 when 0 then 'ann lee & Bob ' || s_suppkey when 1 then 'Bob ' || s_suppkey || ' and Cy Dee AND bob ' || s_suppkey else null end as nm from supplier)
select s_suppkey, 0 as pos, owner as full_name, 'owner' as role from n
union all select s_suppkey, 1, 'Bob ' || s_suppkey, 'co_owner' from n where s_suppkey % 3 < 2
union all select s_suppkey, 2, 'Cy Dee', 'co_owner' from n where s_suppkey % 3 = 1
""")
def co_owners(spark, d):
    k, bob = F.col("s_suppkey") % 3, F.concat(F.lit("Bob "), F.col("s_suppkey").cast("string"))
    names = F.when(k == 0, F.concat(F.lit("ann lee & "), bob)).when(k == 1, F.concat(bob, F.lit(" and Cy Dee AND bob "), F.col("s_suppkey").cast("string")))
    rows = read(spark, d, "supplier").select("s_suppkey", F.posexplode(text.owners(F.lit("Ann Lee"), names)).alias("pos", "o"))
    return rows.select("s_suppkey", "pos", "o.full_name", "o.role")


@query("""
select page_id, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') as page, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') as ref, nullif(regexp_extract(url, '/en/(\\d+)', 1), '') as en_number,
  case when regexp_matches(url, '[?&]page=\\d+') and regexp_matches(url, '[?&]ref=[^&#]') then 'https://h.example/e?race_id=' || regexp_extract(url, '[?&]ref=([^&#]+)', 1) || '&yr=' || regexp_extract(url, '[?&]page=(\\d+)', 1) end as canonical
from pages
""")
def url_parameters(spark, d):
    renamed = F.replace(F.replace(F.col("url"), F.lit("page="), F.lit("yr=")), F.lit("ref="), F.lit("race_id="))
    return read(spark, d, "pages").select(
        "page_id", urls.parameter(F.col("url"), "page").alias("page"), urls.parameter(F.col("url"), "ref").alias("ref"), urls.number_after(F.col("url"), "en").alias("en_number"), urls.entries_url(renamed, "https://h.example/e").alias("canonical")
    )


@query("""
select c_custkey, sha256(lower(c_name) || '|' || coalesce(case when c_custkey % 3 = 0 then null else c_mktsegment end, '')) as fingerprint, sha256(c_name || '|' || c_nationkey || '|')[:32] as entry_hash, md5(lower(c_name)) as subscriber,
  'n:' || trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') || ':s:' || lower(c_mktsegment) as yacht_key, 'race:' || c_custkey || ':yr:' || c_nationkey as race_key
from customer
""")
def fingerprints(spark, d):
    seg = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return read(spark, d, "customer").select(
        "c_custkey", keys.fingerprint(F.lower("c_name"), seg).alias("fingerprint"), keys.entry_hash(F.col("c_name"), F.col("c_nationkey"), F.lit(None)).alias("entry_hash"), keys.subscriber_hash(F.col("c_name")).alias("subscriber"),
        keys.yacht_key(F.col("c_name"), F.col("c_mktsegment")).alias("yacht_key"), keys.race_key(F.col("c_custkey").cast("string"), F.col("c_nationkey")).alias("race_key"),
    )


@query("""
select o_orderkey, case when o_orderkey % 5 = 0 then null else strftime(o_orderdate, '%Y-%m-%d ') || (o_orderkey % 24)::varchar || ':05:09' end as at,
  case when o_orderkey % 3 = 0 then null else strftime(o_orderdate, '%Y-%m-%d') end as day, year(o_orderdate) + 10 as tag_year, (date '2018-02-28' >= o_orderdate::date)::int as born_before,
  date_diff('year', o_orderdate::date, date '2010-03-01') - (strftime(date '2010-03-01', '%m%d') < strftime(o_orderdate, '%m%d'))::int as age_years
from orders
""")
def parsed_dates(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    stamp = F.when(k % 5 == 0, "0000-00-00 00:00:00").otherwise(F.concat(F.date_format(day, "yyyy-M-d "), (k % 24).cast("string"), F.lit(":5:9")))
    at = dates.timestamp(stamp)
    shown = F.concat(F.date_format(at, "yyyy-MM-dd "), F.hour(at).cast("string"), F.date_format(at, ":mm:ss"))
    text_day = F.when(k % 3 == 0, "not a day").otherwise(F.date_format(day, "MMM d, yyyy"))
    return read(spark, d, "orders").select(
        "o_orderkey", shown.alias("at"), dates.day(text_day).cast("string").alias("day"), dates.tag_year(F.concat(F.lit("tag_"), (F.year(day) + 10).cast("string"))).cast("long").alias("tag_year"),
        (day <= F.lit("2018-02-28").cast("date")).cast("int").alias("born_before"), dates.age(day, F.lit("2010-03-01").cast("date")).cast("long").alias("age_years"),
    )


@query("""
select event_id, json_extract_string(props, '$.ref') as ref, coalesce(nullif(json_extract_string(props, '$.missing'), ''), json_extract_string(props, '$.ref'), event_type) as either
from events
""")
def json_fallback(spark, d):
    get = lambda k: F.get_json_object("props", f"$.{k}")
    return read(spark, d, "events").select("event_id", get("ref").alias("ref"), F.coalesce(F.nullif(get("missing"), F.lit("")), get("ref"), F.col("event_type")).alias("either"))




@query("""
with p as (select s_suppkey, s_suppkey % 9 as k, 'Port' || s_suppkey as c from supplier)
select s_suppkey, case when k in (0, 1, 2, 8) then c end as city, case k when 0 then 'RI' when 1 then 'NY' when 3 then 'RI' when 8 then 'MA' end as state_region,
  case k when 0 then 'USA' when 2 then 'FRA' when 3 then 'USA' when 4 then 'USA' end as country_code,
  case k when 0 then 'city_state_country' when 1 then 'freeform_partial' when 2 then 'city_country' when 3 then 'state_country' when 4 then 'country_only' when 5 then 'non_address_junk' when 6 then 'non_address_junk' when 7 then 'empty_or_null' else 'freeform_partial' end as quality_class,
  case k when 0 then c || ' RI USA' when 1 then c || ' NY' when 2 then c || ' FRA' when 3 then 'RI USA' when 4 then 'USA' when 8 then c || ' MA' end as normalized_hint
from p
""")
def geo_hints(spark, d):
    k, c = F.col("s_suppkey") % 9, F.concat(F.lit("port"), F.col("s_suppkey").cast("string"))
    raw = F.when(k == 0, F.concat(c, F.lit(", RI, USA"))).when(k == 1, F.concat(c, F.lit("  New York"))).when(k == 2, F.concat(c, F.lit(", France"))).when(k == 3, "rhode island us").when(k == 4, "USA").when(k == 5, "Happy Yacht Club").when(k == 6, "J/24").when(k == 7, "").otherwise(F.concat(c, F.lit(" MA")))
    return read(spark, d, "supplier").withColumn("h", places.hint(raw)).select("s_suppkey", "h.city", "h.state_region", "h.country_code", "h.quality_class", "h.normalized_hint")


@query("""
select p_partkey, unnest(['a, ' || t, t]) as tag from (select p_partkey, unnest(string_split(p_name, ' ')) as t from part) where t <> ''
""")
def tags_exploded(spark, d):
    quoted = F.transform(F.split("p_name", " "), lambda t: F.concat(F.lit('"a, '), t, F.lit('" , '), t))
    return read(spark, d, "part").select("p_partkey", F.explode(text.tags(F.array_join(quoted, ","))).alias("tag"))


@query()
def profile_pages(spark, d):
    """Label-value fields of every raw page; pages without such tables have none."""
    rows = read(spark, d, "pages").select("page_id", profile(F.col("html")).alias("p"))
    return rows.select("page_id", F.size("p.fields").alias("n_fields"), F.size("p.household").alias("n_household"), "p.display_name")


@query("""
select s_suppkey, array_to_string(list_transform(string_split(lower(s_name), '#'), lambda x: upper(x[1]) || x[2:]), '#') as titled, trim(s_name) || ' | ' || s_nationkey as address, try_cast(s_nationkey::varchar as int) as rating
from supplier
""")
def titles_and_addresses(spark, d):
    return read(spark, d, "supplier").select("s_suppkey", text.titled(F.col("s_name")).alias("titled"), text.joined_address(F.col("s_name"), F.lit(" "), F.col("s_nationkey").cast("string")).alias("address"), text.whole_number(F.concat(F.lit(" "), F.col("s_nationkey").cast("string"))).alias("rating"))
