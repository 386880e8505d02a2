"""Column functions, integrity rules and diagnostics that no other query goes through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import dates, keys, places, text, urls
from tidemark.operators import expect, gates, scoring
from tidemark.plans import enrich, ingest
from tidemark.queries import query, read
from tidemark.sources import feeds, pages


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("""
select p_partkey, case when p_partkey % 3 = 0 then null else round(p_retailprice, 2)::decimal(18,4)::double end as price, ['a' || p_partkey, 'b'] as papers, case when p_partkey % 2 = 0 then 'Ann ' || p_partkey else p_partkey::varchar end as full_name, p_partkey % 4 <> 1 as same,
  case when p_partkey % 5 = 0 then null else p_size::bigint end as rating from part
""")
def numbers_and_lists(spark, d):
    k = F.col("p_partkey")
    number = F.when(k % 3 == 0, "n/a").otherwise(_text(" ", F.round("p_retailprice", 2), " "))
    return read(spark, d, "part").select(
        "p_partkey", text.decimal(number).cast("double").alias("price"), text.lines(_text("a", k, "\r\n\n  b \n")).alias("papers"), text.full_name(F.when(k % 2 == 0, " Ann "), k.cast("string")).alias("full_name"),
        text.same_address(_text("1  Main ", k), F.when(k % 4 == 1, "2 Main").otherwise(_text("1 MAIN  ", k, " "))).alias("same"), text.whole_number(F.when(k % 5 == 0, "4.5 stars").otherwise(_text(F.col("p_size"), " "))).cast("long").alias("rating"),
    )


@query("""
select o_orderkey, case when o_orderkey % 4 = 0 then null else 'r ' || o_custkey end as race_id, case when o_orderkey % 5 = 0 then null else 2025::bigint end as yr, case when o_orderkey % 3 = 0 then null else o_orderkey::varchar end as sku,
  case when o_orderkey % 2 = 0 then o_custkey::varchar end as event_id, case when o_orderkey % 2 = 0 then o_orderkey::varchar end as entry_id, case when o_orderkey % 2 = 0 then 'https://h/card.vcard?id=' || o_orderkey else 'made-' || o_orderkey end as card from orders
""")
def url_ids(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    url = F.concat(F.lit("https://h/s?a=1&race_id="), F.when(k % 4 == 0, "").otherwise(_text("r%20", c)), F.lit("&yr="), F.when(k % 5 == 0, "soon").otherwise("2025"), F.lit("#top"))
    pair = urls.number_pair_after(F.when(k % 2 == 0, _text("https://y/boatdetail/", c, "/", k)).otherwise(_text("https://y/emenu/", c)), "boatdetail")
    html = F.when(k % 2 == 0, _text('<a href="x">a</a> <a HREF = "https://h/card.vcard?id=', k, '">b</a>')).otherwise("<a href='x'>a</a>")
    return read(spark, d, "orders").select(
        "o_orderkey", urls.race(url)["race_id"].alias("race_id"), urls.race(url)["yr"].cast("long").alias("yr"), urls.sku(F.when(k % 3 != 0, _text("x?sku=", k))).alias("sku"), pair["event_id"].alias("event_id"), pair["entry_id"].alias("entry_id"),
        urls.vcard_link(html, _text("made-", k)).alias("card"),
    )


@query("""
select o_orderkey, case when o_orderkey % 3 = 0 then null else 2000 + o_orderkey % 100 end::bigint as lone, case when o_orderkey % 2 = 0 then 2000 + o_orderkey % 100 end::bigint as word, 'Cup ' || o_orderkey as bare,
  strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d') as since from orders
""")
def season_years(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    year = 2000 + k % 100
    forms = F.when(k % 4 == 0, F.date_format(day, "yyyy-M-d")).when(k % 4 == 1, F.date_format(day, "M/d/yyyy")).when(k % 4 == 2, F.date_format(day, "MMMM d, yyyy")).otherwise(F.date_format(day, "MMM d, yyyy"))
    return read(spark, d, "orders").select(
        "o_orderkey", dates.lone_year(F.when(k % 3 == 0, "x12024y").otherwise(_text("ev", year, "b"))).cast("long").alias("lone"), dates.word_year(F.when(k % 2 == 0, _text("May ", year, " cup")).otherwise(_text("May", year))).cast("long").alias("word"),
        dates.without_year(_text("2024 Cup ", k)).alias("bare"), dates.day_of(F.concat(F.date_format(day, "yyyy-M-d"), F.lit(" 7:08:09"))).cast("string").alias("day"), dates.member_since(forms).cast("string").alias("since"),
    )


@query("""
select c_custkey, case when c_custkey % 3 = 0 or c_custkey % 5 = 0 then 'confirmed' when c_custkey % 2 = 0 then 'submitted' else 'unknown' end as status, c_custkey % 7 = 0 or c_custkey % 11 = 0 or c_custkey % 13 = 0 as placeholder from customer
""")
def entry_statuses(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(
        "c_custkey", F.when(k % 3 == 0, "2025-1-2 3:04:05").otherwise("0000-00-00 00:00:00").alias("date_paid"), F.when(k % 5 == 0, " FREE ").otherwise("card").alias("Paid Type"), F.when(k % 2 == 0, "2025-1-2 3:04:05").otherwise("").alias("date_entered"),
        F.when(k % 7 == 0, " None/Other").when(k % 11 == 0, "-").otherwise("Hull YC").alias("Club"), F.when(k % 13 == 0, "rms").otherwise("HYC").alias("org_abbrev"),
    )
    return rows.select("c_custkey", feeds.entry_status().alias("status"), feeds.placeholder_club(F.col("Club"), F.col("org_abbrev")).alias("placeholder"))


@query("""
select n_nationkey, case when n_nationkey % 4 = 3 then null else 'race:' || n_nationkey || ':yr:' || case when n_nationkey % 2 = 0 then 2024 else 2023 end end as source_id, 'cup-' || n_nationkey as series_slug, n_nationkey % 2 = 0 as source_ok from nation
""")
def event_ids_in_json(spark, d):
    """Ids of base-copy events: JSON with texts or numbers, or the entries' URL; the year of a tag comes first."""
    k = F.col("n_nationkey")
    ids = F.when(k % 4 == 0, _text('{"race_id": ', k, ', "yr": 1999}')).when(k % 4 == 1, _text('{"race_id": "', k, '", "yr": "2023"}')).otherwise("not json")
    url = F.when(k % 4 == 2, _text("https://h?race_id=", k, "&yr=2023")).otherwise("")
    rows = read(spark, d, "nation").select("n_nationkey", ids.alias("event_global_id"), F.when(k % 2 == 0, "tag_2024").otherwise("tag").alias("source"), url.alias("entries_url"), _text("2024 Cup ", k).alias("Event Name"), F.lit("H").alias("Host Club"))
    return ingest.staged_base(rows, "base_events").select("n_nationkey", "source_id", "series_slug", F.coalesce("source_ok", F.lit(False)).alias("source_ok"))


@query("""
select s_suppkey, sha256('{"a":"' || s_name || '","b":' || case when s_suppkey % 2 = 0 then 'null' else '"' || s_nationkey || '"' end || '}') as row_hash, case when s_suppkey % 3 = 0 then 'skipped_low_name_quality' when s_suppkey % 2 = 0 then 'email_lookup' else 'unsupported_mode' end as search_mode,
  case when s_suppkey % 4 = 0 then null else 'Newport' end as city, case when s_suppkey % 4 = 0 then null else 'RI' end as state, case when s_suppkey % 4 in (0, 1) then null else '02840' end as postal_code from supplier
""")
def row_hashes_and_modes(spark, d):
    k = F.col("s_suppkey")
    rows = read(spark, d, "supplier").select("s_suppkey", F.when(k % 2 != 0, F.col("s_nationkey").cast("string")).alias("b"), F.col("s_name").alias("a"), F.when(k % 3 == 0, "Bay Sailing Club").otherwise("Ann Lee").alias("display_name"), F.when(k % 2 == 0, "a@x.org").alias("best_email"))
    place = places.address_parts(F.when(k % 4 == 0, "Newport, RI").when(k % 4 == 1, "1 Main | Newport | RI").otherwise("1 Main, Newport,  RI 02840 USA"))
    return enrich.mode(rows).select("s_suppkey", keys.row_hash("b", "a").alias("row_hash"), "search_mode", place["city"].alias("city"), place["state"].alias("state"), place["postal_code"].alias("postal_code"))


@query("""
select s_suppkey, s_suppkey % 3 as n, case when s_suppkey % 3 > 0 then 'N' || s_suppkey end as name, case when s_suppkey % 3 > 0 then 'a@x,b' || s_suppkey || '@x' end as emails, case when s_suppkey % 3 > 0 and s_suppkey % 2 = 0 then (s_suppkey % 100)::bigint end as confidence from supplier
""")
def provider_profiles(spark, d):
    k = F.col("s_suppkey")
    one = F.concat(_text('{"id": 1, "name": "N', k, '", "emails": ["a@x", {"email": "b', k, '@x"}], "phones": [{"number": "1"}], "confidence": '), F.when(k % 2 == 0, _text('"', k % 100, '"')).otherwise('"high"'), F.lit("}"))
    body = F.concat(F.lit('{"profiles": ['), F.array_join(F.array_repeat(one, (k % 3).cast("int")), ","), F.lit("]}"))
    rows = read(spark, d, "supplier").select("s_suppkey", enrich.profiles(body).alias("p"))
    first = F.get("p", F.lit(0))
    return rows.select("s_suppkey", F.size("p").cast("long").alias("n"), first["name"].alias("name"), F.array_join(first["emails"], ",").alias("emails"), first["confidence"].cast("long").alias("confidence"))


@query("""
select 'enum' as rule, count(*) as n from orders where o_orderstatus not in ('F', 'O') union all select 'range', count(*) from orders where o_totalprice not between 1000 and 200000
union all select 'exactly one', count(*) from orders where (o_orderkey % 2 = 0)::int + (o_orderkey % 3 = 0)::int <> 1 union all select 'ordered pair', count(*) from orders where not (o_custkey < o_orderkey)
union all select 'dates', count(*) from lineitem join orders on o_orderkey = l_orderkey where not (o_orderdate <= l_shipdate) union all select 'promoted', count(*) from orders where o_orderkey % 5 = 0 and (o_orderkey % 2 <> 0 or o_orderkey % 3 <> 0)
""")
def integrity_rules(spark, d):
    """How many rows break each kind of rule."""
    o, k = read(spark, d, "orders"), F.col("o_orderkey")
    lines = read(spark, d, "lineitem").join(o, F.col("l_orderkey") == k)
    pairs = o.select(F.when(k % 2 == 0, k).alias("a"), F.when(k % 3 == 0, k).alias("b"))
    states = o.select((k % 5 == 0).alias("is_promoted"), F.when(k % 2 == 0, "c").alias("promoted_canonical_id"), F.when(k % 3 == 0, "auto_promote").otherwise("hold").alias("resolution_state"))
    found = {
        "enum": expect.violations(o, F.col("o_orderstatus").isin("F", "O")), "range": expect.violations(o, F.col("o_totalprice").between(1000, 200000)), "exactly one": expect.violations(pairs, expect.exactly_one("a", "b")),
        "ordered pair": expect.violations(o, expect.ordered("o_custkey", "o_orderkey", strict=True)), "dates": expect.violations(lines, expect.ordered("o_orderdate", "l_shipdate")), "promoted": expect.violations(states, expect.promoted_rule()),
    }
    out = None
    for name, rows in found.items():
        one = rows.agg(F.lit(name).alias("rule"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""
select c_custkey as id, case when c_custkey % 2 = 0 and c_custkey % 3 <> 0 then '2020-01-01' else '2025-01-01' end as updated_at from customer
""")
def touched_rows(spark, d):
    """The time of update moves only where a field has changed or the row is new."""
    k = F.col("c_custkey")
    base = read(spark, d, "customer")
    old = base.where(k % 2 == 0).select(k.alias("id"), "c_name", F.when(k % 4 == 0, "x").alias("c_mktsegment"), F.lit("2020-01-01").alias("updated_at"))
    new = base.select(k.alias("id"), F.when(k % 3 == 0, "changed").otherwise(F.col("c_name")).alias("c_name"), F.when(k % 4 == 0, "x").alias("c_mktsegment"), F.lit(None).cast("string").alias("updated_at"))
    return expect.touched(old, new, "id", ["c_name", "c_mktsegment"], F.lit("2025-01-01")).select("id", "updated_at")


@query("""
select 'club' as entity_type, 'blocked' as what, count(*) as n from supplier where s_suppkey % 6 = 0 union all select 'club', 'would promote', count(*) from supplier where s_suppkey % 6 <> 0 and s_suppkey % 4 <> 0
union all select 'club', 'held back', count(*) from supplier where s_suppkey % 6 <> 0 and s_suppkey % 4 <> 0 and s_suppkey % 5 = 0
union all select 'yacht', 'would promote', count(*) from part where p_size >= 25 and p_partkey % 3 <> 0 union all select 'yacht', 'held back', count(*) from part where p_size >= 25 and p_partkey % 3 <> 0
""")
def diagnostics(spark, d):
    """Hard blocks, and who would be promoted by score alone, over the candidates of several kinds."""
    s, p = F.col("s_suppkey"), F.col("p_partkey")
    blocked = s % 6 == 0
    clubs = read(spark, d, "supplier").select(
        s.cast("string").alias("id"), F.when(s % 5 == 0, "hold").otherwise("auto_promote").alias("resolution_state"), (s % 4 == 0).alias("is_promoted"), F.when(blocked, 0.0).otherwise(0.9).alias("quality_score"),
        F.when(blocked, F.array(F.lit("hard_block:merged"))).otherwise(F.array(F.lit("feature:x:0.1000"))).alias("confidence_reasons"),
    )
    yachts = read(spark, d, "part").select(p.cast("string").alias("id"), F.lit("hold").alias("resolution_state"), (p % 3 == 0).alias("is_promoted"), F.when(F.col("p_size") >= 25, 0.8).otherwise(0.2).alias("quality_score"), F.array().cast("array<string>").alias("confidence_reasons"))
    rows = scoring.all_kinds({"club": clubs, "yacht": yachts})
    up = scoring.would_promote(rows)
    told = scoring.blocked_counts(rows).select("entity_type", F.lit("blocked").alias("what"), "n")
    return told.unionByName(up.select("entity_type", F.lit("would promote").alias("what"), "n")).unionByName(up.select("entity_type", F.lit("held back").alias("what"), F.col("held_back").alias("n")))


@query("select o_orderkey as seq, 'order ' || o_orderkey || ' is pending' as warning from orders where o_orderstatus = 'P' order by o_orderkey limit 20")
def first_warnings(spark, d):
    return gates.warnings(read(spark, d, "orders"), F.col("o_orderstatus") == "P", _text("order ", F.col("o_orderkey"), " is pending"), "o_orderkey", 20)


@query("""
select s_suppkey, 'Ann ' || s_suppkey as display_name, 'RI 0' || s_suppkey as home, case when s_suppkey % 2 = 0 then 'Bob' || s_suppkey || ':spouse,Cy:son' else '' end as household, 'm' || s_suppkey || '@x.org,card@x.org' as emails, case when s_suppkey % 3 = 0 then 2 else 1 end::bigint as phones, 'Wave ' || s_suppkey as boat from supplier
""")
def profile_tables(spark, d):
    """Label-value tables of member pages, with the vCard that fills their gaps."""
    k = F.col("s_suppkey")
    row = lambda label, value: F.concat(F.lit(f"<tr><td>{label}:</td><td> </td><td>"), value, F.lit("</td></tr>"))
    html = F.concat(
        F.lit("<h1>Member</h1><table>"), row("Name", _text("Ann ", k)), row("Email", _text("m", k, "@x.org")), row("Home Phone", F.lit("555 123 4567")), row("Year Round Address", _text("RI 0", k)), row("Boat Name", _text("Wave ", k)),
        F.when(k % 2 == 0, row("Other Members", _text("Bob", k, " - Spouse / Adult<br>Cy (Son)"))).otherwise(""), F.lit("</table>"),
    )
    card = F.concat(F.lit("BEGIN:VCARD\r\nFN:Other\r\nEMAIL;TYPE=home:card@x.\r\n org\r\nTEL;TYPE=cell:"), F.when(k % 3 == 0, "555 999 0000").otherwise("(555) 123-4567"), F.lit("\r\nEND:VCARD"))
    rows = read(spark, d, "supplier").select("s_suppkey", pages.profile(html).alias("p"), pages.vcard(card).alias("v"))
    household = F.array_join(F.transform("p.household", lambda h: F.concat(h["name"], F.lit(":"), h["relationship"])), ",")
    return pages.merged_profile(rows).select("s_suppkey", "display_name", F.get("p.addresses", F.lit(0))["raw"].alias("home"), household.alias("household"), F.array_join("all_emails", ",").alias("emails"), F.size("all_phones").cast("long").alias("phones"), F.get("p.boats", F.lit(0))["name"].alias("boat"))
