"""Place hints: free text to city, state and country, and how usable they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import let, squeezed, titled, trimmed

# Names and codes of countries, by number of words.
COUNTRY_PHRASES = {
    "UNITED STATES OF AMERICA": "USA", "UNITED STATES": "USA", "GREAT BRITAIN": "GBR", "UNITED KINGDOM": "GBR", "NEW ZEALAND": "NZL", "SOUTH AFRICA": "RSA",
}
COUNTRY_WORDS = {
    "USA": "USA", "US": "USA", "U.S.": "USA", "U.S.A.": "USA", "CAN": "CAN", "CANADA": "CAN", "IND": "IND", "INDIA": "IND", "GBR": "GBR", "UK": "GBR", "U.K.": "GBR",
    "AUS": "AUS", "AUSTRALIA": "AUS", "NZL": "NZL", "FRA": "FRA", "FRANCE": "FRA", "GER": "GER", "GERMANY": "GER", "ITA": "ITA", "ITALY": "ITA", "ESP": "ESP", "SPAIN": "ESP",
    "NED": "NED", "NETHERLANDS": "NED", "HOLLAND": "NED", "NOR": "NOR", "NORWAY": "NOR", "SWE": "SWE", "SWEDEN": "SWE", "DEN": "DEN", "DENMARK": "DEN", "RSA": "RSA",
    "BER": "BER", "BERMUDA": "BER", "BAH": "BAH", "BAHAMAS": "BAH", "JAM": "JAM", "JAMAICA": "JAM", "MEX": "MEX", "MEXICO": "MEX", "BRA": "BRA", "BRAZIL": "BRA",
    "ARG": "ARG", "ARGENTINA": "ARG", "CHI": "CHI", "CHILE": "CHI", "CHN": "CHN", "CHINA": "CHN", "JPN": "JPN", "JAPAN": "JPN",
}
# States of the USA.
STATE_PHRASES = {
    "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "RHODE ISLAND": "RI",
    "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "WEST VIRGINIA": "WV",
}
STATE_WORDS = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT", "DELAWARE": "DE", "FLORIDA": "FL",
    "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME",
    "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV",
    "OHIO": "OH", "OKLAHOMA": "OK", "OREGON": "OR", "PENNSYLVANIA": "PA", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA",
    "WASHINGTON": "WA", "WISCONSIN": "WI", "WYOMING": "WY",
}
# Boat classes and club words that are no places.
NO_PLACE = ["LASER", "OPTIMIST", "OPTI", "SUNFISH", "420", "470", "29ER", "FJ", "FLYING JUNIOR", "MOTH", "RS AERO", "MELGES", "J24", "J/24", "J/22", "J/35", "THISTLE", "SNIPE", "LIGHTNING"]
NO_PLACE_PARTS = ["YACHT CLUB", "SAILING CLUB", "BOAT CLUB", "ROWING CLUB", "MARINA", "CRUISING CLUB", "CORINTHIAN"]
#: Quality classes, best first; the last two are never usable.
RANK = {"city_state_country": 1, "city_country": 2, "state_country": 3, "freeform_partial": 4, "country_only": 5, "non_address_junk": 99, "empty_or_null": 99}


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def clean_upper(c: Column) -> Column:
    return squeezed(F.replace(F.upper(trimmed(c)), F.lit(","), F.lit(" ")))


def is_junk(c: Column) -> Column:
    up = clean_upper(c)
    return F.coalesce(up.isin(NO_PLACE) | up.rlike("|".join(NO_PLACE_PARTS)), F.lit(False))


def _tail(words: Column, n: int) -> Column:
    size = F.size(words)
    return F.when(size >= n, F.array_join(F.slice(words, F.greatest(size - n + 1, F.lit(1)), F.lit(n)), " "))


def _stripped(words: Column, tables: list[tuple[int, Column]]) -> Column:
    """Struct(rest, code): the last words that name something are cut off, longest names first."""
    none = F.struct(words.alias("rest"), F.lit(None).cast("string").alias("code"))
    out = None
    for n, table in tables:
        code = table[_tail(words, n)]
        hit = F.struct(F.slice(words, F.lit(1), F.greatest(F.size(words) - n, F.lit(0))).alias("rest"), code.alias("code"))
        out = F.when(code.isNotNull(), hit) if out is None else out.when(code.isNotNull(), hit)
    return out.otherwise(none)


def hint(c: Column) -> Column:
    """Struct(city, state_region, country_code, quality_class, normalized_hint) of free text.

    Read from the right: a country, then, unless it is a foreign one, a state of
    the USA; what is left is the city.
    """
    phrases, one = _map(COUNTRY_PHRASES), _map(COUNTRY_WORDS)
    abbreviations = {v: v for v in [*STATE_PHRASES.values(), *STATE_WORDS.values()]}
    states, state_words = _map(STATE_PHRASES), _map(abbreviations | STATE_WORDS)
    none = F.lit(None).cast("string")

    def made(city: Column, state: Column, country: Column, quality: Column, text: Column) -> Column:
        return F.struct(city.alias("city"), state.alias("state_region"), country.alias("country_code"), quality.alias("quality_class"), text.alias("normalized_hint"))

    def named(country: Column) -> Column:
        home = country["code"].isNull() | (country["code"] == "USA")
        keep = F.struct(country["rest"].alias("rest"), none.alias("code"))
        return let(F.when(home, _stripped(country["rest"], [(2, states), (1, state_words)])).otherwise(keep), lambda s: final(country, s))

    def final(country: Column, state: Column) -> Column:
        city = titled(F.nullif(F.array_join(state["rest"], " "), F.lit("")))
        return let(F.struct(city.alias("city"), state["code"].alias("state"), country["code"].alias("country")), graded)

    def graded(p: Column) -> Column:
        city, state, country = p["city"], p["state"], p["country"]
        quality = (
            F.when(city.isNotNull() & state.isNotNull() & country.isNotNull(), "city_state_country")
            .when(city.isNotNull() & country.isNotNull(), "city_country")
            .when(state.isNotNull() & country.isNotNull(), "state_country")
            .when(country.isNotNull(), "country_only")
            .otherwise("freeform_partial")
        )
        text = F.nullif(F.concat_ws(" ", city, state, country), F.lit(""))
        return made(city, state, country, quality, F.coalesce(text, titled(squeezed(F.replace(c, F.lit(","), F.lit(" "))))))

    words = F.split(clean_upper(c), " ")
    parsed = let(_stripped(words, [(4, phrases), (3, phrases), (2, phrases), (1, one)]), named)
    empty = F.array().cast("array<string>")
    bare = let(F.struct(empty.alias("rest"), none.alias("code")), named)
    return (
        F.when(trimmed(c).isNull(), made(none, none, none, F.lit("empty_or_null"), none))
        .when(is_junk(c), made(none, none, none, F.lit("non_address_junk"), none))
        .when(clean_upper(c).isNull(), bare)
        .otherwise(parsed)
    )


def address_parts(c: Column) -> Column:
    """Struct(line1, city, state, postal_code, country) of an address with three or more parts; else all null."""
    none = F.lit(None).cast("string")

    def cut(parts: Column) -> Column:
        end = F.split(F.element_at(parts, -1), r"\s+")
        pick = lambda i: F.nullif(F.get(end, F.lit(i)), F.lit(""))
        full = F.struct(F.get(parts, F.lit(0)).alias("line1"), F.get(parts, F.lit(1)).alias("city"), pick(0).alias("state"), pick(1).alias("postal_code"), pick(2).alias("country"))
        blank = F.struct(none.alias("line1"), none.alias("city"), none.alias("state"), none.alias("postal_code"), none.alias("country"))
        return F.when(F.size(parts) >= 3, full).otherwise(blank)

    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[,|]"), trimmed), lambda x: x.isNotNull())
    return let(parts, cut)


def plausible_person(c: Column) -> Column:
    """A name of two letters or more and at most five words, none of them an organisation's, without & and /."""
    org = ["club", "team", "yacht", "sailing", "marina", "cruising", "corinthian", "association", "corps", "committee"]
    words = F.split(F.lower(squeezed(c)), " ")
    ok = (F.length(trimmed(c)) >= 2) & ~c.rlike("[&/]") & ~F.arrays_overlap(words, F.array(*[F.lit(x) for x in org])) & (F.size(words) <= 5)
    return F.coalesce(ok, F.lit(False))
