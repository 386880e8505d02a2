"""Parts of URLs as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to_null, trimmed


def parameter(url: Column, name: str) -> Column:
    """First value of a query parameter, decoded; blank ones count as absent."""
    raw = blank_to_null(F.regexp_extract(trimmed(url), rf"^[^?#]*\?(?:[^#]*&)?{name}=([^&#]+)", 1))
    return F.try_url_decode(raw)


def race(url: Column) -> Column:
    """Struct(race_id, yr) of an entries URL; yr only if it is a number."""
    yr = parameter(url, "yr")
    return F.struct(parameter(url, "race_id").alias("race_id"), F.when(yr.rlike(r"^\d+$"), yr.try_cast("int")).alias("yr"))


def entries_url(url: Column, base: str) -> Column:
    """``base`` with race_id and yr alone; null where one is missing."""
    r = race(url)
    return F.when(r["race_id"].isNotNull() & r["yr"].isNotNull(), F.concat(F.lit(f"{base}?race_id="), r["race_id"], F.lit("&yr="), r["yr"].cast("string")))


def sku(url: Column) -> Column:
    return parameter(url, "sku")


def number_after(url: Column, step: str) -> Column:
    """Digits that follow a path step."""
    return blank_to_null(F.regexp_extract(trimmed(url), rf"/{step}/(\d+)", 1))


def number_pair_after(url: Column, step: str) -> Column:
    """Struct(event_id, entry_id) of two numbers that follow a path step; both or neither."""
    pick = lambda k: blank_to_null(F.regexp_extract(trimmed(url), rf"/{step}/(\d+)/(\d+)", k))
    return F.struct(pick(1).alias("event_id"), pick(2).alias("entry_id"))


def vcard_link(html: Column, fallback: Column) -> Column:
    """First link that names a vCard, else ``fallback``."""
    return F.coalesce(blank_to_null(F.regexp_extract(html, r"""(?i)href\s*=\s*["']([^"']*vcard[^"']*)["']""", 1)), fallback)
