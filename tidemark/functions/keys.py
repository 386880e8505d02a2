"""Deterministic ids, fingerprints and cross-reference keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import slug


def piped(*parts: Column) -> Column:
    """Parts with | between; null is blank."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def fingerprint(*parts: Column) -> Column:
    return F.sha2(piped(*parts), 256)


def participant_fingerprint(name_key: Column, email: Column) -> Column:
    return fingerprint(name_key, F.lower(email))


def yacht_fingerprint(name_slug: Column, sail_slug: Column) -> Column:
    return fingerprint(name_slug, sail_slug)


def club_fingerprint(name_slug: Column) -> Column:
    return fingerprint(name_slug)


def event_fingerprint(name_slug: Column, season: Column, external_id: Column) -> Column:
    """A season of 0 counts as none."""
    return fingerprint(name_slug, F.nullif(season, F.lit(0)), external_id)


def registration_fingerprint(external_id: Column, event_id: Column, yacht_id: Column) -> Column:
    return fingerprint(external_id, event_id, yacht_id)


def entry_hash(*parts: Column) -> Column:
    """32 hex digits that stand for an entry without an id of its own."""
    return F.substring(fingerprint(*parts), 1, 32)


def entity_id(kind: str, *parts: Column) -> Column:
    """Id of a new entity: the same parts give the same id on every run."""
    return F.substring(F.sha2(F.concat(F.lit(f"{kind}|"), piped(*parts)), 256), 1, 32)


def payload(*columns: str) -> Column:
    """Lossless JSON of a row, keys in alphabetical order, nulls kept."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})


def row_hash(*columns: str) -> Column:
    return F.sha2(payload(*columns), 256)


def subscriber_hash(email: Column) -> Column:
    return F.md5(F.lower(email))


def yacht_key(name: Column, sail: Column) -> Column:
    """n:name:s:sail; null without a name."""
    return F.when(slug(name).isNotNull(), F.concat(F.lit("n:"), slug(name), F.lit(":s:"), F.coalesce(slug(sail), F.lit(""))))


def owner_key(name: Column, affiliation: Column, place: Column) -> Column:
    return F.when(slug(name).isNotNull(), piped(slug(name), slug(affiliation), slug(place)))


def race_key(race_id: Column, yr: Column) -> Column:
    return F.when(race_id.isNotNull() & yr.isNotNull(), F.concat(F.lit("race:"), race_id, F.lit(":yr:"), yr.cast("string")))
