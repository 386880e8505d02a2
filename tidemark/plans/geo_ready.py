"""Which held candidates have a usable place, and why not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.places import RANK, hint


def hints(addresses: DataFrame) -> DataFrame:
    """candidate_id, address_raw, seq and the parts of the place hint."""
    real = addresses.where(F.col("address_raw").isNotNull() & (F.col("address_raw") != ""))
    return real.withColumn("_h", hint(F.col("address_raw"))).select("candidate_id", "address_raw", "seq", "_h.*")


def best_hints(found: DataFrame, country_only: bool = False, freeform: bool = False) -> DataFrame:
    """Per candidate: hints, the best usable one and whether its class names several places.

    The best class that occurs decides; different (city, state) in it conflict,
    countries don't. The first address of the class is taken.
    """
    usable = ["city_state_country", "city_country", "state_country", *["freeform_partial"] * freeform, *["country_only"] * country_only]
    rank = F.when(F.col("quality_class").isin(usable), F.create_map(*[x for k, v in RANK.items() for x in (F.lit(k), F.lit(v))])[F.col("quality_class")])
    rows = found.withColumn("_rank", rank)
    fields = F.struct("address_raw", "normalized_hint", "city", "state_region", "country_code", "quality_class")
    per_class = rows.groupBy("candidate_id", "_rank").agg(
        F.count_distinct(F.struct("city", "state_region")).alias("_places"),
        F.min_by(fields, "seq").alias("_b"),
        F.count_if(F.col("quality_class") != "empty_or_null").alias("_filled"),
        F.count_if(F.col("quality_class") == "non_address_junk").alias("_junk"),
        F.count("*").alias("_n"),
    )
    best = F.min_by(F.struct("_places", "_b"), F.when(F.col("_rank").isNotNull(), F.col("_rank")))
    out = per_class.groupBy("candidate_id").agg(best.alias("_t"), F.sum("_filled").alias("_filled"), F.sum("_junk").alias("_junk"), F.sum("_n").alias("n_hints"))
    conflict = F.coalesce(F.col("_t._places") > 1, F.lit(False))
    shown = F.when(~conflict, F.col("_t._b"))
    return out.select("candidate_id", "n_hints", conflict.alias("is_conflict"), ((F.col("_filled") > 0) & (F.col("_filled") == F.col("_junk"))).alias("all_junk"), *[shown[c].alias(f"best_{c}") for c in ("address_raw", "normalized_hint", "city", "state_region", "country_code", "quality_class")])


def readiness(candidates: DataFrame, contacts: DataFrame, addresses: DataFrame, states: Sequence[str] = ("hold",), country_only: bool = False, freeform: bool = False, limit: int | None = None) -> DataFrame:
    """Status of each unpromoted candidate of ``states`` with an address: contact, conflict, junk, vague, nameless or ready."""
    pool = candidates.where(F.col("resolution_state").isin(*states) & ~F.coalesce("is_promoted", F.lit(False)))
    found = hints(addresses)
    pool = pool.join(found.select(F.col("candidate_id").alias("id")), "id", "left_semi")
    if limit is not None:
        pool = pool.orderBy("id").limit(limit)
    child = contacts.where(F.col("normalized_value").isNotNull() & F.col("contact_type").isin("email", "phone")).select(F.col("candidate_id").alias("id")).distinct().withColumn("_child", F.lit(True))
    best = best_hints(found, country_only, freeform).withColumnRenamed("candidate_id", "id")
    d = pool.join(best, "id").join(child, "id", "left")
    there = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    status = (
        F.when(there("best_email") | there("best_phone") | F.col("_child").isNotNull(), "already_has_contact")
        .when(F.col("is_conflict"), "multi_location_conflict")
        .when(F.col("best_quality_class").isNull() & F.col("all_junk"), "junk_location")
        .when(F.col("best_quality_class").isNull(), "too_vague")
        .when(~there("normalized_name"), "too_vague")
        .otherwise("enrichment_ready")
    )
    reason = (
        F.when(F.col("readiness_status") == "already_has_contact", "effective_email_or_phone_present")
        .when(F.col("readiness_status") == "multi_location_conflict", "multiple_distinct_city_state_hints")
        .when(F.col("readiness_status") == "junk_location", "all_hints_non_address_junk")
        .when((F.col("readiness_status") == "too_vague") & F.col("best_quality_class").isNull(), "no_usable_geographic_hint")
        .when(F.col("readiness_status") == "too_vague", "missing_normalized_name")
        .otherwise("geo_hint_selected")
    )
    d = d.withColumn("readiness_status", status).withColumn("reason_code", reason)
    return d.select(F.col("id").alias("candidate_id"), "readiness_status", "reason_code", "n_hints", F.col("best_normalized_hint").alias("best_hint_text"), "best_city", "best_state_region", "best_country_code")


def invalidated(old: DataFrame, candidates: DataFrame, addresses: DataFrame, states: Sequence[str] = ("hold",)) -> DataFrame:
    """Earlier ready rows whose candidate has left the pool or lost its addresses become not_hold."""
    live = candidates.where(F.col("resolution_state").isin(*states) & ~F.coalesce("is_promoted", F.lit(False))).select(F.col("id").alias("candidate_id"))
    live = live.join(addresses.where(F.col("address_raw").isNotNull() & (F.col("address_raw") != "")).select("candidate_id"), "candidate_id", "left_semi").withColumn("_live", F.lit(True))
    stale = (F.col("readiness_status") == "enrichment_ready") & F.col("_live").isNull()
    d = old.join(live, "candidate_id", "left")
    return d.withColumns({"reason_code": F.when(stale, "invalidated_out_of_scope").otherwise(F.col("reason_code")), "readiness_status": F.when(stale, "not_hold").otherwise(F.col("readiness_status"))}).select(*old.columns)
