"""Audience activation: suppression, segments, one row per e-mail, export."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import subscriber_hash
from tidemark.operators.latest import best_struct, winners

SUPPRESSED = ("unsubscribed", "cleaned")
EXPORT = (
    "email", "first_name", "last_name", "display_name", "club_name", "yacht_name", "segment_types", "upcoming_event_count", "historical_registration_count",
    "last_registered_event_name", "participant_id", "contributing_participant_ids", "generated_at",
)


def suppression(states: DataFrame) -> DataFrame:
    """E-mails whose latest state forbids mail, and that state; null times count as oldest, ties go to the later row."""
    latest = best_struct(states.where(F.col("email").isNotNull()), ["email"], ["audience_status"], F.struct(F.coalesce("status_at", F.lit("0001-01-01").cast("timestamp")), "ingest_seq"))
    return latest.where(F.col("audience_status").isin(*SUPPRESSED)).withColumnRenamed("audience_status", "suppression_reason")


def _upcoming(events: DataFrame, today: Column, days: int) -> DataFrame:
    return events.where(F.col("start_date").between(today, F.date_add(today, days)))


def _people(participants: DataFrame) -> DataFrame:
    score = F.coalesce("canonical_confidence_score", F.lit(0)).cast("double")
    return participants.where(F.col("best_email").isNotNull()).select(F.col("id").alias("participant_id"), F.col("best_email").alias("email"), "first_name", "last_name", "display_name", score.alias("confidence_score"), "updated_at")


def upcoming_registrants(participants: DataFrame, registrations: DataFrame, events: DataFrame, yachts: DataFrame, today: Column, days: int = 45) -> DataFrame:
    """Participants registered for events that start within ``days``."""
    own = registrations.where(F.col("participant_id").isNotNull())
    soon = own.join(_upcoming(events, today, days).select(F.col("id").alias("event_id"), "event_name"), "event_id").join(yachts.select(F.col("id").alias("yacht_id"), "name"), "yacht_id", "left")
    now = soon.groupBy("participant_id").agg(F.count_distinct("event_id").alias("upcoming_event_count"), F.max("name").alias("yacht_name"), F.max("event_name").alias("last_registered_event_name"))
    ever = own.groupBy("participant_id").agg(F.count("*").alias("historical_registration_count"))
    return _people(participants).join(now, "participant_id").join(ever, "participant_id").withColumn("segment_types", F.array(F.lit("upcoming_registrants")))


def likely_registrants(participants: DataFrame, registrations: DataFrame, events: DataFrame, today: Column, days: int = 45, seasons: int = 3) -> DataFrame:
    """Participants of past events of the last seasons who aren't registered for an upcoming one."""
    own = registrations.where(F.col("participant_id").isNotNull())
    past = (F.col("start_date") < today) & F.col("season_year").between(F.year(today) - seasons, F.year(today))
    soon = F.col("start_date").between(today, F.date_add(today, days))
    marked = events.select(F.col("id").alias("event_id"), "event_name", past.alias("_past"), soon.alias("_soon"))
    per = own.join(marked, "event_id").groupBy("participant_id").agg(F.count_if("_past").alias("historical_registration_count"), F.max(F.when(F.col("_past"), F.col("event_name"))).alias("last_registered_event_name"), F.bool_or(F.coalesce("_soon", F.lit(False))).alias("_soon"))
    per = per.where((F.col("historical_registration_count") > 0) & ~F.col("_soon")).drop("_soon")
    rows = _people(participants).join(per, "participant_id")
    return rows.withColumns({"upcoming_event_count": F.lit(0).cast("long"), "yacht_name": F.lit(None).cast("string"), "segment_types": F.array(F.lit("likely_registrants"))})


def merged_segments(*segments: DataFrame) -> DataFrame:
    """One row per participant: attributes of the first segment, union of types, greatest counts."""
    rows = None
    for i, s in enumerate(segments):
        s = s.withColumn("_seg", F.lit(i))
        rows = s if rows is None else rows.unionByName(s)
    first = ["email", "first_name", "last_name", "display_name", "confidence_score", "updated_at", "yacht_name", "last_registered_event_name"]
    types = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_seg", "segment_types"))), lambda x: x["segment_types"])))
    counts = [F.max(c).alias(c) for c in ("upcoming_event_count", "historical_registration_count")]
    return rows.groupBy("participant_id").agg(F.min_by(F.struct(*first), "_seg").alias("_a"), types.alias("segment_types"), *counts).select("participant_id", "_a.*", "segment_types", "upcoming_event_count", "historical_registration_count")


def by_email(rows: DataFrame) -> DataFrame:
    """Winner per e-mail: highest confidence, then latest update (none counts as the epoch), then lowest id."""
    order = [F.desc("confidence_score"), F.desc(F.coalesce("updated_at", F.lit("1970-01-01").cast("timestamp"))), F.asc("participant_id")]
    return winners(rows, "email", order, "participant_id", ["segment_types"]).withColumnRenamed("contributing_ids", "contributing_participant_ids").withColumn("segment_types", F.array_sort("segment_types"))


def activated(rows: DataFrame, suppressed: DataFrame) -> DataFrame:
    return by_email(rows).join(suppressed, "email", "left").withColumn("is_suppressed", F.col("suppression_reason").isNotNull())


def export(rows: DataFrame, generated_at: str) -> DataFrame:
    """Rows of the audience file, in order of e-mail: eligible ones only, lists comma-joined, club always blank."""
    live = rows.where(~F.col("is_suppressed")).withColumns({"segment_types": F.array_join("segment_types", ","), "contributing_participant_ids": F.array_join("contributing_participant_ids", ","), "club_name": F.lit(""), "generated_at": F.lit(generated_at)})
    return live.select(*EXPORT).orderBy("email")


def audit(rows: DataFrame, run_id: str) -> DataFrame:
    """One row per run and e-mail with its payload."""
    body = F.to_json(F.struct("segment_types", "contributing_participant_ids", "upcoming_event_count", "historical_registration_count"))
    return rows.select(F.lit(run_id).alias("run_id"), "email", "participant_id", "segment_types", "is_suppressed", "suppression_reason", body.alias("payload"))


DELIVERED = "email string, participant_id string, status string, contact_id string, attempts int"


def deliver(rows: DataFrame, client: Callable[[], Callable[[str, dict], tuple[int, dict]]], attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Hand each eligible row to an injected client, made once per partition, and return what became of it.

    The client takes the subscriber's hash and the member's data with a tag per
    segment, and gives a status and an answer. A busy provider (429) is asked
    again after 1, 2, ... seconds. contact_id is the provider's id, which
    :func:`tidemark.operators.match.provider_ids` may then record.
    """
    live = rows.where(~F.col("is_suppressed")).select(subscriber_hash(F.col("email")).alias("hash"), "email", F.col("participant_id").cast("string"), "segment_types")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        for frame in frames:
            out = []
            for r in frame.itertuples():
                status, answer, k = 429, {}, 0
                while status == 429 and k < attempts:
                    if k:
                        sleep(float(2 ** (k - 1)))
                    k += 1
                    status, answer = call(r.hash, {"email_address": r.email, "tags": list(r.segment_types)})
                out.append((r.email, r.participant_id, "delivered" if status < 400 else "rate_limited" if status == 429 else "failed", answer.get("contact_id"), k))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in DELIVERED.split(", ")])

    return live.mapInPandas(run, DELIVERED)
