"""Standing views: missing documents, returners, review queue and enriched participants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import age, is_minor
from tidemark.operators.latest import best_struct


def missing_documents(requirements: DataFrame, types: DataFrame, instances: DataFrame, entries: DataFrame, crew: DataFrame, statuses: DataFrame) -> DataFrame:
    """Mandatory requirements by subject whose latest status isn't ``received``.

    The subject is a participant in a matching role, an entry or a yacht, as the
    document type's scope says. Each scope is a join on the event of its own, so
    no status of one scope is taken for another's.
    """
    need = requirements.where("is_mandatory").join(types.select(F.col("id").alias("document_type_id"), F.col("name").alias("document_type_name"), F.col("scope").alias("document_scope")), "document_type_id")
    need = need.join(instances.select(F.col("id").alias("event_instance_id"), F.col("display_name").alias("event_display_name"), "season_year"), "event_instance_id")
    need = need.withColumnRenamed("id", "document_requirement_id")
    order = F.struct("status_at", "id")
    lone = F.col("participant_id").isNotNull() & F.col("event_entry_id").isNull()
    by_person = best_struct(statuses.where(lone), ["document_requirement_id", "participant_id"], ["status"], order)
    by_entry = best_struct(statuses.where(F.col("event_entry_id").isNotNull() & F.col("participant_id").isNull()), ["document_requirement_id", "event_entry_id"], ["status"], order)
    via = statuses.where(F.col("event_entry_id").isNotNull()).join(entries.select(F.col("id").alias("event_entry_id"), "yacht_id"), "event_entry_id")
    by_yacht = best_struct(via, ["document_requirement_id", "yacht_id"], ["status"], order)

    here = entries.select(F.col("id").alias("event_entry_id"), "event_instance_id", "yacht_id")
    people = here.join(crew.select("event_entry_id", "participant_id", "role"), "event_entry_id").select("event_instance_id", "participant_id", "role")
    match = F.col("required_for_role").isNull() | (F.col("role") == F.col("required_for_role"))
    keep = ["document_requirement_id", "event_instance_id", "document_type_id", "document_type_name", "document_scope", "required_for_role", "due_at", "event_display_name", "season_year"]
    subjects = ("participant_id", "event_entry_id", "yacht_id")

    def unmet(scope: str, rows: DataFrame, subject: str, latest: DataFrame, extra: Column | None = None) -> DataFrame:
        each = need.where(F.col("document_scope") == scope).join(rows, "event_instance_id")
        each = (each if extra is None else each.where(extra)).select(*keep, subject).dropDuplicates(["document_requirement_id", subject])
        each = each.join(latest, ["document_requirement_id", subject], "left").where(F.col("status").isNull() | (F.col("status") != "received"))
        return each.select(*keep, *[F.col(s) if s == subject else F.lit(None).cast(rows_type[s]).alias(s) for s in subjects], F.col("status").alias("latest_status"))

    rows_type = {"participant_id": crew.schema["participant_id"].dataType, "event_entry_id": entries.schema["id"].dataType, "yacht_id": entries.schema["yacht_id"].dataType}
    parts = [unmet("participant", people, "participant_id", by_person, match), unmet("entry", here.select("event_instance_id", "event_entry_id"), "event_entry_id", by_entry), unmet("yacht", here.select("event_instance_id", "yacht_id"), "yacht_id", by_yacht)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def returners(participants: DataFrame, series: DataFrame, instances: DataFrame, entries: DataFrame, crew: DataFrame) -> DataFrame:
    """Who entered a series in an earlier season but not in its latest one that is open."""
    open_ = best_struct(instances.where(F.col("registration_open_at").isNotNull()), ["event_series_id"], ["id", "display_name", "season_year"], F.struct("season_year", "id"))
    target = open_.select("event_series_id", F.col("id").alias("current_event_instance_id"), F.col("display_name").alias("current_event_display_name"), F.col("season_year").alias("current_season_year"))
    seen = crew.select("event_entry_id", "participant_id").join(entries.select(F.col("id").alias("event_entry_id"), "event_instance_id"), "event_entry_id")
    seen = seen.join(instances.select(F.col("id").alias("event_instance_id"), "event_series_id", "season_year"), "event_instance_id")
    seen = seen.groupBy("participant_id", "event_series_id", "event_instance_id", "season_year").agg(F.lit(1).alias("_")).join(target, "event_series_id")
    now = F.bool_or(F.col("event_instance_id") == F.col("current_event_instance_id"))
    before = F.max(F.when(F.col("season_year") < F.col("current_season_year"), F.col("season_year")))
    keys = ["participant_id", "event_series_id", "current_event_instance_id", "current_event_display_name", "current_season_year"]
    # one aggregation answers both "was here before" and "isn't here now"
    per = seen.groupBy(*keys).agg(now.alias("_now"), before.alias("last_participated_year")).where(~F.col("_now") & F.col("last_participated_year").isNotNull()).drop("_now")
    per = per.join(participants.select(F.col("id").alias("participant_id"), "full_name"), "participant_id")
    return per.join(series.select(F.col("id").alias("event_series_id"), F.col("name").alias("event_series_name")), "event_series_id").select("participant_id", "full_name", "event_series_id", "event_series_name", *keys[2:], "last_participated_year")


def review_queue(matches: DataFrame) -> DataFrame:
    """Candidate matches that wait for a decision."""
    return matches.where("decision = 'review'").drop("decision")


def enriched(participants: DataFrame, today: Column) -> DataFrame:
    """Participants with age and whether they are minors; null without a date of birth."""
    born = F.col("date_of_birth")
    return participants.withColumns({"age_years": age(born, today), "is_minor": is_minor(born, today)})
