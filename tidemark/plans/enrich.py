"""Choice of candidates for the external lookup and what its answers may change."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.places import plausible_person
from tidemark.functions.text import email, phone

ANSWER = "candidate_id string, row_status string, provider_person_id string, name string, emails array<string>, phones array<string>, linkedin_url string, confidence int, n_profiles int"


def missing_filter(which: str) -> Column:
    """Candidates that lack an e-mail, a phone, either, or whatever they lack (none)."""
    mail, tel = F.col("best_email").isNull(), F.col("best_phone").isNull()
    return {"email": mail, "phone": tel, "either": mail | tel, "none": F.lit(True)}[which]


def chosen(candidates: DataFrame, lookups: DataFrame, today: Column, states: Sequence[str] = ("hold",), missing: str = "either", cooldown: int = 30, limit: int = 500, ready: DataFrame | None = None, countries: Sequence[str] = (), regions: Sequence[str] = ()) -> DataFrame:
    """Best candidates without a recent lookup: by score, update and id, the first ``limit``."""
    recent = lookups.where((F.col("created_at") > F.date_sub(today, cooldown).cast("timestamp")) & F.col("row_status").isin("matched", "no_match", "ambiguous")).select(F.col("candidate_id").alias("id"))
    rows = candidates
    tests = [F.col("resolution_state").isin(*states), ~F.coalesce("is_promoted", F.lit(False)), missing_filter(missing)]
    if ready is not None:
        rows = rows.join(ready.where("readiness_status = 'enrichment_ready'").select(F.col("candidate_id").alias("id"), "best_country_code", "best_state_region"), "id")
        tests += [F.col("best_country_code").isin(*countries)] * bool(countries) + [F.col("best_state_region").isin(*regions)] * bool(regions)
    rows = rows.where(reduce(and_, tests)).join(recent, "id", "left_anti")
    return rows.orderBy(F.desc_nulls_last("quality_score"), F.desc_nulls_last("updated_at"), F.asc("id")).limit(limit)


def mode(candidates: DataFrame) -> DataFrame:
    """How a candidate is looked up: by e-mail, not at all, or skipped for its name."""
    how = F.when(~plausible_person(F.col("display_name")), "skipped_low_name_quality").when(F.coalesce(F.col("best_email") != "", F.lit(False)), "email_lookup").otherwise("unsupported_mode")
    return candidates.withColumn("search_mode", how)


def looked_up(candidates: DataFrame, client: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """Answers of an injected client, made once per partition and asked batch by batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for frame in frames:
            yield ask(frame)

    return candidates.mapInPandas(run, ANSWER)


def null_client() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Client of a dry run: every lookup is skipped."""

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        none = [None] * len(frame)
        return pd.DataFrame({"candidate_id": frame["id"], "row_status": "skipped", "provider_person_id": none, "name": none, "emails": none, "phones": none, "linkedin_url": none, "confidence": none, "n_profiles": 0})

    return ask


class LookupClient:
    """Asks a provider over an injected ``get(path, parameters) -> (status, json)``, no faster than ``per_second``.

    A busy provider (429) is asked again after 2, 4, ... seconds, at most 64 and
    ``retries`` times; an answer that isn't ready yet is polled for until
    ``deadline`` seconds have passed.
    """

    def __init__(self, get: Callable[[str, dict], tuple[int, dict]], per_second: float = 2.0, retries: int = 3, deadline: float = 20.0, every: float = 2.0, sleep: Callable[[float], None] = time.sleep):
        self.get, self.gap, self.retries, self.deadline, self.every, self.sleep = get, 1 / max(per_second, 0.01), retries, deadline, every, sleep

    def _asked(self, path: str, parameters: dict) -> tuple[str, dict]:
        """Status (ok, rate_limited, api_error) and the answer."""
        pause = 2.0
        for k in range(self.retries + 1):
            self.sleep(self.gap)
            try:
                status, body = self.get(path, parameters)
            except OSError:
                return "api_error", {}
            if status != 429:
                return ("ok", body) if status < 400 else ("api_error", body)
            if k < self.retries:
                self.sleep(min(pause, 64.0))
                pause *= 2
        return "rate_limited", {}

    def one(self, mail: str | None) -> tuple[str, dict]:
        """Row status and body for a candidate's e-mail."""
        if not mail:
            return "skipped", {}
        status, body = self._asked("/lookup", {"email": mail})
        waited = 0.0
        while status == "ok" and body.get("status") in ("searching", "progress", "waiting"):
            if waited >= self.deadline or not body.get("id"):
                return "api_error", body
            self.sleep(self.every)
            waited += self.every
            status, body = self._asked("/status", {"id": body["id"]})
        if status != "ok" or body.get("status") in ("failed", "error", "not_found"):
            return ("api_error" if status == "ok" else status), body
        n = len(body.get("profiles") or ())
        return ("no_match" if n == 0 else "matched" if n == 1 else "ambiguous"), body

    def __call__(self, frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in frame.itertuples():
            status, body = self.one(r.best_email)
            found = body.get("profiles") or []
            p = found[0] if found else {}
            plain = lambda xs, k: [x.get(k) if isinstance(x, dict) else x for x in xs or ()]
            sure = str(p.get("confidence") or "")
            rows.append((r.id, status, str(body["id"]) if body.get("id") else None, p.get("name"), plain(p.get("emails"), "email"), plain(p.get("phones"), "number"), p.get("linkedin_url"), int(sure) if sure.isdigit() else None, len(found)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER.split(", ")]).astype({"confidence": "Int32"})


def person_links(gated_rows: DataFrame) -> DataFrame:
    """Links of candidates to the provider's person, where the answer names one."""
    ok = gated_rows.where(F.col("provider_person_id").isNotNull() & (F.col("verdict") == "applied"))
    return ok.select(F.col("id").alias("candidate_id"), F.lit("participant").alias("entity_type"), F.lit("lookup").alias("source_table"), F.col("provider_person_id").alias("source_pk"), F.lit(1).cast("decimal(5,4)").alias("link_score")).distinct()


def lookup_rows(gated_rows: DataFrame, run_id: str, at: Column) -> DataFrame:
    """Audit of a run: one row per candidate that was asked about."""
    mask = F.col("applied_field_mask") if "applied_field_mask" in gated_rows.columns else F.array().cast("array<string>")
    return gated_rows.select(F.lit(run_id).alias("run_id"), F.col("id").alias("candidate_id"), "row_status", "verdict", "provider_person_id", mask.alias("applied_field_mask"), at.alias("created_at"))


def run_row(rows: DataFrame, run_id: str, most_failures: float = 0.10) -> DataFrame:
    """One row for a run: counts by outcome, its status, and a warning if too many calls failed."""
    failed = F.count_if(F.col("row_status").isin("api_error", "rate_limited"))
    n = F.count_if(F.col("row_status") != "skipped")
    rate = F.coalesce(F.try_divide(failed, n), F.lit(0.0))
    warning = F.when(rate > most_failures, F.format_string("%d of %d calls failed", failed, n))
    return rows.agg(
        F.lit(run_id).alias("run_id"), F.count("*").alias("rows"), F.count_if(F.col("verdict") == "applied").alias("applied"), F.count_if(F.col("verdict") == "no_match").alias("no_match"), failed.alias("failed"),
        F.when(rate > most_failures, "completed_with_warnings").otherwise("completed").alias("status"), warning.alias("warning"),
    )


def profiles(body: Column) -> Column:
    """Array of (id, name, emails, phones, linkedin_url, confidence) in a provider's JSON; contacts may be texts or objects."""
    each = F.from_json(F.get_json_object(body, "$.profiles"), "array<struct<id:string,name:string,emails:array<string>,phones:array<string>,linkedin_url:string,confidence:string>>")
    plain = lambda field: lambda x: F.coalesce(F.when(x.startswith("{"), F.get_json_object(x, f"$.{field}")), x)
    return F.transform(
        F.coalesce(each, F.array().cast("array<struct<id:string,name:string,emails:array<string>,phones:array<string>,linkedin_url:string,confidence:string>>")),
        lambda p: F.struct(p["id"].alias("id"), p["name"].alias("name"), F.transform(p["emails"], plain("email")).alias("emails"), F.transform(p["phones"], plain("number")).alias("phones"), p["linkedin_url"].alias("linkedin_url"), p["confidence"].try_cast("int").alias("confidence")),
    )


def gated(candidates: DataFrame, answers: DataFrame, least: int = 50) -> DataFrame:
    """Verdict on each answer: applied, or the first gate that stops it."""
    d = candidates.join(answers.withColumnRenamed("candidate_id", "id"), "id")
    mails = F.transform(F.coalesce("emails", F.array().cast("array<string>")), email)
    conflict = F.col("best_email").isNotNull() & (F.size(mails) > 0) & ~F.array_contains(mails, F.lower("best_email"))
    verdict = (
        F.when(~F.col("row_status").isin("matched", "no_match", "ambiguous"), F.col("row_status"))
        .when(F.col("n_profiles") == 0, "no_match")
        .when(F.col("n_profiles") > 1, "ambiguous")
        .when(F.coalesce("confidence", F.lit(0)) < least, "low_confidence")
        .when(F.col("normalized_name").isNull() | conflict, "identity_conflict")
        .otherwise("applied")
    )
    return d.withColumn("verdict", verdict)


def applied(gated_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates' filled best e-mail and phone with the mask of filled fields, and new contact rows."""
    ok = gated_rows.where("verdict = 'applied'")
    mails = F.filter(F.transform("emails", email), lambda x: x.isNotNull())
    phones = F.filter(F.transform("phones", phone), lambda x: x.isNotNull())
    ok = ok.withColumns({"_m": F.coalesce(mails, F.array().cast("array<string>")), "_p": F.coalesce(phones, F.array().cast("array<string>"))})
    filled = ok.select("id", F.coalesce("best_email", F.get("_m", F.lit(0))).alias("best_email"), F.coalesce("best_phone", F.get("_p", F.lit(0))).alias("best_phone"),
        F.array_compact(F.array(F.when(F.col("best_email").isNull() & (F.size("_m") > 0), "best_email"), F.when(F.col("best_phone").isNull() & (F.size("_p") > 0), "best_phone"))).alias("applied_field_mask"))
    tag = lambda kind, c: F.transform(c, lambda x: F.struct(F.lit(kind).alias("contact_type"), x.alias("normalized_value")))
    social = F.when(F.col("linkedin_url").isNotNull(), F.array(F.struct(F.lit("social").alias("contact_type"), F.col("linkedin_url").alias("normalized_value")))).otherwise(F.array().cast("array<struct<contact_type:string,normalized_value:string>>"))
    contacts = ok.select(F.col("id").alias("candidate_id"), F.explode(F.concat(tag("email", F.col("_m")), tag("phone", F.col("_p")), social)).alias("c")).select("candidate_id", "c.*").distinct()
    return filled, contacts
