"""Ordered match cascades in which ambiguity is an outcome of its own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.lineage import discard, table


@dataclass(frozen=True)
class Tier:
    """A lookup: key columns of the batch, a table of (those columns, id), and what several ids mean.

    many: ``reject`` ends the cascade as ambiguous, ``least`` takes the lowest id.
    """

    name: str
    keys: tuple[str, ...]
    table: DataFrame
    id_col: str
    many: str = "reject"


def tiered_match(batch: DataFrame, tiers: Sequence[Tier]) -> DataFrame:
    """Add matched_id, match_status (matched, none, ambiguous) and match_tier.

    Each tier is one join with its keys' counts and lowest ids; a row stops at
    the first tier that knows its key. Null key parts match nothing.
    """
    status: Column | None = None
    found: list[tuple[Tier, str, str]] = []
    out = batch
    for i, t in enumerate(tiers):
        n, v = f"_n{i}", f"_v{i}"
        known = t.table.dropna(subset=list(t.keys))
        per = known.groupBy(*t.keys).agg(F.count_distinct(t.id_col).alias(n), F.min(t.id_col).alias(v))
        out = out.join(per, list(t.keys), "left")
        found.append((t, n, v))
    matched = tier = None
    for t, n, v in found:
        hit = F.col(n) >= 1
        ambiguous = (F.col(n) > 1) & F.lit(t.many == "reject")
        one = F.when(ambiguous, "ambiguous").otherwise("matched")
        value = F.when(~ambiguous, F.col(v))
        status = F.when(hit, one) if status is None else status.when(hit, one)
        matched = F.when(hit, value) if matched is None else matched.when(hit, value)
        tier = F.when(hit, t.name) if tier is None else tier.when(hit, t.name)
    if status is None:
        return batch.withColumns({"matched_id": F.lit(None).cast("string"), "match_status": F.lit("none"), "match_tier": F.lit(None).cast("string")})
    result = out.withColumns({"matched_id": matched, "match_status": status.otherwise("none"), "match_tier": tier})
    return result.select(*batch.columns, "matched_id", "match_status", "match_tier")


def with_new_ids(matched: DataFrame, kind: str, group: Column) -> DataFrame:
    """Give unmatched rows of a batch an id by ``group``, so that rows of one new entity share it."""
    from tidemark.functions.keys import entity_id

    fresh = (F.col("match_status") == "none") & group.isNotNull()
    return matched.withColumns({"entity_id": F.when(fresh, entity_id(kind, group)).otherwise(F.col("matched_id")), "is_new": fresh})


@dataclass(frozen=True)
class Lookup:
    """A tier of :func:`in_order`: look the column's value up among the keys of a space.

    many: what several entities mean, as for :class:`Tier`.
    """

    name: str
    space: str
    column: str
    many: str = "reject"


@dataclass(frozen=True)
class Offer:
    """Keys that a row gives its entity: of the column, in the space; ``always``, or only if the row founds the entity."""

    space: str
    column: str
    always: bool = False


def in_order(batch: DataFrame, seq: str, lookups: Sequence[Lookup], offers: Sequence[Offer], known: DataFrame, new_id: Column, group: str | None = None) -> DataFrame:
    """Resolve the rows of a batch as if one after another in the order of ``seq``: a row sees the entities of earlier rows.

    ``known`` has (space, key, entity). Adds entity_id, is_new, match_tier and
    match_status (matched, none, ambiguous). A row stops at the first tier whose
    key is known by then; a row that finds nothing founds ``new_id``. Ambiguous
    rows, and with ``group`` all rows of their group, have no entity and offer
    nothing. Of several known entities ``least`` takes the lowest id, of those
    founded in the batch the earliest.

    Assignments are guessed, and each round derives them anew from those of
    earlier rows. A round settles at least the first row that isn't settled, in
    practice as many rounds as the longest chain of rows that meet through
    different keys; the result is that of the loop. A key keeps its two earliest
    entities only, since a third changes nothing.
    """
    rows = batch.select(F.col(seq).cast("long").alias("_q"), new_id.alias("_own"), (F.col(group) if group else F.col(seq)).alias("_g"), *{x.column for x in (*lookups, *offers)})
    rows = table(rows, "match-rows")

    def spread(of: Sequence[Lookup] | Sequence[Offer], mark) -> DataFrame:
        parts = [F.struct(F.lit(x.space).alias("s"), F.col(x.column).cast("string").alias("k"), mark(i, x).alias("m")) for i, x in enumerate(of)]
        return rows.select("_q", F.inline(F.array(*parts))).where("k is not null")

    asks = table(spread(lookups, lambda i, x: F.lit(i)), "match-asks")
    given = table(spread(offers, lambda i, x: F.lit(x.always)).distinct(), "match-offers")
    held = known.select(F.col("space").alias("s"), F.col("key").cast("string").alias("k"), F.col("entity").alias("e"), F.lit(-1).cast("long").alias("f")).where("k is not null")
    # of what is known only keys that the batch asks for matter
    held = table(held.join(asks.select("s", "k").distinct(), ["s", "k"], "left_semi").distinct(), "match-known")
    strict = [i for i, x in enumerate(lookups) if x.many == "reject"]
    state = table(rows.select("_q", F.col("_own").alias("e"), F.lit(True).alias("new"), F.lit(None).cast("int").alias("t")), "match-state")
    while True:
        made = given.join(state.where("e is not null"), "_q").where("m or new").select("s", "k", "e", F.col("_q").alias("f"))
        pool = made.unionByName(held).groupBy("s", "k", "e").agg(F.min("f").alias("f"))
        early = pool.withColumn("r", F.row_number().over(Window.partitionBy("s", "k").orderBy("f", "e"))).where("r <= 2")
        top = early.groupBy("s", "k").agg(F.min(F.struct("f", "e")).alias("a"), F.max(F.when(F.col("r") == 2, F.col("f"))).alias("z"))
        hits = asks.join(top, ["s", "k"]).where(F.col("a.f") < F.col("_q"))
        best = hits.groupBy("_q").agg(F.min(F.struct(F.col("m").alias("t"), F.col("a.e").alias("e"), F.coalesce(F.col("z") < F.col("_q"), F.lit(False)).alias("many"))).alias("b"))
        found = rows.select("_q", "_g", "_own").join(best, "_q", "left")
        torn = F.coalesce(F.col("b.many") & F.col("b.t").isin(strict), F.lit(False))
        found = found.select("_q", "_g", "_own", "b", torn.alias("torn"))
        if group:
            bad = found.where("torn").select("_g").distinct().withColumn("bad", F.lit(True))
            found = found.join(bad, "_g", "left")
        else:
            found = found.withColumn("bad", F.col("torn"))
        out = F.coalesce(F.col("bad"), F.lit(False))
        none = F.lit(None).cast("string")
        entity = F.when(out, none).otherwise(F.coalesce("b.e", "_own"))
        fresh = found.select("_q", entity.alias("e"), (~out & F.col("b").isNull()).alias("new"), F.col("b.t").alias("t"), "torn", out.alias("bad"))
        before = state.select("_q", F.col("e").alias("_e"), F.col("new").alias("_new"))
        after = table(fresh.join(before, "_q").withColumn("moved", ~F.col("e").eqNullSafe(F.col("_e")) | (F.col("new") != F.col("_new"))).drop("_e", "_new"), "match-state")
        discard(state)
        state = after.drop("moved")
        state._tidemark_path = after._tidemark_path
        if not after.where("moved").limit(1).count():
            break
    tier = F.get(F.array(*[F.lit(x.name) for x in lookups]), F.col("t"))
    status = F.when(F.col("torn") | F.col("bad"), "ambiguous").when(F.col("new"), "none").otherwise("matched")
    result = state.select(F.col("_q").alias("_mq"), F.col("e").alias("entity_id"), F.col("new").alias("is_new"), tier.alias("match_tier"), status.alias("match_status"))
    return batch.withColumn("_mq", F.col(seq).cast("long")).join(result, "_mq").drop("_mq")


def strict_identity(batch: DataFrame, people: DataFrame, emails: DataFrame, allow_missing_name: bool = False) -> DataFrame:
    """Identity policy of the audience feed: a unique e-mail must agree with the name, and phone and address mustn't conflict.

    ``batch``: email, name_key, phone, address. ``people``: participant_id,
    name_key, phone, address. ``emails``: email, participant_id. Adds
    participant_id, reason_code and quarantined; a null id without a reason
    means a new participant.
    """
    by_email = emails.dropna(subset=["email"]).groupBy("email").agg(F.count_distinct("participant_id").alias("_ne"), F.min("participant_id").alias("_pe"))
    by_name = people.dropna(subset=["name_key"]).groupBy("name_key").agg(F.count_distinct("participant_id").alias("_nn"), F.min("participant_id").alias("_pn"))
    target = people.select(F.col("participant_id").alias("_pe"), F.col("name_key").alias("_tn"), F.col("phone").alias("_tp"), F.col("address").alias("_ta"))
    d = batch.join(by_email, "email", "left").join(target, "_pe", "left").join(by_name, "name_key", "left")
    e = F.coalesce(F.col("_ne"), F.lit(0))
    flat = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    no_name = F.col("name_key").isNull() | F.col("_tn").isNull()
    reason = (
        F.when(e > 1, "ambiguous_email_match")
        .when((e == 1) & no_name & F.lit(not allow_missing_name), "missing_name_for_email_match")
        .when((e == 1) & (F.col("name_key") != F.col("_tn")), "email_name_mismatch")
        .when((e == 1) & (F.col("phone") != F.col("_tp")), "email_phone_mismatch")
        .when((e == 1) & (flat(F.col("address")) != flat(F.col("_ta"))), "email_address_mismatch")
        .when((e == 0) & (F.col("_nn") > 1), "ambiguous_name_match")
    )
    d = d.withColumn("reason_code", reason)
    pid = F.when(F.col("reason_code").isNull(), F.when(e == 1, F.col("_pe")).otherwise(F.col("_pn")))
    quarantined = F.coalesce(F.col("reason_code") != "ambiguous_name_match", F.lit(False))
    return d.withColumns({"participant_id": pid, "quarantined": quarantined}).select(*batch.columns, "participant_id", "reason_code", "quarantined")


def provider_ids(batch: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    """Whether a provider's id may be written for (participant_id, email): ``write``, ``clear`` or ``conflict``.

    Known to another participant: a conflict. Known to the same one under
    another e-mail: the id is cleared. Otherwise it is written.
    """
    k = known.select(F.col(id_col), F.col("participant_id").alias("_p"), F.col("email").alias("_e")).where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    d = batch.join(k, id_col, "left")
    other = F.col("_p") != F.col("participant_id")
    verdict = F.when(F.col(id_col).isNull() | F.col("_p").isNull(), "write").when(other, "conflict").when(F.col("_e") != F.col("email"), "clear").otherwise("write")
    return d.withColumn("verdict", verdict).select(*batch.columns, "verdict")


def unique_link(left: DataFrame, right: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Link by the first key that names exactly one row of ``right``; several link to none. Adds ``linked_id`` and ``link_warning``."""
    out, pick, warn = left, None, None
    for i, k in enumerate(keys):
        per = right.where(F.col(k).isNotNull()).groupBy(k).agg(F.count_distinct(id_col).alias(f"_n{i}"), F.min(id_col).alias(f"_v{i}"))
        out = out.join(per, k, "left")
        one = F.col(f"_n{i}") == 1
        pick = F.when(one, F.col(f"_v{i}")) if pick is None else pick.when(one, F.col(f"_v{i}"))
        many = F.when(F.col(f"_n{i}") > 1, F.lit(f"ambiguous_{k}"))
        warn = many if warn is None else F.coalesce(warn, many)
    return out.withColumn("linked_id", pick).withColumn("link_warning", F.when(F.col("linked_id").isNull(), warn)).select(*left.columns, "linked_id", "link_warning")
