"""New versions of a table from the old one and a batch; Parquet knows no updates in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.lineage import discard, table


def first_values(batch: DataFrame, keys: Sequence[str], fields: Sequence[str], seq: str) -> DataFrame:
    """Per key the first non-null value of each field in the order of ``seq``."""
    first = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in fields]
    return batch.groupBy(*keys).agg(*first)


def fill_null_merge(old: DataFrame, batch: DataFrame, keys: Sequence[str], fields: Sequence[str], seq: str) -> DataFrame:
    """Insert new keys; for known ones fill null fields only. ``inserted`` tells them apart."""
    new = first_values(batch, keys, fields, seq)
    o, n = old.select(*keys, *fields).withColumn("_old", F.lit(True)).alias("o"), new.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    merged = o.join(n, on, "full_outer")
    return merged.select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], *[F.coalesce(f"o.{c}", f"n.{c}").alias(c) for c in fields], F.col("_old").isNull().alias("inserted"))


def insert_absent(old: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """Rows of ``batch`` to append: first of each key that ``old`` lacks. Null parts of a key equal each other."""
    marks = {f"_k{i}": F.struct(F.col(k)) for i, k in enumerate(keys)}
    new = batch.withColumns(marks)
    if seq:
        rows = F.struct(*[F.col(c) for c in batch.columns])
        new = new.groupBy(*marks).agg(F.min_by(rows, F.col(seq)).alias("_r")).select("_r.*", *marks)
    else:
        new = new.dropDuplicates(list(marks))
    return new.join(old.select(*[m.alias(name) for name, m in marks.items()]), list(marks), "left_anti").drop(*marks)


def overwrite_merge(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` replace those of ``old`` with the same key."""
    return old.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch)


def refresh_seen(old: DataFrame, batch: DataFrame, keys: Sequence[str], value: str, seen: str) -> DataFrame:
    """Cross-reference upsert: known keys keep their value and get the later ``seen``; new ones are inserted."""
    both = old.select(*keys, value, seen, F.lit(0).alias("_p")).unionByName(batch.select(*keys, value, seen, F.lit(1).alias("_p")))
    return both.groupBy(*keys).agg(F.min_by(value, F.struct("_p", value)).alias(value), F.max(seen).alias(seen))


def replace_if_newer(old: DataFrame, batch: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The row of latest ``at`` per key; an equal date keeps the old row, and of a batch's equal dates its least row."""
    both = old.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, -F.col("_new"))).alias("_r")).select(*keys, "_r.*").select(*old.columns)


def insert_unless_open(old: DataFrame, batch: DataFrame, keys: Sequence[str], end: str) -> DataFrame:
    """Rows of ``batch`` whose key has no row in ``old`` without an end."""
    return batch.dropDuplicates(list(keys)).join(old.where(F.col(end).isNull()).select(*keys), list(keys), "left_anti")


def status_precedence(df: DataFrame, keys: Sequence[str], status: str, order: Sequence[str], at: str, external_id: str, seq: str) -> DataFrame:
    """Per key the status that stands first in ``order`` (else the first seen), the earliest time and the first external id."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in order]), F.col(status)), F.lit(0))
    rank = F.when(rank == 0, len(order) + 1).otherwise(rank)
    return df.groupBy(*keys).agg(
        F.min_by(status, F.struct(rank, seq)).alias(status), F.min(at).alias(at), F.min_by(external_id, F.when(F.col(external_id).isNotNull(), F.col(seq))).alias(external_id)
    )


def remapped(df: DataFrame, mapping: DataFrame, columns: Sequence[str], old: str = "old_id", new: str = "new_id") -> DataFrame:
    """Rewrite references through an id map; ids that it doesn't hold stay, and ids mapped to null are cleared."""
    for c in columns:
        m = mapping.select(F.col(old).alias(c), F.col(new).alias("_new"), F.lit(True).alias("_hit"))
        df = df.join(m, c, "left").withColumn(c, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(c))).drop("_new", "_hit").select(*df.columns)
    return df


def closed_map(mapping: DataFrame, order: str | None = None) -> DataFrame:
    """Follow chains of an id map (old_id, new_id) to their ends; a cycle is refused.

    With ``order``, a column of the map, the result has ``path`` too: the values
    of that column from the end of a chain back to the id. Each round looks the
    map up in itself and is written and read back, so its plan stays small and
    rounds grow with the logarithm of the longest chain.
    """
    step = F.array(F.col(order)) if order else F.array().cast("array<int>")
    held = table(mapping.select("old_id", "new_id", step.alias("path")).distinct(), "id-map")
    n = held.count()
    for _ in range(n.bit_length() + 1):
        following = held.select(F.col("old_id").alias("new_id"), F.col("new_id").alias("_next"), F.col("path").alias("_rest"))
        far = held.join(following, "new_id", "left")
        path = F.concat(F.coalesce("_rest", F.array().cast(held.schema["path"].dataType)), "path")
        longer = table(far.select("old_id", F.coalesce("_next", "new_id").alias("new_id"), path.alias("path"), F.col("_next").isNotNull().alias("_more")), "id-map")
        discard(held)
        held = longer.drop("_more")
        held._tidemark_path = longer._tidemark_path
        if not longer.where("_more").limit(1).count():
            return held if order else held.drop("path")
    raise ValueError("id map holds a cycle")


def contact_key(normalized: Column, raw: Column) -> Column:
    """Key of a contact: its normal form, or its raw text where it has none."""
    return F.coalesce(F.concat(F.lit("n:"), normalized), F.concat(F.lit("r:"), raw))
