"""Integrity rules as queries for the rows that break them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once; null parts equal each other. ``where`` makes it a partial key."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a check is false; unknown passes, as in SQL."""
    return df.where(~F.coalesce(rule, F.lit(True)))


def exactly_one(*columns: str) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0)) == 1


def ordered(low: str, high: str, strict: bool = False) -> Column:
    return F.col(low) < F.col(high) if strict else F.col(low) <= F.col(high)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows that refer to a missing parent; null refers to none."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")


def promoted_rule() -> Column:
    """A promoted candidate has a canonical id and the state auto_promote."""
    return ~F.col("is_promoted") | (F.col("promoted_canonical_id").isNotNull() & (F.col("resolution_state") == "auto_promote"))


def bad_transitions(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Candidates that left auto_promote while promoted, or went from reject to auto_promote unpromoted."""
    o = old.select(key, F.col("resolution_state").alias("old_state"), F.col("is_promoted").alias("was_promoted"))
    n = new.select(key, F.col("resolution_state").alias("new_state"), F.col("is_promoted"))
    left = F.col("was_promoted") & F.col("is_promoted") & (F.col("old_state") == "auto_promote") & (F.col("new_state") != "auto_promote")
    jumped = (F.col("old_state") == "reject") & (F.col("new_state") == "auto_promote") & ~F.col("is_promoted")
    return o.join(n, key).where(left | jumped)


def touched(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str], at: Column) -> DataFrame:
    """``new`` with updated_at set to ``at`` where a field changed or the row is new."""
    o = old.select(F.col(key), *[F.col(f).alias(f"_o_{f}") for f in fields], F.col("updated_at").alias("_o_at"), F.lit(True).alias("_known"))
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_o_{f}"))
    return new.drop("updated_at").join(o, key, "left").withColumn("updated_at", F.when(F.col("_known") & same, F.col("_o_at")).otherwise(at)).select(*[c for c in new.columns if c != "updated_at"], "updated_at")
