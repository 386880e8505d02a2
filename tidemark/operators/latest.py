"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``; Spark limits groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def best_struct(df: DataFrame, keys: Sequence[str], fields: Sequence[str], rank: Column, largest: bool = True) -> DataFrame:
    """Fields of the row with the largest (or least) ``rank``, by aggregation, so that hot keys are combined early.

    ``rank`` must tell rows apart; null ranks come last.
    """
    pick = F.max_by if largest else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*fields), rank).alias("_b")).select(*keys, "_b.*")


def first_wins(df: DataFrame, key: str, order: str, reason: str = "duplicate_key") -> DataFrame:
    """Add ``reject_reason``: rows whose key came up earlier in ``order`` are rejected; null keys never collide."""
    seen = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("reject_reason", F.when(F.col(key).isNotNull() & (seen > 1), F.lit(reason)))


def unique_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per non-null key: how many distinct values it has, and the value if there is just one."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias("n"), F.min(value).alias("_v"))
    return per.select(key, "n", F.when(F.col("n") == 1, F.col("_v")).alias(value))


def winners(df: DataFrame, key: str, order: Sequence[Column], id_col: str, lists: Sequence[str] = ()) -> DataFrame:
    """Winner of each key, with ``contributing_ids`` of all its rows in winning order and the union of list columns."""
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w))
    every = ranked.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(id_col).alias("id")))), lambda x: x["id"]).alias("contributing_ids"),
        *[F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(c).alias("v")))), lambda x: x["v"]))).alias(c) for c in lists],
    )
    return ranked.where("_rn = 1").drop("_rn", *lists).join(every, key)
