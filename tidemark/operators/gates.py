"""Row validation, rejects, counters and run gates."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A run must not be published."""


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Refuse a feed that lacks columns, before anything is written."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise GateError(f"missing columns: {', '.join(missing)}")
    return df


def with_reason(df: DataFrame, rules: Sequence[tuple[Column, str | Column]]) -> DataFrame:
    """Add ``reject_reason``: that of the first rule whose condition holds, else null."""
    checks = [F.when(bad, F.lit(reason) if isinstance(reason, str) else reason) for bad, reason in rules]
    return df.withColumn("reject_reason", F.coalesce(*checks) if checks else F.lit(None).cast("string"))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the reason, and rejects with it."""
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason"), df.where(F.col("reject_reason").isNotNull())


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: rows_read and how often each condition holds."""
    return df.agg(F.count("*").alias("rows_read"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def rate_gate(df: DataFrame, bad: Column, limit: float, name: str) -> DataFrame:
    """Raise if the share of bad rows is above ``limit``; an empty input passes."""
    n, k = df.agg(F.count("*"), F.count_if(bad)).first()
    if n and k / n > limit:
        raise GateError(f"{name}: {k} of {n} rows, more than {limit:.2%}")
    return df


def warnings(rows: DataFrame, when: Column, said: Column, order: str, limit: int = 50) -> DataFrame:
    """The first warnings of a run, in order."""
    return rows.where(when).select(F.col(order).alias("seq"), said.alias("warning")).orderBy("seq").limit(limit)


def write_rejects(rows: DataFrame, path: str) -> None:
    """Rejected rows as CSV: their own columns as text, then the reason; nothing is written without rejects."""
    own = [c for c in rows.columns if not c.startswith("_") and c != "reject_reason"]
    out = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in own], F.col("reject_reason").alias("_reject_reason"))
    if out.limit(1).count():
        out.coalesce(1).write.option("header", True).option("escape", '"').mode("overwrite").csv(path)


def report(run_id: str, mode: str, started: str, ended: str, dry_run: bool, values: dict) -> str:
    """Run report as JSON."""
    return json.dumps({"run_id": run_id, "mode": mode, "started_at": started, "ended_at": ended, "dry_run": dry_run, "counters": values}, sort_keys=True, default=str)


def text_report(title: str, values: dict) -> str:
    width = max([len(k) for k in values], default=0)
    return "\n".join([title, "=" * len(title), *[f"{k:<{width}}  {v}" for k, v in values.items()]])
