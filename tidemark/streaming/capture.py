"""Streams: idempotent raw capture, windowed counts and latest state per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.latest import best_struct


def captured(stream: DataFrame, at: str, hash_col: str = "row_hash", late: str = "1 hour") -> DataFrame:
    """Each row once, by its hash, within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([hash_col])


def windowed(stream: DataFrame, at: str, keys: list[str], size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and key; rows later than the watermark are left out."""
    out = stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def upsert_latest(stream: DataFrame, keys: list[str], fields: list[str], order: str, read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Keep the latest fields per key: each micro-batch is merged into a new version of the table.

    Batches that are replayed change nothing, since the latest row wins again.
    """

    def step(batch: DataFrame, _: int) -> None:
        new = batch.select(*keys, *fields, order)
        old = read()
        both = new if old is None else old.unionByName(new)
        write(best_struct(both, keys, [*fields, order], F.col(order)))

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
