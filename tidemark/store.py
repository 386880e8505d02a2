"""Versioned tables: each version is a folder of Parquet files, and a numbered pointer names the current ones.

A run writes new versions first and publishes them together at its end by one
rename that adds a pointer; readers take the highest number. So a failed or dry
run leaves readers where they were, and no reader ever finds the store empty.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """Tables under ``root``, any path that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pending: dict[str, str] = {}

    def _versions(self) -> list[str]:
        """Names of the pointers, the latest last."""
        p, fs = self._fs(f"{self.root}/_pointers")
        if not fs.exists(p):
            return []
        return sorted(f.getPath().getName() for f in fs.listStatus(p))

    def _pointer(self) -> dict[str, str]:
        names = self._versions()
        if not names:
            return {}
        return json.loads(self.spark.read.text(f"{self.root}/_pointers/{names[-1]}").first().value)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        return name in self._pointer()

    def read(self, name: str) -> DataFrame:
        """Current version of a table."""
        return self.spark.read.parquet(f"{self.root}/{name}/{self._pointer()[name]}")

    def stage(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a new version, unpublished, and return it as read back."""
        version = uuid.uuid4().hex
        path = f"{self.root}/{name}/{version}"
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
        self.pending[name] = version
        return self.spark.read.parquet(path)

    def unstage(self, name: str) -> None:
        """Drop a staged version."""
        version = self.pending.pop(name, None)
        if version:
            p, fs = self._fs(f"{self.root}/{name}/{version}")
            fs.delete(p, True)

    def publish(self, dry_run: bool = False) -> dict[str, str]:
        """Make all staged versions current at once; a dry run drops them."""
        staged, self.pending = self.pending, {}
        if dry_run:
            for name, version in staged.items():
                p, fs = self._fs(f"{self.root}/{name}/{version}")
                fs.delete(p, True)
            return {}
        names = self._versions()
        now = json.dumps(self._pointer() | staged)
        new = f"{self.root}/_next-{uuid.uuid4().hex}"
        self.spark.range(1).select(F.lit(now).alias("value")).coalesce(1).write.text(new)
        folder, fs = self._fs(f"{self.root}/_pointers")
        fs.mkdirs(folder)
        number = int(names[-1]) + 1 if names else 0
        target = self._fs(f"{self.root}/_pointers/{number:012d}")[0]
        # one rename makes the pointer whole; what readers saw before stays until then, and after a crash
        if fs.exists(target) or not fs.rename(self._fs(new)[0], target):
            raise RuntimeError("another run has published meanwhile")
        return staged
