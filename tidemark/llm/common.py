"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space that separates words in most contracts.
SPACE = r"[\x20\x09-\x0D]+"
#: Upper bound of one Arrow batch; long texts then cannot pile up in a worker.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    and driver and executors are one process (tests, a laptop) a temporary
    folder of this machine is made once.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    jsc = sc._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return jsc.getCheckpointDir().get().rstrip("/")


def table(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back; the driver's end deletes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p, fs = _place(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def _place(spark: SparkSession, path: str):
    """Path and file system as Hadoop knows them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(df: DataFrame | None) -> None:
    """Delete a table made by :func:`table` once nothing reads it any more."""
    path = getattr(df, "_tidemark_path", None)
    if path:
        p, fs = _place(df.sparkSession, path)
        fs.delete(p, True)


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Limit Arrow batches by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    plain = F.length(c) == F.octet_length(c)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def space_words(c: Column) -> Column:
    """Array of maximal runs of characters other than ASCII white space; null gives none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE), "")


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id falls in fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % n, F.lit(0))


def map_append(
    df: DataFrame,
    run: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    fields: Sequence[T.StructField],
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add the columns that ``run`` makes of each Arrow batch.

    Columns of ``df`` that carry the name of an added one are replaced.
    """
    bound_batches(df.sparkSession)
    added = {f.name for f in fields}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name not in added and f.name not in drop]
    schema = T.StructType([df.schema.fields[i] for i in kept] + list(fields))
    names = [f.name for f in schema.fields]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = list(run(batch))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + new, names=names)

    return df.mapInArrow(apply, schema)


def running(sums: DataFrame, groups: Sequence[str], at: str, value: str, name: str, width: int = 4096) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of a group whose ``at``, a whole number from 0, is less.

    ``at`` is unique in a group. Runs of ``width`` numbers are summed first, so a
    task sorts at most ``width`` rows, or one row per run.
    """
    zero = F.lit(0).cast("long")
    runs = sums.withColumn("_run", F.floor(F.col(at) / width))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    outer = runs.groupBy(*groups, "_run").agg(F.sum(value).alias("_all"))
    outer = outer.select(*groups, "_run", F.coalesce(F.sum("_all").over(ahead(Window.partitionBy(*groups).orderBy("_run"))), zero).alias("_outer"))
    inner = F.coalesce(F.sum(value).over(ahead(Window.partitionBy(*groups, "_run").orderBy(at))), zero)
    return runs.join(outer, [*groups, "_run"]).withColumn(name, F.col("_outer") + inner).drop("_run", "_outer")


def split_join(big: DataFrame, keyed: DataFrame, key: str, weight: str, many: int) -> DataFrame:
    """Inner equi-join on ``key`` where a key may hold a third of ``big``'s rows.

    ``keyed`` has one row per key and ``weight``, the number of rows of the key
    in ``big`` at least. Rows of ``keyed`` heavier than ``many`` are broadcast, of
    which there are at most the sum of weights / ``many``; the others are shuffled.
    """
    heavy, light = keyed.where(F.col(weight) > many), keyed.where(F.col(weight) <= many)
    rest = big.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return big.join(F.broadcast(heavy), key).unionByName(rest)


def salted_join(big: DataFrame, keyed: DataFrame, key: str, weight: str, per: int, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` where a key may hold a third of ``big``'s rows.

    ``keyed`` has one row per key and ``weight``, the number of rows of the key
    in ``big``. Keys heavier than ``per`` rows are cut in ``ceil(weight / per)``
    salts, at most 4096: only their row of ``keyed`` is repeated, and rows of
    ``big`` pick a salt by a hash, so no task gets much more than ``per`` rows
    of a key. ``big`` needs the column ``_pick`` (any well spread long) and
    ``weight`` itself.
    """
    parts = lambda c: F.least(F.lit(4096), F.greatest(F.lit(1), F.ceil(c / per))).cast("int")
    many = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts(F.col(weight)) - 1))).drop(weight)
    one = big.withColumn("_salt", F.pmod(F.col("_pick"), parts(F.col(weight))).cast("int"))
    return one.join(many, [key, "_salt"], how).drop("_salt")
