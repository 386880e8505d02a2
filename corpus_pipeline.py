"""From raw documents to token shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, decontam, langid, mixing, queries, wavelet
from tidemark.llm.common import table

#: Decisions on at most as many rows are broadcast; beyond it they are joined by a shuffle.
FEW = 1_000_000


def _text_mark(docs: DataFrame) -> DataFrame:
    """Add a hash of the text, so that rows that share an id but not a text are told apart."""
    return docs.withColumn("_mark", F.xxhash64(F.col("text"), F.lit(21)))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}._mark") == F.col(f"{b}._mark"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts of no language: null, empty and letterless ones, and those that no language explains, such as random letters.

    ``lang`` becomes the predicted language of what stays.
    """
    model = langid.fit(docs, F.lit(True))
    made = ("lang_pred", "score", "bits", "explained")
    own = {c: f"_own_{c}" for c in made if c in docs.columns}
    found = langid.identify(docs.withColumnsRenamed(own), model).where((F.col("lang_pred") != "und") & F.col("explained"))
    return found.withColumn("lang", F.col("lang_pred")).drop(*made).withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects all but one document of each class of near-duplicates."""
    return bagminhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = _text_mark(docs)
    found = decontam.decontaminate(marked.select("doc_id", "text", "_mark"), items, keep=("doc_id", "_mark"))
    leaks = table(found.where("contaminated").select("doc_id", "_mark").distinct(), "leaks")
    small = F.broadcast(leaks) if leaks.count() <= FEW else leaks
    return marked.alias("d").join(small.alias("l"), _same("d", "l"), "left_anti").drop("_mark").select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of which the mix takes less than half, and repeats others.

    A document comes as often as its taken words make it up, rounded half up;
    rows equal in id and text share what they take evenly.
    """
    marked = _text_mark(docs)
    taken = mixing.mix(marked.select("doc_id", "source", "text", "_mark"), keep=("doc_id", "source", "_mark"))
    share = taken.groupBy("doc_id", "_mark").agg(F.sum("taken").alias("_t"), F.sum("size").alias("_s"))
    copies = share.select("doc_id", "_mark", F.expr("(2 * _t + _s) div greatest(2 * _s, 1)").cast("int").alias("_copies")).where("_copies > 0")
    joined = marked.alias("d").join(copies.alias("c"), _same("d", "c")).select(*[F.col(f"d.{c}") for c in docs.columns], "_copies")
    return joined.withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects nothing: writes token shards and returns one row per document, read back from them."""
    return wavelet.read_shards(wavelet.write_shards(docs, queries.token_params()))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("token_ids", token_ids),
]

#: SQL can't express the parsing, hashing and encoding stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
