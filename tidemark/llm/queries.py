"""Queries that apply each operator to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, decontam, langid, licences, mixing, robust_quality, sharding, suffixtree_lm, urlfilter, wavelet
from tidemark.llm.common import fold


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learns where crc32(doc_id) mod 3 is not 1."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = langid.fit(docs, ~held_out)
    out = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model, drop=("text",))
    return out.select("doc_id", "held_out", "lang_pred", "score", "bits", "explained")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and suffix-tree score of every document; learns where crc32(doc_id) mod 5 is not 1."""
    held_out = fold(F.col("doc_id"), 5) == 1
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return suffixtree_lm.score(docs, ~F.col("held_out"), keep=("doc_id", "held_out"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op2_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether it is an outlier of its language and source."""
    return robust_quality.judge(_read(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(_read(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence that every document is, and the notices among its lines."""
    return licences.scan(_read(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urlfilter.judge(_read(spark, sf_dir, "pages"), urlfilter.train(urlfilter.labelled(spark)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows of benchmark items cover."""
    return decontam.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under weighted Jaccard similarity of five-word shingles."""
    return bagminhash.classes(_read(spark, sf_dir, "documents")).drop("_key", "_class")


def token_params() -> wavelet.TokenParams:
    import public_tokenizers

    return wavelet.TokenParams(public_tokenizers.path("word_bpe_49k.json"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as wavelet matrices and read back."""
    return wavelet.read_shards(wavelet.write_shards(_read(spark, sf_dir, "documents"), token_params()))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_language_id": op1_language_id, "op2_robust_quality": op2_robust_quality, "op3_sharding": op3_sharding, "op4_license_scan": op4_license_scan, "op5_url_filter": op5_url_filter, "op6_decontamination": op6_decontamination, "op7_lm_scoring": op7_lm_scoring, "op8_mixing": op8_mixing, "op9_near_duplicates": op9_near_duplicates, "op10_token_ids": op10_token_ids}


def oracle_sql() -> dict[str, str]:
    return {"op2_robust_quality": robust_quality.sql(), "op4_license_scan": licences.sql(), "op6_decontamination": decontam.SQL, "op8_mixing": mixing.SQL.format(docs="documents")}
