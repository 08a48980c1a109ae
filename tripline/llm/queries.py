"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm import (
    audit,
    codebooks,
    decontaminate,
    embeddings,
    licenses,
    linededup,
    mixing,
    packing,
    pages,
    quality,
    shards,
    simhash,
    warc,
)
from tripline.llm.common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    places = F.transform("places", lambda p: p["place"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def embedding_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


def lines_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(_table(spark, sf_dir, "documents"))


def packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = mixing.quality_weights(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )
    mixed = mixing.mix(weighted, F.col("mix_weight"))
    return mixed.select("row.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.product_codes(_table(spark, sf_dir, "embeddings"))


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards in two regions of four racks of five."""
    found = shards.directory(_table(spark, sf_dir, "documents"), shards.uniform(2, 4, 5))
    return found.withColumn("law", F.lit("key"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": main_texts,
    "op2_packed_tokens": packed_tokens,
    "op3_license_scan": license_scan,
    "op4_warc_records": warc_records,
    "op5_decontamination": decontamination,
    "op6_source_mix": source_mix,
    "op7_simhash_components": simhash_components,
    "op8_embedding_components": embedding_components,
    "op9_quality_scores": quality_scores,
    "op10_line_dedup": lines_without_repeats,
    "op11_vector_codes": vector_codes,
    "op12_filter_audit": filter_audit,
    "op13_hash_shards": hash_shards,
}
