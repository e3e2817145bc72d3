"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    captures, centroids, hash_tree, line_quality, main_text, mixing, neighbour_graph, packing, personal_data,
    quality_rules, shingle_join, square_catchers, temporal_lists)
from .common import read


def vocabulary() -> str:
    """Where the public vocabulary of op5 lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(mixing.sized(read(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_neighbour_descent_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_two_level_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    records = captures.archive(pages).captures(pages)
    return records.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes",
        # Of what was read back; a revisit holds no payload, its header names the digest.
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op4_temporal_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    entries = temporal_lists.intervals(temporal_lists.list_events(pages))
    return temporal_lists.judge(temporal_lists.capture_days(pages), entries)


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(read(spark, sf_dir, "documents"), vocabulary()))


def op6_semi_markov_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(personal_data.counted(F.col("base"), k).alias(f"n_{k}") for k in personal_data.KINDS),
        F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_robust_outlier_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", *(F.col(f"stats.{c}") for c in
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed", "kept", "distance")


def op9_host_suffix_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars", "has_article", "n_boilerplate")


def op10_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join(read(spark, sf_dir, "documents"))


def op11_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.manifest(read(spark, sf_dir, "documents"), hash_tree.founded())


def op12_square_catcher_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = square_catchers.detect(read(spark, sf_dir, "documents"), rewrite=square_catchers.planted)
    return square_catchers.digest(found)


def op13_native_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pareto_mix, op2_neighbour_descent_near_dedup, op3_two_level_capture_index, op4_temporal_list_join, op5_power_of_two_packing, op6_semi_markov_personal_data, op7_line_crf_quality,
        op8_robust_outlier_rules, op9_host_suffix_array_text,
        op10_lsh_forest_join, op11_hash_tree_shards, op12_square_catcher_runs, op13_native_centroids)}

ORACLE: dict[str, str] = {
    "op1_pareto_mix": mixing.oracle("documents"),
    "op3_two_level_capture_index": captures.ORACLE,
    "op4_temporal_list_join": temporal_lists.ORACLE,
    "op11_hash_tree_shards": hash_tree.oracle(hash_tree.founded()),
}
