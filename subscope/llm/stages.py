"""The stages of the corpus pipeline: (spark, docs, sf_dir) to a table.

All but the last return the columns of ``docs``; columns beyond id, text, source
and n_chars pass through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_quality, mixing, packing, personal_data, shingle_join
from .common import read, shipped, sized_join, stage
from .queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Documents that the line field does not reject, unchanged. Texts without a line get the usual share of good ones."""
    score = line_quality.scorer(line_quality.train(docs, read(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) >= threshold)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, unchanged. Texts without words all stay."""
    return shingle_join.kept_once(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data masked and n_chars counted again. Null texts stay null."""
    mask = personal_data.masker(personal_data.train(docs))
    return shipped(docs).withColumn("text", mask("text")).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Documents as often as the mix takes them. Texts without words are never taken."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                      F.xxhash64("source", "text").cast("string"))
    sizes = mixing.sized(docs.select(key.alias("doc_id"), "text", "source"))
    plan = mixing.mix(sizes, weights).groupBy(F.col("doc_id").alias("__mix_key")).agg(
        F.sum("copies").cast("int").alias("__mix_copies"), F.count(F.lit(1)).alias("__mix_rows"))
    plan = stage(plan.where("__mix_copies > 0"))
    taken = sized_join(docs, plan, key == F.col("__mix_key"))
    # Repeated rows share a key and the copies of all of them.
    once = taken.where("__mix_rows = 1").unionByName(taken.where("__mix_rows > 1").dropDuplicates(["__mix_key"]))
    return once.withColumn("__mix_key", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).drop(
        "__mix_key", "__mix_copies", "__mix_rows")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of every document, sequence by sequence."""
    return packing.pack(docs, vocabulary())
