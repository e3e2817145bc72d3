"""A training corpus out of ``documents`` in stages, each a table written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subscope.llm import stages
from subscope.llm.common import read, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("line_crf_quality", stages.quality),
    ("lsh_forest_near_duplicates", stages.near_duplicates),
    ("semi_markov_personal_data", stages.personal),
    ("pareto_mix", stages.mix),
    ("power_of_two_packing", stages.pack),
]

#: Fitted fields, signatures and token ids have no SQL; tests hold the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
