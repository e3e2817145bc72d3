"""A key with a third of all rows, with runtime splitting off."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from subscope.operators import groups as g
from subscope.operators import skew


@pytest.fixture
def no_splitting(spark):
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def rows(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 4001)
    return spark.range(0, 60_000, 1, 16).select(hot.alias("k"), (F.col("id") % 11).alias("v"), F.lit("x").alias("other"))


def test_equal_to_the_plain_join(rows):
    stats = {"n": F.count(F.lit(1)), "top": F.max("v")}
    for by in (["k"], ["k", "other"]):
        plain = g.with_group_stat(rows, by, stats)
        spread = skew.with_spread_group_stat(rows, by, stats, 16)
        assert spread.columns == plain.columns
        assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))
    none = skew.with_spread_group_stat(rows.limit(0), ["k"], stats, 16)
    assert none.count() == 0 and none.columns == [*rows.columns, "n", "top"]


def test_the_sketch_misses_no_frequent_key(rows):
    found = [r["__key"]["k0"] for r in skew.frequent_keys(rows, ["k"], 16).collect()]
    assert 7 in found and len(found) <= 32


def test_no_task_gets_a_heavy_key(rows, no_splitting):
    def loads(df):
        return {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}

    stats = {"n": F.count(F.lit(1))}
    plain = sorted(loads(g.with_group_stat(rows, ["k"], stats)).values())
    assert plain[-1] > 5 * median(plain)
    # Frequent rows stay in their 16 input partitions, the rest comes in 16 shuffled ones.
    spread = loads(skew.with_spread_group_stat(rows, ["k"], stats))
    assert sum(spread.values()) == 60_000
    for side in (range(16), range(16, 32)):
        held = [spread.get(p, 0) for p in side]
        assert max(held) <= 2 * median(held)
