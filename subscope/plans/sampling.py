"""Repeatable samples and splits by a hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import col
from ..sources.io import stage


def key_hash(key, seed: int) -> Column:
    """Hex digest of seed and key: the same in every run and on every cluster."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), col(key).cast("string")))


def sample_users(df: DataFrame, user: str, frac: float, seed: int) -> DataFrame:
    """All rows of a repeatable share of the users: a row filter, no shuffle."""
    limit = f"{int(frac * 0x1_0000_0000):08x}"
    return df.where(F.substring(key_hash(user, seed), 1, 8) < limit)


def stratified_split(
    df: DataFrame, label: str, key: str, frac: float, seed: int, name: str = "part"
) -> DataFrame:
    """Mark exactly floor(frac x n) rows of every class as ``train``, the rest ``test``.

    Rows fall into hash ranges, which are counted first: a class's whole ranges up to its cut are
    train, those after it test, and only the rows of the range that holds the cut are numbered. The
    classes, a row each, are broadcast, so no task holds a class. Classes are few; ``df`` is staged.
    """
    rows = stage(df, compression="zstd").withColumn("__h", key_hash(key, seed)).withColumn(
        "__at", F.struct(F.col(label).alias("label"))).withColumn("__range", F.coalesce(F.substring("__h", 1, 3), F.lit("")))
    ranges = rows.groupBy("__at", "__range").agg(F.count(F.lit(1)).alias("__n"))
    along = W.partitionBy("__at").orderBy("__range")
    ranges = ranges.withColumns({
        "__before": F.sum("__n").over(along) - F.col("__n"),
        "__train": F.floor(F.sum("__n").over(W.partitionBy("__at")) * F.lit(frac))})
    # The range in which the cut falls, or after all ranges.
    inside = F.col("__before") + F.col("__n") > F.col("__train")
    cuts = ranges.groupBy(F.col("__at").alias("__class")).agg(
        F.min(F.when(inside, F.col("__range"))).alias("__cut"),
        F.min(F.when(inside, F.struct("__range", (F.col("__train") - F.col("__before")).alias("left")))).alias("__left"))
    cuts = cuts.select("__class", "__cut", F.col("__left.left").alias("__left"))
    told = rows.join(F.broadcast(cuts), rows["__at"] == cuts["__class"])
    here = F.col("__range").eqNullSafe(F.col("__cut"))
    number = F.row_number().over(W.partitionBy("__at").orderBy("__h", key))
    split = told.where(here).withColumn(name, F.when(number <= F.col("__left"), "train").otherwise("test"))
    whole = told.where(~here).withColumn(
        name, F.when(F.col("__cut").isNull() | (F.col("__range") < F.col("__cut")), "train").otherwise("test"))
    # A column of the mark's name gives way to it, as it did in withColumn.
    return split.select(*_columns(df, name)).union(whole.select(*_columns(df, name)))


def _columns(df: DataFrame, name: str) -> list[str]:
    """The columns of ``df`` with ``name`` in its place, or last."""
    return df.columns if name in df.columns else [*df.columns, name]
