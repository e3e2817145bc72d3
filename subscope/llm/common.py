"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.sources.io import stage

__all__ = ["stage", "read", "shipped", "words_of", "WORD", "in_blocks", "components", "units", "forest", "frame", "sized_join", "few_rows"]

#: A word: a run of characters other than the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(WORD)
#: What str.split() also takes as white space, though a word may hold it.
_WIDER = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after this package was sent to the executors' Python (once an application)."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.basename(top)
        target = os.path.join(tempfile.mkdtemp(), f"{name}.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, files in os.walk(top):
                for f in sorted(files):
                    if f.endswith(".py"):
                        path = os.path.join(folder, f)
                        z.write(path, os.path.join(name, os.path.relpath(path, top)))
        context.addPyFile(target)
    return df


def words_of(text: str) -> list[str]:
    """The words of a text; str.split() where it means the same."""
    return _WORDS.findall(text) if _WIDER.search(text) else text.split()


def in_blocks(members: DataFrame, group: str, key: str, block: int) -> DataFrame:
    """Members of groups of any size, dealt so that tasks see pairs of blocks.

    A group of g members is cut into ceil(g / block) blocks by a hash of
    ``key``. Each unordered pair of blocks (``left_block``, ``right_block``) is
    a unit of work: every member goes to the units its block is part of, with
    its own ``block``. A group of one block is one unit, so small groups are
    not copied; large ones are spread over many tasks.
    """
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    dealt = members.join(sizes, group).withColumn(
        "n_blocks", F.ceil(F.col("group_size") / F.lit(block)).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(key), F.col("n_blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    return (dealt
            .withColumn("left_block", F.least("block", "other"))
            .withColumn("right_block", F.greatest("block", "other"))
            .drop("n_blocks", "other"))


#: Rows up to which a written table may be broadcast.
SMALL = 300_000


def sized_join(big: DataFrame, written: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a written table of narrow rows: broadcast if it was counted small, else shuffled."""
    return big.join(F.broadcast(written) if written.count() <= SMALL else written, on, how)


def few_rows(keys: DataFrame):
    """How to mark tables of one row per key: for broadcast if the keys were counted few, else not at all."""
    return F.broadcast if keys.count() <= SMALL else lambda df: df


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links ``u``-``v`` reach, for each node of an edge.

    Alternates the large-star and small-star steps until the links form stars
    around their smallest nodes. Each round is written to the shared folder, so
    lineage stays short and a lost executor costs a task; the driver sees
    whether any node is still out of place.
    """
    now = stage(
        edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
        .where("a <> b").distinct())
    while True:
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            now.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        # A star's rim has one link up and none down, its centre none up.
        if ends.where("up > 1 OR up > 0 AND down > 0").isEmpty():
            break
        both = now.union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        large = both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: neighbours below a node, and the node, go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        now = stage(
            moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct())
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def frame(rows, names):
    """A pandas frame of row tuples whose columns stay plain objects, as Arrow wants them."""
    import pandas as pd

    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names, columns)}, columns=list(names))


def units(batches, cols):
    """Runs of equal ``cols`` in sorted batches, as dicts of numpy columns; a run may span batches."""
    import numpy as np

    held = None
    for batch in batches:
        data = {c: batch[c].to_numpy() for c in batch.columns}
        if held is not None:
            data = {c: np.concatenate([held[c], v]) for c, v in data.items()}
        n = len(data[cols[0]])
        if not n:
            continue
        change = np.zeros(n - 1, dtype=bool)
        for c in cols:
            change |= data[c][1:] != data[c][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield {c: v[a:b] for c, v in data.items()}
        held = {c: v[cuts[-1]:] for c, v in data.items()}
    if held is not None:
        yield held


def forest(linked):
    """For each row of a symmetric boolean matrix, a row it hangs on: itself for the first of its component."""
    import numpy as np

    n = len(linked)
    parent = np.arange(n)
    new = np.ones(n, dtype=bool)
    for root in range(n):
        if not new[root]:
            continue
        new[root] = False
        front = [root]
        while front:
            at = front.pop()
            found = np.flatnonzero(linked[at] & new)
            parent[found] = at
            new[found] = False
            front.extend(found.tolist())
    return parent
