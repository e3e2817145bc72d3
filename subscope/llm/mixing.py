"""Mixing sources to target weights by Pareto order sampling.

A source's target says how many words of it the mix should hold. Every document
of the source first gets the whole copies that are certain, floor(target /
source size). The remainder is a sample without replacement. A document's
inclusion probability p is the smaller of 1 and a constant times its ``odds``, the
constant such that the expected words are the remainder. Documents with p = 1 are
taken; the others are ranked by (u / (1 - u)) / (p / (1 - p)) with u a hash of the
id, and taken in that order. A document that no longer fits is passed over and the
ranking goes on until nothing of the source fits. The sample depends on ids and
sizes alone: reruns agree.

No source is sorted: words are summed by cells of the logarithm of the rank
value, a window runs over a source's cells, and only the documents of the cell
in which the remainder ends are ordered. A round keeps only documents that still
fit and rank beyond the one passed over, so the rounds shrink quickly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, few_rows, stage


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
            max_copies: int = 3) -> DataFrame:
    """source, source_size, weight, target from source, source_size.

    Sources in code point order, null last, get the weights in turn and share
    the sum of all sizes by weight; a share stops at ``max_copies`` times the
    source's size and the excess is shared again until none is above. One row
    per source: the windows here run over that small table.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))).cast("int")
    known = sources.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double")
    ).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    whole = Window.partitionBy()
    first = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
                           ).rowsBetween(Window.unboundedPreceding, -1)
    known = (
        known
        .withColumn("left_size", F.sum(F.col("source_size").cast("double")).over(whole)
                    - F.coalesce(F.sum("cap").over(first), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(whole)
                    - F.coalesce(F.sum("weight").over(first), F.lit(0.0)))
        # Sources are capped in this order, so the capped ones come first.
        .withColumn("capped", F.col("cap") * F.col("left_weight")
                    <= F.col("weight") * F.col("left_size")))
    rest = F.min(F.when(~F.col("capped"), F.struct((-F.col("left_weight")).alias("minus"), "left_size"))).over(whole)
    return known.select(
        "source", "source_size", "weight",
        F.when(F.col("capped"), F.col("cap"))
        .otherwise(F.col("weight") * rest["left_size"] / -rest["minus"]).alias("target"))


def _uniform(key: Column, seed: str) -> Column:
    """52 bits of the key's hash, strictly between 0 and 1; the same in any engine."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)


def _scale(rows: DataFrame, goal: DataFrame, narrow: Callable) -> DataFrame:
    """scale_source, room, mass: a document is certain where odds * room >= mass, else p = odds * room / mass.

    ``room`` is the remainder without the certain documents, ``mass`` the sum of
    size * odds of the others. Leaving out certain documents raises the constant and
    may make more of them certain, until none is added; the driver sees their number.
    """
    per_source = rows.where("odds IS NOT NULL").groupBy(F.col("source").alias("scale_source"))
    weight = F.col("size") * F.col("odds")
    now = stage(goal.select(F.col("source").alias("goal_source"), F.col("rest").cast("double").alias("rest")).join(
        per_source.agg(F.sum(weight).alias("mass")), F.col("goal_source").eqNullSafe(F.col("scale_source"))).select(
        "scale_source", "rest", F.col("rest").alias("room"), "mass", F.lit(0).cast("long").alias("certain")))
    count = 0
    while True:
        sure = F.col("odds") * F.col("room") >= F.col("mass")
        now = stage(rows.where("odds IS NOT NULL").join(
            narrow(now), F.col("source").eqNullSafe(F.col("scale_source"))).groupBy("scale_source").agg(
            F.first("rest").alias("rest"),
            (F.first("rest") - F.sum(F.when(sure, F.col("size")).otherwise(0))).alias("room"),
            F.sum(F.when(sure, F.lit(0.0)).otherwise(weight)).alias("mass"),
            F.sum(sure.cast("long")).alias("certain")))
        grown = now.agg(F.sum("certain")).first()[0] or 0
        if grown <= count:
            return now.select("scale_source", "room", "mass")
        count = grown


def _take_round(rows: DataFrame, rooms: DataFrame, narrow: Callable) -> DataFrame:
    """``rows`` with ``fits`` and ``sampled``; ``rooms``: room_source, room, n_docs."""
    # One row for each source: broadcast where the caller counted few of them.
    rows = rows.join(narrow(rooms), F.col("source").eqNullSafe(F.col("room_source"))).drop("room_source")
    rows = rows.withColumn("fits", F.col("size") <= F.col("room"))
    fine = F.ceil(F.col("n_docs") / 1e6) * 64
    rows = rows.withColumn("cell", F.when(
        F.col("fits"), F.floor(F.log2(F.greatest(F.col("rank_value"), F.lit(1e-300))) * fine)))
    cells = rows.where("fits").groupBy("source", "cell").agg(
        F.sum("size").alias("words"), F.first("room").alias("room"))
    upto = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("upto", F.sum("words").over(upto)).where("upto > room")
    ends = cells.groupBy(F.col("source").alias("end_source")).agg(
        F.min(F.struct("cell", (F.col("upto") - F.col("words")).alias("before"))).alias("end"))
    rows = rows.join(narrow(ends), F.col("source").eqNullSafe(F.col("end_source")), "left")
    at_end = F.coalesce(F.col("cell") == F.col("end.cell"), F.lit(False))
    keep = ("doc_id", "source", "size", "p", "rank_value", "fits", "sampled")
    sure = rows.where(~at_end).withColumn(
        "sampled", F.col("fits") & (F.col("end").isNull() | (F.col("cell") < F.col("end.cell"))))
    order = Window.partitionBy("source").orderBy("rank_value", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    cut = rows.where(at_end).withColumn(
        "sampled", F.col("end.before") + F.sum("size").over(order) <= F.col("room"))
    return stage(sure.select(*keep).union(cut.select(*keep)))


def _fill(ranked: DataFrame, goal: DataFrame, narrow: Callable) -> DataFrame:
    """``ranked`` with ``sampled``: rounds until no document that is left fits its source's room.

    A source's room halves or so with each round, so there are about as many rounds
    as the logarithm of its longest document; each reads what is still open.
    """
    open_rows = ranked.where("rank_value IS NOT NULL")
    parts = [ranked.where("rank_value IS NULL").withColumn("sampled", F.lit(False))]
    rooms = goal.select(F.col("source").alias("room_source"), F.col("rest").alias("room"), "n_docs")
    while True:
        tried = _take_round(open_rows, rooms, narrow)
        parts.append(tried.where("sampled OR NOT fits").drop("fits"))
        open_rows = tried.where("fits AND NOT sampled").drop("fits", "sampled")
        if open_rows.isEmpty():
            break
        done = tried.where("sampled").groupBy(F.col("source").alias("done_source")).agg(F.sum("size").alias("done"))
        rooms = stage(rooms.join(done, F.col("room_source").eqNullSafe(F.col("done_source")), "left").select(
            "room_source", (F.col("room") - F.coalesce("done", F.lit(0))).alias("room"), "n_docs"))
    return reduce(DataFrame.unionByName, parts)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """doc_id, source, size: the words of each document (null: 0)."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       size.alias("size"))


def mix(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3,
        odds: Column | None = None, seed: str = "mix:") -> DataFrame:
    """doc_id, source, size, source_size, target, expected, copies, taken of doc_id, source, size.

    ``odds``: what inclusion probabilities are proportional to, over these columns;
    the size by default. ``expected``: whole copies plus the inclusion probability,
    by which a document's copies estimate totals over its source. Null ids share one
    hash value; rows that tie are taken by id, then size. Documents without words or
    odds and sources without words are never sampled; without words the target is 0.
    Every row gives one row, none an empty table; other columns of the input are not read.
    """
    odds = F.col("size").cast("double") if odds is None else odds.cast("double")
    rows = stage(sizes.select(
        "doc_id", "source", "size", F.when((odds > 0) & (F.col("size") > 0), odds).alias("odds")))
    per_source = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    goal = targets(per_source, weights, max_copies)
    goal = goal.join(per_source.select(F.col("source").alias("s"), "n_docs"),
                     F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goal = stage(goal.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(0)).cast("long")).withColumn(
        "rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")))
    narrow = few_rows(goal)
    scale = _scale(rows, goal, narrow)
    u, p = _uniform(F.col("doc_id"), seed), F.col("p")
    ranked = stage(rows.join(narrow(scale), F.col("source").eqNullSafe(F.col("scale_source")), "left").select(
        "doc_id", "source", "size",
        F.when(F.col("odds") * F.col("room") >= F.col("mass"), F.lit(1.0))
        .when(F.col("odds").isNotNull(), F.col("odds") * F.col("room") / F.col("mass")).otherwise(F.lit(0.0)).alias("p"),
    ).select("*", F.when(p > 0, u / (1 - u) * ((1 - p) / p)).alias("rank_value")))
    goal = goal.select(F.col("source").alias("goal_source"), "rest", "n_docs", "source_size", "target", "whole")
    rows = _fill(ranked, goal.withColumnRenamed("goal_source", "source"), narrow)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("sampled").cast("long")).otherwise(F.lit(0).cast("long"))
    return rows.join(narrow(goal), F.col("source").eqNullSafe(F.col("goal_source"))).select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("whole") + F.col("p")).otherwise(F.lit(0.0)).alias("expected"),
        copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def oracle(docs: str, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3,
           seed: str = "mix:") -> str:
    """The same mix in SQL over a relation with doc_id, source and text."""
    turn = " ".join(f"WHEN {k} THEN {float(w)}" for k, w in enumerate(weights))
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('{seed}' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM {docs}),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
turns AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {turn} END::DOUBLE AS weight,
         source_size * {float(max_copies)}::DOUBLE AS cap FROM sums),
caps AS (
  SELECT *, sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER before, 0) AS left_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM turns
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
told AS (SELECT *, cap * left_weight <= weight * left_size AS capped FROM caps),
open AS (SELECT left_size, left_weight FROM told WHERE NOT capped ORDER BY left_weight DESC LIMIT 1),
goal AS (
  SELECT source, source_size, CASE WHEN capped THEN cap
         ELSE weight * (SELECT left_size FROM open) / (SELECT left_weight FROM open) END AS target FROM told),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goal),
rows_of AS MATERIALIZED (
  SELECT row_number() OVER () AS n, d.*, d.size::DOUBLE AS odds, p.source_size, p.target, p.whole,
         floor(target - whole * p.source_size)::BIGINT AS rest
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
steps AS (
  SELECT source, odds, sum(size)::DOUBLE AS words, sum(size * odds) AS mass, any_value(rest)::DOUBLE AS rest
  FROM rows_of WHERE size > 0 GROUP BY source, odds),
marks AS (
  SELECT *, odds * (rest - (sum(words) OVER (PARTITION BY source ORDER BY odds DESC) - words))
            >= sum(mass) OVER (PARTITION BY source ORDER BY odds) AS certain FROM steps),
scale AS (
  SELECT source, any_value(rest) - coalesce(sum(words) FILTER (certain), 0) AS room,
         coalesce(sum(mass) FILTER (NOT certain), 0) AS mass
  FROM marks GROUP BY source),
chances AS (
  SELECT r.*, CASE WHEN odds * room >= mass THEN 1::DOUBLE ELSE odds * room / mass END AS p
  FROM rows_of r JOIN scale s ON r.source IS NOT DISTINCT FROM s.source WHERE size > 0),
fill AS (
  SELECT n, doc_id, source, size, u / (1 - u) * ((1 - p) / p) AS q, rest AS room, FALSE AS got FROM chances WHERE p > 0
  UNION ALL
  SELECT n, doc_id, source, size, q,
         (room - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source))::BIGINT, fits
  FROM (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id NULLS FIRST, size, n) <= room AS fits
        FROM fill WHERE NOT got AND size <= room) tried)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size > 0 THEN whole + (n IN (SELECT n FROM fill WHERE got))::BIGINT ELSE 0 END * size)::BIGINT AS taken
FROM rows_of"""
