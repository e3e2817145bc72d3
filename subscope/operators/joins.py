"""Membership, misses, identity resolution and as-of matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .groups import key_of

#: Numbers in one slot of a key in :func:`next_term`.
SPAN = 1024


def _keys_only(df: DataFrame, keys: Sequence[str], other: DataFrame, other_keys) -> DataFrame:
    """The other side's distinct keys, in this side's types."""
    types = dict(df.dtypes)
    cast = [F.col(o).try_cast(types[c]) if dict(other.dtypes)[o] != types[c] else F.col(o)
            for c, o in zip(keys, other_keys or keys)]
    lost = [c.isNull() & F.col(o).isNotNull() for c, o in zip(cast, other_keys or keys)]
    kept = other
    for x in lost:  # a value this side's type cannot hold matches nothing
        kept = kept.where(~x)
    return kept.select(key_of(cast).alias("__key")).distinct()


def semi_in(df: DataFrame, keys: Sequence[str], other: DataFrame, other_keys=None) -> DataFrame:
    """Rows whose key occurs in ``other``; a null key matches a null key."""
    ref = _keys_only(df, keys, other, other_keys)
    return df.join(ref, key_of([df[c] for c in keys]) == ref["__key"], "left_semi")


def anti_on(df: DataFrame, keys: Sequence[str], other: DataFrame, other_keys=None) -> DataFrame:
    """Rows whose key does not occur in ``other``; nulls compare as equal.

    Unlike ``NOT IN``, a null on the other side does not empty the result.
    """
    ref = _keys_only(df, keys, other, other_keys)
    return df.join(ref, key_of([df[c] for c in keys]) == ref["__key"], "left_anti")


def missing_on_either(
    df: DataFrame, ref: DataFrame, k1: tuple[str, str], k2: tuple[str, str]
) -> DataFrame:
    """Rows for which key 1 or key 2 is absent from ``ref`` (each tested on its own)."""
    one = ref.select(F.col(k1[1]).alias("__r1")).distinct().withColumn("__in1", F.lit(True))
    two = ref.select(F.col(k2[1]).alias("__r2")).distinct().withColumn("__in2", F.lit(True))
    out = df.join(one, df[k1[0]].eqNullSafe(one["__r1"]), "left")
    out = out.join(two, out[k2[0]].eqNullSafe(two["__r2"]), "left")
    return out.where("__in1 is null or __in2 is null").drop("__r1", "__r2", "__in1", "__in2")


def lookup(
    df: DataFrame, table: DataFrame, on: tuple[str, str], take: Sequence[str], how: str = "left"
) -> DataFrame:
    """Add columns of a code table; several matches give several rows.

    Whether the code table is broadcast is left to its measured size.
    """
    right = table.select(F.col(on[1]).alias("__key"), *take)
    return df.join(right, df[on[0]] == right["__key"], how).drop("__key")


def resolve_identity(
    df: DataFrame, uid: str, maps: Sequence[tuple[DataFrame, str, str]], out: str
) -> DataFrame:
    """Try identity maps in order; rows a map cannot resolve go to the next one.

    ``maps`` holds (table, id column, key column). Rows no map resolves are
    dropped, and rows without an id first of all, so they meet no join. Each step
    sees only what the earlier steps left over.
    """
    resolved, rest = None, df.where(F.col(uid).isNotNull())
    for table, id_col, key_col in maps:
        m = table.where(F.col(id_col).isNotNull() & F.col(key_col).isNotNull()).select(
            F.col(id_col).alias("__id"), F.col(key_col).alias(out)
        ).distinct()
        hit = rest.join(m, rest[uid] == m["__id"], "inner").drop("__id")
        resolved = hit if resolved is None else resolved.unionByName(hit)
        known = m.select("__id").distinct()
        rest = rest.join(known, rest[uid] == known["__id"], "left_anti")
    return resolved


def match_on_id_and_date(
    a: DataFrame, b: DataFrame, ids: tuple[str, str], dates: tuple[str, str]
) -> DataFrame:
    """Equality as-of match: same id and same day, so the date is part of the join key."""
    right = b.withColumnRenamed(ids[1], "__id").withColumnRenamed(dates[1], "__day")
    cond = (a[ids[0]] == right["__id"]) & (a[dates[0]] == right["__day"].cast("date"))
    return a.join(right, cond, "inner").drop("__id", "__day")


def next_term(
    df: DataFrame, key: str, number: str, cols: dict[str, str]
) -> DataFrame:
    """Columns of the row whose number is one higher (null where there is none).

    Not ``lead``: a gap in the numbering must not be bridged, and several rows of that number all
    match. The rows are shuffled once, in slots of SPAN numbers of a key, so one large key stays
    spread; the first row of a slot stands as a guest in the slot before.
    """
    n = F.col(number)
    guest = F.explode(F.when(n % SPAN == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    held = df.withColumn("__guest", guest).withColumn("__slot", F.floor(n / SPAN) - F.col("__guest"))
    one_higher = W.partitionBy(key, "__slot").orderBy(number).rangeBetween(1, 1)
    known = F.col(key).isNotNull() & n.isNotNull()
    packed = F.struct(*[F.col(src).alias(dst) for dst, src in cols.items()])
    near = F.when(known, F.collect_list(packed).over(one_higher))
    out = held.withColumn("__near", near).where("__guest = 0").withColumn("__next", F.explode_outer("__near"))
    return out.select(*df.columns, *[F.col(f"__next.{dst}").alias(dst) for dst in cols])
