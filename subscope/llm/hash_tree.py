"""Shards by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards, and a shard has a weight; a rack or region
weighs what it holds. A row descends from the top: every child draws
``-ln(u) / weight``, where ``u`` in (0, 1) hashes the row's key with the child's
path, and the least draw wins. A child's draw knows nothing of its siblings, so a
weight that rises only draws rows into that child, level by level: a row outside
a region stays or enters it, a row in the region but outside the rack stays or
enters the rack, a row in the rack stays or enters the shard. A shard that opens a
region of its own (:func:`grown`) therefore takes rows into itself and moves no other.

All of it is column expressions: a row's shard needs no shuffle. Places in a shard
(:func:`slots`) are ranks by a hash of the row, taken in cells of the hash, so no
task holds a whole shard; repeated rows are counted before any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]

#: Shards of the query, racks of a region, shards of a rack.
SHARDS, RACKS, WIDTH = 8, 2, 2
#: Bits of a draw's hash: thirteen hexadecimal digits.
DIGITS = 13
#: Rows of a shard that one cell of the hash holds about; repeats of a row that one task writes.
CELL, CHUNK = 8_192, 65_536


def founded(shards: int = SHARDS, racks: int = RACKS, width: int = WIDTH, weight: float = 1.0) -> Tree:
    """``shards`` shards of one weight, ``width`` to a rack and ``racks`` racks to a region."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // width
        tree.setdefault(f"r{rack // racks}", {}).setdefault(f"k{rack % racks}", {})[shard] = weight
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a new region: rows move into it and nowhere else."""
    new = 1 + max((s for racks in tree.values() for shards in racks.values() for s in shards), default=-1)
    return {**tree, f"r{len(tree)}": {"k0": {new: weight}}}


def weighed(tree: Tree, shard: int, weight: float) -> Tree:
    """The tree with another weight for one shard; 0 takes it out."""
    return {r: {k: {s: weight if s == shard else w for s, w in shards.items()} for k, shards in racks.items()}
            for r, racks in tree.items()}


def _nodes(tree: Tree) -> list[tuple[str, float, list[tuple[str, float, list[tuple[str, float, int]]]]]]:
    """(path, weight, children) of regions, racks and shards that weigh something."""
    out = []
    for r, racks in tree.items():
        inside = []
        for k, shards in racks.items():
            leaves = [(f"{r}/{k}/s{s}", float(w), s) for s, w in shards.items() if w > 0]
            if leaves:
                inside.append((f"{r}/{k}", sum(x[1] for x in leaves), leaves))
        if inside:
            out.append((r, sum(x[1] for x in inside), inside))
    if not out:
        raise ValueError("no shard of the tree has a weight")
    return out


def _literal(node) -> str:
    path, weight, inside = node
    held = f"array({', '.join(map(_literal, inside))})" if isinstance(inside, list) else f"{inside}"
    return f"named_struct('path', '{path}', 'weight', {weight!r}D, 'inside', {held})"


def _drawn(key: Column, children: Column) -> Column:
    """What the child with the least draw holds; of equal draws, the first child's."""

    def draw(child: Column, at: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit("@"), child["path"]).cast("binary")), 1, DIGITS)
        unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)
        return F.struct((-F.ln(unit) / child["weight"]).alias("draw"), at.alias("at"), child["inside"].alias("inside"))

    return F.array_min(F.transform(children, draw))["inside"]


def key_of(key: Column) -> Column:
    """A key as the tree hashes it: its text, or ``null``."""
    return F.coalesce(key.cast("string"), F.lit("null"))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) to which the tree takes a key."""
    top = F.expr(f"array({', '.join(map(_literal, _nodes(tree)))})")
    name = key_of(key)
    return _drawn(name, _drawn(name, _drawn(name, top))).cast("int")


def place(rows: DataFrame, tree: Tree, key: str = "doc_id", to: str = "shard") -> DataFrame:
    """The rows, all columns, with the shard of their key in column ``to`` (a column of that name is replaced).

    Every row has a shard, null keys too (all the same one). Nothing but the key
    and the tree decides, so repeated rows and repeated keys share a shard, however
    many. Texts are not read. Empty tables give empty tables.
    """
    return rows.withColumn(to, shard_of(F.col(key), tree))


def _ordered(rows: DataFrame, columns: list[str]) -> Column:
    return F.md5(F.concat_ws(":", *(key_of(F.col(c)) for c in columns)).cast("binary"))


def slots(rows: DataFrame, shard: str = "shard", cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """Narrow rows with ``slot``: places 0, 1, ... in their shard, by a hash of the row.

    ``rows`` are the columns that tell rows apart, the shard among them; rows equal
    in all are interchangeable and take consecutive places. They are counted
    map-side first, and a row repeated over ``chunk`` times is written by several
    tasks. Cells are ranges of the hash, so the places do not depend on how many
    there are, or on how the input is split.
    """
    columns = rows.columns
    hashed = _ordered(rows, columns)
    found = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    found = stage(found.withColumn("__hash", hashed))
    cells = math.ceil(found.count() / (cell * max(1, found.select(shard).distinct().count()))) or 1
    spot = F.conv(F.substring("__hash", 1, 12), 16, 10).cast("double") / float(16 ** 12)
    found = found.withColumn("__cell", F.floor(spot * cells))
    before = Window.partitionBy(shard).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = found.groupBy(shard, "__cell").agg(F.sum("__copies").alias("__held")).select(
        F.col(shard), "__cell", F.coalesce(F.sum("__held").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(shard, "__cell").orderBy("__hash", *columns).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__offset") + F.coalesce(F.sum("__copies").over(inside), F.lit(0))
    ranked = found.join(offsets, [shard, "__cell"]).withColumn("__first", first)
    last = F.col("__first") + F.col("__copies") - 1
    if not found.where(F.col("__copies") > chunk).isEmpty():
        ranked = ranked.withColumn("__last", last).withColumn(
            "__first", F.explode(F.sequence("__first", "__last", F.lit(chunk).cast("long"))))
        ranked = ranked.repartition("__hash", "__first")
        last = F.least(F.col("__last"), F.col("__first") + (chunk - 1))
    return ranked.select(*columns, F.explode(F.sequence(F.col("__first"), last)).alias("slot"))


def manifest(docs: DataFrame, tree: Tree, more: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus one, null and empty texts 1 (and a
    checksum of 0). Repeated rows each have a place. Only ``doc_id`` and ``text``
    are read, so other columns may have any name. ``more`` is the tree with one
    more shard, :func:`grown` if not given.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    key = F.col("doc_id")
    numbered = slots(rows.withColumn("shard", shard_of(key, tree)))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        shard_of(key, more or grown(tree)).alias("grown_shard"))


def oracle(tree: Tree) -> str:
    """DuckDB SQL of :func:`manifest` over ``documents``."""

    def least(tree: Tree) -> str:
        rows, at = [], 0
        for r, weight, racks in _nodes(tree):
            rows.append((1, "", r, weight, at, -1))
            for k, held, shards in racks:
                rows.append((2, r, k, held, (at := at + 1), -1))
                rows += [(3, k, s, w, (at := at + 1), n) for s, w, n in shards]
            at += 1
        return ", ".join(f"({lvl}, '{parent}', '{path}', {w!r}, {i}, {n})" for lvl, parent, path, w, i, n in rows)

    def level(name: str, source: str, nodes: str, depth: int) -> str:
        return f"""{name} AS (SELECT k, path, shard FROM (
    SELECT f.k, n.path, n.shard, row_number() OVER (PARTITION BY f.k ORDER BY
        -ln((('0x' || substr(md5(f.k || '@' || n.path), 1, {DIGITS}))::BIGINT + 0.5) / {float(16 ** DIGITS)!r}) / n.weight,
        n.pos) AS place
    FROM {source} f JOIN {nodes} n ON n.level = {depth} AND n.parent = f.path) x WHERE place = 1)"""

    # The checksum bit by bit: eight steps for each byte, by the reversed polynomial.
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    table = "list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: " + step + "))"
    return f"""WITH nodes(level, parent, path, weight, pos, shard) AS (VALUES {least(tree)}),
more(level, parent, path, weight, pos, shard) AS (VALUES {least(grown(tree))}),
steps AS MATERIALIZED (SELECT {table} AS t),
docs AS (SELECT doc_id, coalesce(cast(doc_id AS varchar), 'null') AS k, coalesce(text, '') AS text FROM documents),
keys AS (SELECT DISTINCT k, '' AS path FROM docs),
{level('a1', 'keys', 'nodes', 1)}, {level('a2', 'a1', 'nodes', 2)}, {level('a3', 'a2', 'nodes', 3)},
{level('b1', 'keys', 'more', 1)}, {level('b2', 'b1', 'more', 2)}, {level('b3', 'b2', 'more', 3)},
sums AS (SELECT text, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
    regexp_extract_all(hex(encode(text)), '..'), lambda h: cast('0x' || h AS BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS crc FROM (SELECT DISTINCT text FROM docs) d, steps),
rows AS (SELECT d.doc_id, d.k, strlen(d.text) + 1 AS size, s.crc, a3.shard, b3.shard AS grown
    FROM docs d JOIN sums s USING (text) JOIN a3 USING (k) JOIN b3 USING (k))
SELECT doc_id, cast(size AS bigint) AS size, cast(crc AS bigint) AS text_crc32, 'key' AS law,
    cast(shard AS integer) AS shard, row_number() OVER (PARTITION BY shard ORDER BY
        md5(k || ':' || size || ':' || crc || ':' || shard), doc_id, size, crc) - 1 AS slot,
    cast(grown AS integer) AS grown_shard
FROM rows"""
