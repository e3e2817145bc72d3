"""Jaccard join on word shingles by a MinHash LSH forest.

A document's shingles are its runs of five words; one of one to four words has
its words as its only shingle. Documents with equal shingle sets are one class
and are represented once. A representative's MinHash signature gives its label
in each of TREES prefix trees. Two documents of similarity s share the first d
hashes of a label with probability s^d, so matching starts at prefixes of DEEPEST
hashes and shortens them, one hash at a time, until documents at the threshold
meet in some tree with the target recall. So the depth is fixed by formula (5 at
the default threshold); the test on the links found cannot fail there, since a
link's chance is never taken below that of one at the threshold.

Subtrees that hold several documents are compared by signature, in blocks;
documents that the signatures cannot tell from similar ones form clusters, and
the members of a cluster are compared by their whole shingle sets, again in
blocks. A task reports one row for a member (links counted, and one partner), so
a group of near copies is never written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, frame, in_blocks, shipped, sized_join, stage, units, words_of

WIDTH = 5
THRESHOLD = 0.8
TREES = 20
DEEPEST = 6
RECALL = 0.9995
#: Documents of a block; a task holds two blocks.
BLOCK = 192
#: Signatures that agree less cannot belong to similar documents (over four standard errors).
SLACK = 0.18

_MEMO: dict[str, int] = {}
_rng = np.random.Generator(np.random.PCG64(20240607))
_SCALE = _rng.integers(1, 1 << 63, TREES * DEEPEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, TREES * DEEPEST, dtype=np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word runs of a whole text."""
    words = words_of(text or "")
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(_MEMO) > 150_000:
        _MEMO.clear()
    memo = _MEMO
    codes = []
    for w in words:
        code = memo.get(w)
        if code is None:
            code = memo[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        codes.append(code)
    h = np.array(codes, dtype=np.uint64)
    k = min(width, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = out * _MIX[0] + h[j:j + n]
        out ^= out >> np.uint64(29)
    out = (out ^ (out >> np.uint64(30))) * _MIX[1]
    out = (out ^ (out >> np.uint64(27))) * _MIX[2]
    return np.unique(out ^ (out >> np.uint64(31)))


def forget() -> None:
    """Drop the words a task memorised: its worker stays for later stages. A function, so that tasks get it by name."""
    _MEMO.clear()


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a shingle set, tree after tree."""
    least = np.full(len(_SCALE), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(found), 1024):
        values = found[low:low + 1024, None] * _SCALE + _SHIFT
        np.minimum(least, values.min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def meeting(depth: int, s: float, trees: int = TREES) -> float:
    """Probability that documents of similarity s share a prefix of ``depth`` hashes in some tree."""
    return 1 - (1 - s ** depth) ** trees


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, print, signature, light of each row; the last three null without words.

    ``print`` tells shingle sets apart; ``light`` is one byte of each hash of the
    signature, in which hashes that differ agree once in 256 times.
    """

    @F.pandas_udf("print binary, signature binary, light binary")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text)
                if len(found):
                    hashes = signature(found)
                    rows.append((xxhash.xxh128_digest(found.tobytes()), hashes.astype("<u4").tobytes(),
                                 hashes.astype("u1").tobytes()))
                else:
                    rows.append((None, None, None))
            yield frame(rows, ["print", "signature", "light"])
        forget()

    return shipped(docs).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
        sign(F.col(text_col)).alias("s")).select("doc_id", "text_hash", "s.*")


def _same_subtree(nodes: DataFrame, depth: int) -> DataFrame:
    """subtree, node: documents that are not alone under their prefix, tree by tree."""
    rows = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    prefix = F.expr(f"substring(signature, tree * {4 * DEEPEST} + 1, {4 * depth})")
    rows = rows.select("node", F.xxhash64("tree", prefix).alias("subtree"))
    shared = rows.groupBy("subtree").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("subtree")
    return rows.join(shared, "subtree")


def _compared(rows: DataFrame, floor: float) -> DataFrame:
    """u, v, s: one link a member within a unit, of those whose signatures agree in ``floor`` of the hashes."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for unit in units(batches, ("subtree", "left_block", "right_block")):
            node = unit["node"]
            if len(node) < 2:
                continue
            sig = np.frombuffer(b"".join(unit["signature"]), dtype=np.uint8).reshape(len(node), -1)
            agree = np.zeros((len(node), len(node)), dtype=np.uint8)
            for column in sig.T:
                agree += column[:, None] == column
            s = agree / sig.shape[1]
            parent = forest((s >= floor) & ~np.eye(len(node), dtype=bool))
            held = np.flatnonzero(parent != np.arange(len(node)))
            out += zip(node[held].tolist(), node[parent[held]].tolist(), s[held, parent[held]].tolist())
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["u", "v", "s"])
                out = []
        yield pd.DataFrame(out, columns=["u", "v", "s"])

    order = ("subtree", "left_block", "right_block")
    return rows.select(*order, "node", "signature").repartition(*order).sortWithinPartitions(*order).mapInPandas(
        compare, "u long, v long, s double")


def _alike(nodes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """u, v: links that join into clusters all documents that may be similar."""
    found = None
    for depth in range(DEEPEST, 0, -1):
        if meeting(depth, threshold) < recall and depth > 1:
            continue
        members = stage(_same_subtree(nodes, depth))
        signed = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
            "node", F.col("light").alias("signature"))
        dealt = in_blocks(members, "subtree", "node", BLOCK).join(signed, "node")
        found = stage(_compared(dealt, threshold - SLACK).groupBy(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).agg(F.max("s").alias("s")))
        # Each link found stands for 1 / p that exist, p its chance to be found at this depth.
        p = 1 - F.pow(1 - F.pow(F.greatest("s", F.lit(threshold)), F.lit(depth)), F.lit(TREES))
        total = found.agg(F.count(F.lit(1)), F.sum(1 / p)).first()
        if not total[0] or total[0] / total[1] >= recall:
            break
    return found.select("u", "v")


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """node, links, partner of each member of a unit; links: weights of the members similar to it."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for unit in units(batches, ("cluster", "left_block", "right_block")):
            node, n = unit["node"], len(unit["node"])
            sets = [np.frombuffer(x, dtype="<u8") for x in unit["shingles"]]
            size = np.array([len(x) for x in sets], dtype=np.int64)
            owner = np.repeat(np.arange(n), size)
            _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            many = count > 1
            label = np.cumsum(many) - 1
            keep = many[which]
            owner, which, width = owner[keep], label[which[keep]], int(many.sum())
            shared = np.zeros((n, n), dtype=np.float64)
            order = np.argsort(which, kind="stable")
            owner, which = owner[order], which[order]
            step = max(256, 8_000_000 // max(n, 1))
            for low in range(0, width, step):
                a, b = np.searchsorted(which, (low, low + step))
                grid = np.zeros((n, min(step, width - low)), dtype=np.float32)
                grid[owner[a:b], which[a:b] - low] = 1
                shared += grid @ grid.T
            union = size[:, None] + size - shared
            linked = shared >= threshold * union - 1e-9
            np.fill_diagonal(linked, False)
            if unit["left_block"][0] != unit["right_block"][0]:
                linked &= unit["block"][:, None] != unit["block"]
            parent = forest(linked)
            out += zip(node.tolist(), (linked @ unit["weight"]).tolist(), node[parent].tolist())
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["node", "links", "partner"])
                out = []
        yield pd.DataFrame(out, columns=["node", "links", "partner"])

    order = ("cluster", "left_block", "right_block")
    return rows.select(*order, "block", "node", "weight", "shingles").repartition(*order).sortWithinPartitions(
        *order).mapInPandas(verify, "node long, links long, partner long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
           recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Rows and classes, both written tables.

    Rows: doc_id, text_hash, print of each row. Classes: print, class_id (least
    id of an equal shingle set), group_id (least id that links reach), n_links
    (other rows linked directly), first (id and text hash of the group's least row).
    """
    rows = stage(_signed(docs, id_col, text_col))
    own = F.struct("doc_id", "text_hash")
    nodes = stage(rows.where("print IS NOT NULL").groupBy("print").agg(
        F.min_by(own, F.struct(F.col("doc_id").isNull(), own)).alias("first"), F.min("doc_id").alias("class_id"),
        F.count(F.lit(1)).alias("weight"), F.first("signature").alias("signature"),
        F.first("light").alias("light")).select(F.monotonically_increasing_id().alias("node"), "*"))
    slim = nodes.drop("signature", "light")
    clusters = stage(components(_alike(nodes.select("node", "signature", "light"), threshold, recall)))

    @F.pandas_udf("binary")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: shingles(t).astype("<u8").tobytes(), na_action=None)
        forget()

    asked = stage(slim.join(clusters, "node").select(
        "node", F.col("root").alias("cluster"), "weight", F.col("first.doc_id").alias("d"),
        F.col("first.text_hash").alias("h")))
    texts = docs.select(F.col(id_col).alias("d0"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h0"))
    told = sized_join(texts, asked, (F.col("h0") == F.col("h")) & F.col("d0").eqNullSafe(F.col("d")))
    members = stage(told.select("node", "cluster", "weight", cut("text").alias("shingles")).dropDuplicates(["node"]))
    verified = stage(_verified(in_blocks(members, "cluster", "node", BLOCK), threshold))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(verified.where("node <> partner").select(F.col("node").alias("u"), F.col("partner").alias("v")))
    linked = slim.join(links, "node", "left").join(reached, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    # Null ids come last, so a group is named by an id if it has one.
    least = linked.groupBy("root").agg(
        F.min("class_id").alias("group_id"),
        F.min_by("first", F.struct(F.col("first.doc_id").isNull(), "first")).alias("group_first"))
    classes = linked.join(least, "root").select(
        "print", "class_id", "group_id", "group_first",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.select("doc_id", "text_hash", "print"), stage(classes)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, group_id, n_links of every row.

    ``class_id``: least id of the rows with the same shingles; ``group_id``:
    least id that links of similarity ``threshold`` or more reach; ``n_links``:
    other rows linked directly, copies included. Texts without words, null ones
    too, link with nothing and are their own class and group. Repeated rows
    count as copies. Null ids are named by other ids of their class. Other
    columns of the input are not read.
    """
    rows, classes = groups(docs, id_col, text_col, threshold)
    alone = F.col("print").isNull()
    found = rows.where(~alone).join(classes, "print").select("doc_id", "class_id", "group_id", "n_links")
    return found.union(rows.where(alone).select(
        "doc_id", F.col("doc_id"), F.col("doc_id"), F.lit(0).cast("long")))


def kept_once(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with one of each group: the one with the least id. Texts without words all stay."""
    rows, classes = groups(docs, id_col, text_col, threshold)
    placed = rows.join(classes.select("print", "group_first"), "print").withColumn(
        "is_first", F.col("doc_id").eqNullSafe(F.col("group_first.doc_id"))
        & (F.col("text_hash") == F.col("group_first.text_hash")))
    key = (F.col("doc_id").alias("__near_id"), F.col("text_hash").alias("__near_hash"))
    others = stage(placed.where("NOT is_first").select(*key).distinct())
    # The least id and text in several rows: one of them stays.
    again = stage(placed.where("is_first").groupBy(*key).count().where("count > 1").select(
        "__near_id", "__near_hash", F.lit(True).alias("__near_again")))
    own = docs.withColumn("__near_own", F.xxhash64(F.col(text_col)))
    same = (F.col("__near_own") == F.col("__near_hash")) & F.col(id_col).eqNullSafe(F.col("__near_id"))
    left = sized_join(sized_join(own, others, same, "left_anti"), again, same, "left").drop("__near_id", "__near_hash", "__near_own")
    return left.where("__near_again IS NULL").drop("__near_again").unionByName(
        left.where("__near_again").drop("__near_again").dropDuplicates([id_col, text_col]))
