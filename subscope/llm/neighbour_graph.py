"""Near-duplicate embeddings by neighbour descent.

Vectors are compared within their label only. Sorted orders of random-hyperplane
signatures, fresh in each round and more of them for larger labels, give every
vector neighbours. Then the graph is refined: all neighbours of a vector, in either direction, are compared with each other,
and each keeps the nearest it has met; pairs that stood in a list before are not compared again. At least two
rounds are made, and as many until a brute-force audit finds the target recall: the mean share of a linked
node's true links, over a sample that grows until it holds LINKED such nodes. Where the data hold fewer,
pairs planted at the threshold must meet in the sorted orders. Labels that still miss the target after ROUNDS are compared
whole, in blocks. What links reach is a cluster. Every
comparison reports a spanning forest of the links it saw, and clusters only grow,
so no list's length loses a link's connection. A list has slots inside its
cluster and slots outside: members of its own cluster cannot fill the latter, so
it is never saturated there. The members of a cluster are compared in blocks, so
large groups of copies are complete and no pair of theirs is written out. Links
are pairs of at least the threshold in double precision.

Equal vectors of a label are one node with a weight. Lists of neighbours have a
fixed length; who names a vector as neighbour is not limited, since a long list
of those is dealt in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, few_rows, forest, in_blocks, shipped, stage, units

THRESHOLD = 0.98
#: Slots of a neighbour list inside a cluster, and outside.
LIST = 8
#: Least orders of a round, neighbours to each side in them, bits of a signature (more than any count of vectors has).
ORDERS, SIDE, BITS = 4, 3, 62
#: Probability with which a pair at the threshold meets in the orders of one round.
MEET = 0.95
#: Vectors of a block; a task holds two blocks.
BLOCK = 256
#: Vectors that an audit compares with all others: at first, and at most; it ends with so many that have links.
AUDIT, AUDIT_MOST, LINKED = 400, 25_600, 200
RECALL = 0.99
ROUNDS = 8
#: Twins planted at the threshold in the sorted orders.
PLANTED = 400


def _matrix(cells: np.ndarray) -> np.ndarray:
    """Rows of 64-bit floats from packed 32- or 64-bit ones; the first byte of a cell is their width."""
    return np.vstack([np.frombuffer(c, dtype=f"<f{c[0]}", offset=1) for c in cells]).astype("<f8", copy=False)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1))


def _packed(rows: DataFrame) -> DataFrame:
    """Rows with ``vec``: packed components, null unless all are finite and one is not zero.

    A column of 32-bit floats stays 32 bits wide, so half as much is shuffled; arithmetic is in 64.
    """
    width = 4 if "float" in dict(rows.dtypes)["embedding"] else 8

    @F.pandas_udf("binary")
    def pack(cells: pd.Series) -> pd.Series:
        out = []
        for cell in cells:
            x = None if cell is None else np.array([np.nan if v is None else v for v in cell], dtype="<f8")
            sound = x is not None and len(x) and np.isfinite(x).all() and x.any() and np.isfinite(x @ x) and x @ x > 0
            out.append(bytes([width]) + (x + 0.0).astype(f"<f{width}").tobytes() if sound else None)
        return pd.Series(out, dtype=object)

    return shipped(rows).withColumn("vec", pack(F.col("embedding").cast("array<double>")))


def _orders(n: int, threshold: float) -> int:
    """Orders in which a pair of cosine ``threshold`` among ``n`` vectors has neighbouring places with probability MEET.

    Vectors are neighbours where their common prefix is as long as it takes to
    leave some 2 * SIDE vectors; a bit is common with one minus the angle's share of pi.
    """
    bit = 1 - np.arccos(min(max(threshold, 0.5), 1.0)) / np.pi
    meet = min(bit ** np.log2(max(n / (2 * SIDE), 1)), 1 - 1e-9)
    return max(ORDERS, int(np.ceil(np.log(1 - MEET) / np.log(1 - meet))))


def _ordered_neighbours(nodes: DataFrame, turn: int, threshold: float) -> DataFrame:
    """node, other, s: neighbours in sorted orders of signatures; each turn has its own, as many as a label's size asks."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[tuple, np.ndarray] = {}
        for batch in batches:
            out = []
            for (size, n), part in batch.groupby([batch["vec"].map(len), "size"]):
                x = _matrix(part["vec"].to_numpy())
                dim, orders = x.shape[1], _orders(int(n), threshold)
                for k in range(orders):
                    if (dim, k) not in planes:
                        planes[dim, k] = np.random.Generator(np.random.PCG64([dim, turn, k])).standard_normal((dim, BITS))
                    codes = ((x @ planes[dim, k] > 0) * (1 << np.arange(BITS)[::-1])).sum(1)
                    out.append(pd.DataFrame({"node": part["node"], "grp": part["grp"], "vec": part["vec"],
                                             "turn": k, "code": codes}))
            if out:
                yield pd.concat(out)

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            line = batch if held is None else pd.concat([held, batch], ignore_index=True)
            first = len(line) - len(batch)
            run = ((line["turn"] != line["turn"].shift()) | (line["grp"] != line["grp"].shift())).cumsum().to_numpy()
            node, sizes = line["node"].to_numpy(), line["vec"].map(len).to_numpy()
            for size in np.unique(sizes):
                # Vectors of a group have one size, so neighbours in a run are neighbours here.
                at = np.flatnonzero(sizes == size)
                x = _matrix(line["vec"].to_numpy()[at])
                x = x / np.linalg.norm(x, axis=1)[:, None]
                for d in range(1, SIDE + 1):
                    i, j = at[d:], at[:-d]
                    s = np.einsum("ij,ij->i", x[d:], x[:-d])
                    near = (run[i] == run[j]) & (i >= first)
                    a, b, s = node[i[near]], node[j[near]], s[near]
                    yield pd.DataFrame({"node": np.concatenate([a, b]), "other": np.concatenate([b, a]), "s": np.concatenate([s, s])})
            held = line.iloc[-SIDE:]

    order = ("turn", "grp", "code", "node")
    signed = nodes.select("node", "grp", "vec", "size").mapInPandas(
        sign, "node long, grp string, vec binary, turn int, code long")
    return signed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        link, "node long, other long, s double")


def _nearest(old: DataFrame | None, found: DataFrame, clusters: DataFrame, length: int = LIST) -> DataFrame:
    """The ``length`` nearest others of each node inside its cluster, and as many outside, written; ties go to the smaller number.

    ``fresh`` marks entries that the ``old`` lists did not have.
    """
    best = found.select("node", "other", "s", F.lit(True).alias("fresh"))
    if old is not None:
        best = best.union(old.select("node", "other", "s", F.lit(False)))
    best = best.groupBy("node", "other").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    best = best.join(clusters.select("node", F.col("cluster").alias("own")), "node", "left").join(
        clusters.select(F.col("node").alias("other"), "cluster"), "other", "left")
    inside = F.coalesce(F.col("own") == F.col("cluster"), F.lit(False))
    rank = F.row_number().over(Window.partitionBy("node", "inside").orderBy(F.col("s").desc(), "other"))
    return stage(best.withColumn("inside", inside).withColumn("rank", rank).where(F.col("rank") <= length).select(
        "node", "other", "s", "fresh"))


def _neighbourhoods(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """pivot, node, fresh: a vector with its neighbours in either direction, where one of them is new to it, written.

    Neighbours that stood in the list before were compared with each other then.
    """
    both = lists.select("node", "other", "fresh").union(lists.select("other", "node", "fresh")).groupBy("node", "other").agg(
        F.min("fresh").alias("fresh"))
    members = stage(both.select(F.col("node").alias("pivot"), F.col("other").alias("node"), "fresh"))
    active = members.where("fresh").select("pivot").distinct()
    return members.join(active, "pivot", "left_semi").union(
        active.select("pivot", F.col("pivot").alias("node"), F.lit(False).alias("fresh")))


def _whole_groups(nodes: DataFrame, missed: list[str]) -> DataFrame:
    """pivot, node, fresh: all vectors of some labels, as one neighbourhood each."""
    return nodes.where(F.col("grp").isin(missed)).select(F.xxhash64("grp").alias("pivot"), "node", F.lit(True).alias("fresh"))


def _refined(members: DataFrame, nodes: DataFrame, clusters: DataFrame, threshold: float) -> DataFrame:
    """node, other, s of members of a neighbourhood, one of them new there: each one's nearest, also outside its cluster, and a forest of the links."""
    dealt = in_blocks(stage(members), "pivot", "node", BLOCK).join(nodes.select("node", "vec"), "node").join(
        clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, other, sim, held = [], [], [], 0
        for unit in units(batches, ("pivot", "left_block", "right_block")):
            name, n = unit["node"], len(unit["node"])
            if n < 2:
                continue
            x = _matrix(unit["vec"])
            s = _cosines(x, x)
            s = np.maximum(s, s.T)
            np.fill_diagonal(s, -2)
            s[~(unit["fresh"][:, None] | unit["fresh"])] = -2
            pairs = []
            linked = s >= threshold
            if linked.any():
                hangs = forest(linked)
                at = np.flatnonzero(hangs != np.arange(n))
                pairs.append((at, hangs[at]))
            near = np.argpartition(-s, min(3, n - 2), axis=1)[:, :min(4, n - 1)]
            pairs.append((np.repeat(np.arange(n), near.shape[1]), near.ravel()))
            same = unit["cluster"][:, None] == unit["cluster"]
            if same.sum() > n:
                out = np.where(same, -2, s)
                near = np.argpartition(-out, min(3, n - 2), axis=1)[:, :min(4, n - 1)]
                at, near = np.repeat(np.arange(n), near.shape[1]), near.ravel()
                pairs.append((at[~same[at, near]], near[~same[at, near]]))
            for at, to in pairs:
                seen = s[at, to] > -2
                at, to = at[seen], to[seen]
                node.append(name[at])
                other.append(name[to])
                sim.append(s[at, to])
                held += len(at)
            if held > 200_000:
                yield pd.DataFrame({"node": np.concatenate(node), "other": np.concatenate(other), "s": np.concatenate(sim)})
                node, other, sim, held = [], [], [], 0
        if held:
            yield pd.DataFrame({"node": np.concatenate(node), "other": np.concatenate(other), "s": np.concatenate(sim)})

    order = ("pivot", "left_block", "right_block")
    return dealt.select(*order, "node", "cluster", "fresh", "vec").repartition(*order).sortWithinPartitions(*order).mapInPandas(
        compare, "node long, other long, s double")


def _joined(clusters: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """node, cluster of every node that has a link, written: the clusters, joined by the links of ``found``."""
    pairs = found.where(F.col("s") >= threshold).select(F.col("node").alias("u"), F.col("other").alias("v"))
    stars = clusters.select(F.col("node").alias("u"), F.col("cluster").alias("v"))
    reached = stage(components(pairs.union(stars)).select("node", F.col("root").alias("cluster")))
    return few_rows(reached)(reached)


def _enlarged(clusters: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """node, cluster, links, near of every node that has a link, written: all members of a cluster, compared.

    ``near`` counts linked nodes, ``links`` their copies too.
    """
    dealt = in_blocks(clusters, "cluster", "node", BLOCK).join(nodes.select("node", "vec", "weight"), "node")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for unit in units(batches, ("cluster", "left_block", "right_block")):
            node = unit["node"]
            x = _matrix(unit["vec"])
            linked = _cosines(x, x) >= threshold
            linked |= linked.T
            np.fill_diagonal(linked, False)
            if unit["left_block"][0] != unit["right_block"][0]:
                linked &= unit["block"][:, None] != unit["block"]
            out += zip(node.tolist(), unit["cluster"].tolist(), (linked @ unit["weight"]).tolist(), linked.sum(1).tolist())
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["node", "cluster", "links", "near"])
                out = []
        yield pd.DataFrame(out, columns=["node", "cluster", "links", "near"])

    order = ("cluster", "left_block", "right_block")
    found = dealt.select(*order, "block", "node", "weight", "vec").repartition(*order).sortWithinPartitions(
        *order).mapInPandas(compare, "node long, cluster long, links long, near long")
    return stage(found.groupBy("node", "cluster").agg(F.sum("links").alias("links"), F.sum("near").alias("near")))


def sampled_truth(nodes: DataFrame, threshold: float, sample: int = AUDIT, most: int = AUDIT_MOST,
                  linked: int = LINKED) -> tuple[dict[int, int], int, bool]:
    """True links by brute force of sampled nodes that have any, how many nodes were sampled, whether that is evidence.

    A range of a hash holds about ``sample`` nodes at first and four times as many
    each time, until ``linked`` of them have a link, or all nodes or ``most`` are
    sampled. Copies are one node. It is evidence if ``linked`` were found or all
    nodes sampled. A slice of the sample goes to every task.
    """
    total, true, done, low, size = nodes.count(), {}, 0, 0, sample
    spot = F.pmod(F.xxhash64(F.col("node") * 7 + 1), F.lit(1 << 40))
    while True:
        high = min(1 << 40, (min(size, most) << 40) // max(total, 1))
        chosen = nodes.where((spot >= low) & (spot < high)).select("node", "grp", "vec").collect()
        true.update(_true_links(nodes, chosen, threshold))
        done, low = done + len(chosen), high
        if len(true) >= linked or high == 1 << 40:
            return true, done, True
        if size >= most:
            return true, done, False
        size *= 4


def _true_links(nodes: DataFrame, asked: list, threshold: float) -> dict[int, int]:
    """The number of nodes that each asked one (node, grp, vec) links with, if any."""
    sets: dict[tuple, tuple] = {}
    for r in asked:
        names, cells = sets.setdefault((r["grp"], len(r["vec"])), ([], []))
        names.append(r["node"])
        cells.append(bytes(r["vec"]))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in batch.groupby([batch["grp"], batch["vec"].map(len)]):
                names, cells = sets.get(key, ([], []))
                here, y = part["node"].to_numpy(), _matrix(part["vec"].to_numpy())
                for low in range(0, len(names), BLOCK):
                    name = np.array(names[low:low + BLOCK])
                    linked = _cosines(_matrix(cells[low:low + BLOCK]), y) >= threshold
                    linked &= name[:, None] != here
                    n = linked.sum(1)
                    yield pd.DataFrame({"node": name[n > 0], "n": n[n > 0]})

    found = nodes.select("node", "grp", "vec").mapInPandas(count, "node long, n long")
    return {r["node"]: r["n"] for r in found.groupBy("node").agg(F.sum("n").alias("n")).collect()}


def _shares(true: dict[int, int], links: DataFrame) -> dict[int, float]:
    """The share of each sampled linked node's true links that ``links`` (node, near) counts."""
    if not true:
        return {}
    asked = links.sparkSession.createDataFrame([(k,) for k in true], "node long")
    got = {r["node"]: r["near"] for r in links.join(F.broadcast(asked), "node").select("node", "near").collect()}
    return {k: min(1.0, got.get(k, 0) / n) for k, n in true.items()}


def audit(true: dict[int, int], links: DataFrame) -> float:
    """Mean share over the sampled linked nodes; 1 if no node has a link."""
    shares = _shares(true, links)
    return sum(shares.values()) / len(shares) if shares else 1.0


def planted(nodes: DataFrame, threshold: float, most: int = PLANTED) -> tuple[DataFrame, dict[int, int]]:
    """``nodes`` with twins of a sample, each turned away to just the threshold; and twin -> node.

    The twins, numbered below zero, take part in the sorted orders only. Whether one meets its node there is
    evidence of recall where the data themselves hold too few links to tell.
    """
    total = max(nodes.count(), 1)
    spot = F.pmod(F.xxhash64(F.col("node") * 11 + 5), F.lit(1 << 40))
    chosen = nodes.where(spot < min(1 << 40, (most << 40) // total)).select("node", "grp", "vec", "size").collect()
    rows, twins = [], {}
    for k, r in enumerate(sorted(chosen, key=lambda r: r["node"])):
        x = _matrix([bytes(r["vec"])])[0]
        if len(x) < 2:
            continue
        x = x / np.linalg.norm(x)
        away = np.random.Generator(np.random.PCG64([len(x), r["node"]])).standard_normal(len(x))
        away -= (away @ x) * x
        turned = threshold * x + math.sqrt(max(1 - threshold ** 2, 0.0)) * away / np.linalg.norm(away)
        width = bytes(r["vec"])[0]
        rows.append((-1 - k, r["grp"], bytearray(bytes([width]) + turned.astype(f"<f{width}").tobytes()), r["size"]))
        twins[-1 - k] = r["node"]
    extra = nodes.sparkSession.createDataFrame(rows, "node long, grp string, vec binary, size long")
    return nodes.select("node", "grp", "vec", "size").union(extra), twins


def _labels(nodes: DataFrame) -> list[str]:
    return [r["grp"] for r in nodes.select("grp").distinct().collect()]


def _missed(true: dict[int, int], links: DataFrame, nodes: DataFrame, recall: float) -> list[str]:
    """The labels whose sampled links are found to less than ``recall``."""
    shares = _shares(true, links)
    asked = nodes.sparkSession.createDataFrame([(k,) for k in shares], "node long")
    held: dict[str, list[float]] = {}
    for r in nodes.join(F.broadcast(asked), "node").select("node", "grp").collect():
        held.setdefault(r["grp"], []).append(shares[r["node"]])
    return [g for g, x in held.items() if sum(x) / len(x) < recall]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", embedding_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Only vectors of one label and one length are compared; a null label, a null,
    empty or zero vector and null or non-finite components link with nothing.
    Repeated rows are linked copies. Labels whose audit stays below ``recall`` after all rounds are
    compared whole, in blocks, so none ends below it. Long vectors are only wider rows; an empty table gives
    an empty one. ``component_id`` is the least id that links
    reach, ``kept`` whether it is the row's own; null ids name nothing, so a
    component of null ids alone has none, and is not kept by name. Other columns
    of the input are not read.
    """
    rows = stage(_packed(vectors.select(
        F.col(id_col).alias("vec_id"), F.col(embedding_col).alias("embedding"), F.col(label_col).alias("label"))).select(
        "vec_id", F.concat_ws(":", F.col("label").cast("string"), F.length("vec")).alias("grp"),
        F.when(F.col("label").isNotNull(), F.col("vec")).alias("vec")))
    sound = rows.where("vec IS NOT NULL")
    nodes = stage(sound.groupBy("grp", "vec").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight")).select(
        F.monotonically_increasing_id().alias("node"), "*"))
    sizes = stage(nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("size")))
    nodes = nodes.join(few_rows(sizes)(sizes), "grp")
    true, _, evident = sampled_truth(nodes, threshold)
    sown, twins = planted(nodes, threshold)
    clusters = nodes.select("node", F.col("node").alias("cluster")).limit(0)
    lists, met = None, set()
    for turn in range(ROUNDS):
        found = stage(_ordered_neighbours(sown, turn, threshold))
        met |= {r["node"] for r in found.where("node < 0").select("node", "other").collect() if twins[r["node"]] == r["other"]}
        found = found.where("node >= 0 AND other >= 0")
        clusters = _joined(clusters, found, threshold)
        lists = _nearest(lists, found, clusters)
        found = stage(_refined(_neighbourhoods(lists, nodes), nodes, clusters, threshold))
        clusters = _joined(clusters, found, threshold)
        lists = _nearest(lists, found, clusters)
        links = _enlarged(clusters, nodes, threshold)
        share = audit(true, links)
        # Where few vectors have links, the planted pairs are the evidence, and what is sampled must not speak against it.
        if turn and share >= recall and (evident or len(met) >= recall * len(twins)):
            break
    else:
        missed = _missed(true, links, nodes, recall if evident else 1.0) if share < recall else None
        found = stage(_refined(_whole_groups(nodes, missed or _labels(nodes)), nodes, clusters, threshold))
        clusters = _joined(clusters, found, threshold)
        links = _enlarged(clusters, nodes, threshold)
    known = nodes.drop("vec").join(links.drop("near"), "node", "left").withColumn("root", F.coalesce("cluster", "node"))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(named, "root").select("node", "component_id", (
        F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    told = nodes.select("node", "grp", "vec").join(known, "node").drop("node")
    out = sound.join(told, ["grp", "vec"]).select("vec_id", "n_links", "component_id")
    out = out.union(rows.where("vec IS NULL").select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
