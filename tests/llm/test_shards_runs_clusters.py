"""Hash tree, square catchers and centroids against plain Python, with nulls, empty and repeated rows, ties, long texts."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.llm import centroids, hash_tree, queries, square_catchers
from subscope.llm.common import words_of

DOC = "doc_id long, text string, shard string, __hash string, runs string, size string"
ODD = [(None, None, "x", "x", "x", "x"), (None, "", "x", None, "x", "x"), (7, "one", "x", "x", "x", "x"), (7, "one", "x", "x", "x", "x"),
       (7, "other é", "x", "x", "x", "x"), (8, "x" * 200_000, "x", "x", "x", "x"), (9, "a b " * 30_000, "x", "x", "x", "x"), (-3, " \n\t ", "x", "x", "x", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def texts(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


# Shards

def plain_shard(key, tree):
    name, path, level = "null" if key is None else str(key), "", tree

    def weight(x):
        return sum(map(weight, x.values())) if isinstance(x, dict) else x

    while isinstance(level, dict):
        draws = []
        for child, held in level.items():
            at = f"{path}/{child}" if path and isinstance(child, str) else f"{path}/s{child}" if path else child
            if weight(held) > 0:
                unit = (int(hashlib.md5(f"{name}@{at}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
                draws.append((-math.log(unit) / weight(held), len(draws), child, at))
        _, _, child, path = min(draws)
        if not isinstance(level[child], dict):
            return child
        level = level[child]


def placed(spark, tree, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    return {r["doc_id"]: r["shard"] for r in hash_tree.place(rows, tree).collect()}


def test_shards_equal_a_plain_descent(spark):
    uneven = hash_tree.weighed(hash_tree.weighed(hash_tree.founded(), 3, 2.5), 6, 0)
    for tree in (hash_tree.founded(), hash_tree.grown(hash_tree.founded()), uneven, hash_tree.founded(1)):
        got = placed(spark, tree, [None, *range(300)])
        assert got == {k: plain_shard(k, tree) for k in got}


def test_shards_follow_their_weights(spark):
    tree = hash_tree.weighed(hash_tree.founded(), 3, 3.0)
    n = Counter(placed(spark, tree, range(20_000)).values())
    for shard in range(8):
        want = 20_000 * (3 if shard == 3 else 1) / 10
        assert abs(n[shard] - want) < 5 * math.sqrt(want)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    tree = hash_tree.founded()
    for _ in range(3):
        more = hash_tree.grown(tree)
        new = max(s for r in more.values() for k in r.values() for s in k)
        before, after = placed(spark, tree, range(5_000)), placed(spark, more, range(5_000))
        moved = [k for k in before if before[k] != after[k]]
        assert moved and all(after[k] == new for k in moved)
        tree = more


def test_movement_stays_in_subtrees_whose_weight_changes(spark):
    tree = hash_tree.founded()
    more = hash_tree.weighed(tree, 5, 3.0)  # region 1, its first rack
    before, after = placed(spark, tree, range(8_000)), placed(spark, more, range(8_000))
    moved = {(before[k] // 4, before[k] // 2, before[k], after[k] // 4, after[k] // 2, after[k]) for k in before if before[k] != after[k]}
    for region, rack, _, to_region, to_rack, to in moved:
        assert to_region == 1
        if region == 1:
            assert to_rack == 2
        if rack == 2:
            assert to == 5
    # What leaves a shard goes elsewhere in its subtrees' parents, and nothing else moves.
    gone = placed(spark, hash_tree.weighed(tree, 5, 0), range(8_000))
    assert all(gone[k] != 5 for k in gone) and all(before[k] // 4 == 1 for k in before if before[k] != gone[k])
    with pytest.raises(ValueError):
        hash_tree.shard_of(F.lit(1), {"r0": {"k0": {0: 0.0}}})


def test_place_keeps_columns_and_replaces_its_own(spark, docs):
    got = hash_tree.place(docs, hash_tree.founded())
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == len(ODD)
    assert dict(got.dtypes)["shard"] == "int"


def test_manifest_of_odd_rows(spark, docs):
    got = hash_tree.manifest(docs, hash_tree.founded()).collect()
    want = Counter((d, 1 + len((t or "").encode()), zlib.crc32((t or "").encode())) for d, t, *_ in ODD)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"key"} and all(r["grown_shard"] in (r["shard"], 8) for r in got)
    for shard, rows in itertools.groupby(sorted(got, key=lambda r: r["shard"]), key=lambda r: r["shard"]):
        assert sorted(r["slot"] for r in rows) == list(range(sum(r["shard"] == shard for r in got)))
    assert hash_tree.manifest(docs.limit(0), hash_tree.founded()).count() == 0


def test_slots_do_not_depend_on_cells_split_or_repeats(spark):
    rows = spark.range(900).select((F.col("id") % 300).alias("k"), F.lit(0).alias("shard")).union(
        spark.range(700).selectExpr("5L", "0")).union(spark.range(200).selectExpr("id", "1"))
    first = sorted(map(tuple, hash_tree.slots(rows).collect()))
    assert sorted(s for _, shard, s in first if shard == 0) == list(range(1600))
    assert sorted(s for _, shard, s in first if shard == 1) == list(range(200))
    for cell, chunk, parts in ((7, 100, 3), (50, 1, 11), (10_000, 703, 1)):
        assert sorted(map(tuple, hash_tree.slots(rows.repartition(parts), cell=cell, chunk=chunk).collect())) == first


def test_shards_run_no_python(spark, sf_dir):
    for name in ("op11_hash_tree_shards", "op13_native_centroids"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Scan ExistingRDD"))


# Runs

def plain_runs(words, least=24, periods=3):
    out, n = [], len(words)
    for q in range(1, n // periods + 1):
        same, j = [words[i] == words[i + q] for i in range(n - q)], 0
        while j < len(same):
            k = j
            while k < len(same) and same[k]:
                k += 1
            a, b = j, k + q
            if k > j and b - a >= max(least, periods * q) and not any(
                    all(words[x] == words[x + d] for x in range(a, b - d)) for d in range(1, q)):
                out.append((a, b - a, q))
            j = k + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    words = [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(rng.randint(0, 160))]
    for _ in range(rng.randint(0, 4)):
        if len(words) > 9:
            a, p = rng.randrange(len(words)), rng.randint(1, 25)
            stretch = [str(rng.randrange(rng.choice([1, 2, 3, 40]))) for _ in range(p)]
            m = rng.randint(3 * p, 6 * p)
            words[a:a + m] = (stretch * 7)[:m]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    texts = [some_words(rng) for _ in range(400)]
    for least, periods in ((24, 3), (6, 3), (8, 4)):
        assert square_catchers.caught_in(texts, least, periods) == [plain_runs(t, least, periods) for t in texts]
    with pytest.raises(ValueError):
        square_catchers.Tape(periods=2)


def test_words_may_come_one_by_one():
    rng = random.Random(2)
    for _ in range(60):
        words, number = some_words(rng), {}
        codes = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        whole, single, pieces, at = square_catchers.Tape(), square_catchers.Tape(), square_catchers.Tape(), 0
        whole.append(codes)
        for i in range(len(codes)):
            single.append(codes[i:i + 1])
            if i == len(codes) // 2:
                assert single.runs() == plain_runs(words[:i + 1])
        while at < len(codes):
            step = rng.randint(1, 30)
            pieces.append(codes[at:at + step])
            at += step
        assert whole.runs() == single.runs() == pieces.runs() == plain_runs(words)


def test_very_long_periodic_texts_are_quick():
    n = 300_000
    assert square_catchers.caught_in([["a"] * n]) == [[(0, n, 1)]]
    assert square_catchers.caught_in([[str(i % 57) for i in range(n)], []]) == [[(0, n, 57)], []]
    words = [str(i) for i in range(1000)] + ["b", "c"] * 50 + ["d"]
    assert square_catchers.caught_in([words]) == [[(1000, 100, 2)]]


def test_catchers_do_not_trust_fingerprints(monkeypatch):
    monkeypatch.setattr(square_catchers, "_stirred", lambda x: np.zeros_like(x))
    rng = random.Random(3)
    texts = [some_words(rng)[:60] for _ in range(30)]
    assert square_catchers.caught_in(texts) == [plain_runs(t) for t in texts]


def test_runs_query_equals_brute_force(spark, sf_dir, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_square_catcher_runs"](spark, sf_dir).collect()}
    assert len(got) == len(texts)
    some = 0
    for key, text in texts:
        words = words_of(text or "")
        h, n = zlib.crc32(str(key).encode()), len(words)
        if n > 2000:
            continue
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, r = plain_runs(words), got[key]
        drop = {i for a, m, q in runs for i in range(a + q, a + m)}
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if runs else (None,) * 3
        assert (r["n_runs"], (r["start"], r["length"], r["period"])) == (len(runs), best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest()
        some += bool(runs)
    assert some > 3


def test_runs_of_odd_rows(spark, docs):
    found = square_catchers.detect(docs)
    got = Counter((r["doc_id"], len(r["runs"]), r["collapsed"][:20]) for r in found.collect())
    assert got == Counter({(None, 0, ""): 2, (7, 0, "one"): 2, (7, 0, "other é"): 1, (8, 0, "x" * 20): 1, (9, 1, "a b"): 1, (-3, 0, ""): 1})
    told = square_catchers.digest(found).where("doc_id = 9").head()
    assert (told["start"], told["length"], told["period"], told["exponent_milli"]) == (0, 60_000, 2, 30_000_000)
    none = square_catchers.digest(found).where("doc_id = -3").head()
    assert none["runs_sha256"] == none["collapsed_sha256"] == hashlib.sha256(b"").hexdigest() and none["start"] is None
    assert square_catchers.detect(docs.limit(0)).count() == 0
    ties = spark.createDataFrame([(1, [(0, 60, 20), (5, 30, 10), (70, 90, 30)], "")],
                                 "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    assert square_catchers.digest(ties).head()["start"] == 0


# Clusters

def plain_clusters(rows, clusters, rounds, seed=2):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [c for _, c in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        to = [nearest(v)[1] for _, v in kept]
        centres = [[sum(x) // len(held) for x in zip(*held)] if (held := [v for (_, v), t in zip(kept, to) if t == k]) else c
                   for k, c in enumerate(centres)]
    told = [nearest(v) for _, v in kept]
    inside = Counter()
    for d, k in told:
        inside[k] += d
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, k, d, inside[k], sum(inside.values()), prints[k]) for (i, _), (d, k) in zip(kept, told))


def clustered(df):
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def test_clusters_query_equals_plain_rounds(spark, sf_dir):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall()
    assert clustered(queries.QUERIES["op13_native_centroids"](spark, sf_dir)) == plain_clusters(rows, 40, 5)


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 64).tolist()) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    rows += [rows[3], rows[3], (100, rows[5][1]), (None, rows[6][1]), (101, None), (102, []), (103, [0.0] * 63), (104, [0.0] * 65),
             (105, [0.0] * 63 + [nan]), (106, [inf] * 64), (107, [None] * 64), (108, [0.0] * 64), (109, [-0.001] * 64), (110, [4e5] * 64)]
    df = spark.createDataFrame([(i, v, "x", "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster string, cells string")
    for clusters, rounds in ((5, 3), (3, 0), (100, 2)):
        assert clustered(centroids.cluster(df, clusters, rounds)) == plain_clusters(rows, clusters, rounds)
    none = centroids.cluster(df.limit(0))
    assert none.count() == 0 and none.columns == centroids.cluster(df, 3, 0).columns


def test_huge_components_are_cut(spark):
    df = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["distance"] for r in centroids.cluster(df, 1, 0).collect()}
    assert max(got.values()) <= 64 * (2 * centroids.MOST) ** 2 < 1 << 63
