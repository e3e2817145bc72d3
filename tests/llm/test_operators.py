"""The operators against plain Python on small tables, with nulls, empty and repeated rows, ties, long texts."""

import gc
import hashlib
import itertools
import math
import re
import weakref
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from subscope.llm import (
    captures, line_quality, main_text, mixing, neighbour_graph, packing, personal_data, quality_rules, queries,
    shingle_join, stages, temporal_lists)
from subscope.llm.common import components, words_of

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(None, None, None, None, None), (900, "", "en", "s", 0), (901, "one", "en", None, 3),
       (901, "one", "en", None, 3), (902, " \n\t ", None, "s", 4), (903, "x" * 30000, "en", "s", 30000),
       (904, "a b " * 9000, "en", "s", 36000)]


@pytest.fixture(scope="module")
def texts(sf_dir):
    path = f"{sf_dir}/documents.parquet"
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{path}' ORDER BY doc_id LIMIT 120").fetchall()


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Given documents, odd ones, and extra columns named like results."""
    return spark.createDataFrame(texts + ODD, DOC).withColumns(
        {c: F.lit("own") for c in ("size", "taken", "stats", "score", "kept", "print", "row", "cell")}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def rows(df):
    return [tuple(r) for r in df.collect()]


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = con.sql(queries.ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(got.columns) == sorted(want.columns)
    same(rows(got), [tuple(r[k] for k in order) for r in want.fetchall()])


# Mixing

def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, left = {}, set(names)
    total = sum(sizes.values())
    while left:
        share = (total - sum(out.values())) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * share > cap * sizes[s]}
        if not over:
            return out | {s: weight[s] * share for s in left}
        out |= {s: cap * sizes[s] for s in over}
        left -= over
    return out


def test_mix(spark, docs):
    got = rows(mixing.mix(mixing.sized(docs)).select("doc_id", "source", "size", "source_size", "target", "copies", "taken"))
    assert len(got) == docs.count()
    sizes, taken, target, most = {}, {}, {}, {}
    for _, s, n, total, goal, copies, words in got:
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + words
        target[s], most[s] = goal, max(most.get(s, 0), n)
        assert words == copies * n <= 3 * n and (n or not copies)
    want = plain_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], want[s], rel_tol=1e-9)
        assert taken[s] <= target[s] and target[s] - taken[s] < max(most[s], 1) + 1
    same(got, rows(mixing.mix(mixing.sized(docs.repartition(5))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")))


def plain_sample(sized, room, seed="mix:"):
    """Rows (id, size) taken to fill ``room`` words, by the definition: probabilities, ranks, first fit."""
    sure, p = set(), {}
    while True:
        others = [k for k, (_, n) in enumerate(sized) if n and k not in sure]
        left, mass = room - sum(sized[k][1] for k in sure), sum(sized[k][1] ** 2 for k in others)
        more = {k for k in others if sized[k][1] * left >= mass}
        if not more:
            break
        sure |= more
    ranked = []
    for k, (doc, n) in enumerate(sized):
        if n:
            digest = hashlib.md5(f"{seed}{'' if doc is None else doc}".encode()).hexdigest()[:13]
            u = (int(digest, 16) + 0.5) / 2.0 ** 52
            p[k] = 1.0 if k in sure else n * left / mass
            if p[k] > 0:
                ranked.append((u / (1 - u) * ((1 - p[k]) / p[k]), -1 if doc is None else doc, n, k))
    taken = set()
    for *_, n, k in sorted(ranked):
        if n <= room:
            taken.add(k)
            room -= n
    return taken, p, room


def test_mix_equals_first_fit_in_rank_order(spark):
    rng = np.random.default_rng(12)
    sized = [(k, str(rng.integers(0, 5)), int(rng.choice([0, 1, 2, 7, 40, 300, 5000], p=[.05, .05, .1, .2, .4, .19, .01])))
             for k in range(1500)]
    sized += [(None, None, 3), (None, None, 9), (7, "0", 7), (7, "0", 7)]
    df = spark.createDataFrame(sized, "doc_id long, source string, size long")
    got = {}
    for r in mixing.mix(df).collect():
        got.setdefault(r["source"], []).append(r)
    for source, found in got.items():
        total, target = found[0]["source_size"], found[0]["target"]
        whole = math.floor(target / total)
        mine = [(d, n) for d, s, n in sized if s == source]
        taken, p, room = plain_sample(mine, math.floor(target - whole * total))
        same([(r["doc_id"], r["size"], r["copies"]) for r in found],
             [(d, n, whole + (k in taken) if n else 0) for k, (d, n) in enumerate(mine)])
        assert math.isclose(sum(r["expected"] for r in found), sum(whole + p[k] for k in p), rel_tol=1e-9)
        assert all(n > room for k, (_, n) in enumerate(mine) if n and k not in taken)


def test_documents_are_taken_at_their_inclusion_probability(spark):
    size = F.element_at(F.array(F.lit(10), F.lit(100), F.lit(30000)), F.when(F.col("id") == 0, 3).otherwise(F.col("id") % 2 + 1).cast("int"))
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), size.cast("long").alias("size"))
    other = spark.range(20000).select((F.col("id") + 20000).alias("doc_id"), F.lit("t").alias("source"), F.lit(50).cast("long").alias("size"))
    got = rows(mixing.mix(docs.union(other)).where("source = 's'").groupBy("size").agg(
        F.avg("copies"), F.avg("expected"), F.count(F.lit(1))))
    assert len(got) == 3
    for n, copies, expected, _ in got:
        assert abs(copies - expected) < 0.02
    assert dict((n, c) for n, c, *_ in got)[30000] == 1


def test_mix_targets_share_the_excess(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 5), (None, 100), ("z", 0)], "source string, source_size long")
    got = {r[0]: r[3] for r in rows(mixing.targets(sources).select("source", "source_size", "weight", "target"))}
    want = plain_targets({"a": 1000, "b": 10, "c": 5, None: 100, "z": 0})
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in want)


def test_inclusion_grows_with_odds(spark):
    sizes = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 2 * 90 + 10).alias("size"))
    other = spark.range(4000).select(F.lit(None).cast("long"), F.lit("t"), F.lit(100).cast("long"))
    got = mixing.mix(sizes.union(other)).where("source = 's'").groupBy("size").agg(F.avg("copies")).collect()
    rate = dict(map(tuple, got))
    assert rate[100] > 1.3 * rate[10] > 0


# Packing

def test_pack_round_trip(spark, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.vocabulary())
    pieces = packing.pack(docs, queries.vocabulary())
    got = rows(pieces.join(packing.digest(pieces).select("sequence_id", "ids_crc32"), "sequence_id").select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "ids_crc32"))
    assert len({r[5] for r in got}) == len(got) and all(r[6] == 0 for r in got)
    assert all(r[2] == 2048 or r[2] & (r[2] - 1) == 0 and r[2] <= 2048 for r in got)
    assert all(zlib.crc32(bytes(r[3])) == r[7] and len(r[3]) == 4 * r[2] for r in got)
    want = {}
    for doc, text in rows(docs.select("doc_id", "text")):
        want.setdefault(doc, []).append(whole.encode(text or "", add_special_tokens=False).ids + [1])
    for doc, parts in itertools.groupby(sorted(got, key=lambda r: (str(r[0]), r[5])), key=lambda r: r[0]):
        ids = np.frombuffer(b"".join(bytes(p[3]) for p in parts), dtype="<u4").tolist()
        assert ids == [x for text in want[doc] for x in text]


def test_chunks_are_encoded_as_in_the_whole_text():
    code = packing.Encoder(queries.vocabulary())
    for text in ["a b", "a\nb c", "a \n b", "a  b", " a", "a ", "a\n", "\na", "it's I'll é ß 12 $%&", "a\tb", "漢字 x",
                 "x <|endoftext|> y", "a\n\nb", " a", "a.b,\"c\"\nD!! e|f"]:
        assert code.encode(text) == code._ids(text), text
    assert packing.lengths(5000, 2048) == [2048, 2048, 512, 256, 128, 8]


def test_words_and_marks_need_no_pattern_and_are_memorised_once(monkeypatch):
    code = packing.Encoder(queries.vocabulary())
    text = "A word, a mark. Größe! naïve; it' and (5) end?\nNext"
    want = code._ids(text)
    asked = []

    class Pattern:
        def findall(self, chunk, of=packing._SPLIT):
            asked.append(chunk)
            return of.findall(chunk)
    monkeypatch.setattr(packing, "_SPLIT", Pattern())
    assert code.encode(text) == want and asked == [" (5)", "\nNext"]
    assert not [p for p in code._pieces if p.strip().isalpha() and len(p) > 5] and "word" in code._chunks


def test_a_chunk_of_many_texts_is_encoded_once(monkeypatch):
    code = packing.Encoder(queries.vocabulary())
    texts = ["A word, a mark.", "", " odd", "word, a word,\nword", "a\n\nb word,", "\na", "x"] * 3
    asked, of = [], code._chunk
    monkeypatch.setattr(code, "_chunk", lambda chunk: asked.append(chunk) or of(chunk))
    ids, at = code.encode_all(texts)
    assert [ids[a:b].tobytes() for a, b in zip(at, at[1:])] == [code._ids(t) for t in texts]
    assert len(asked) == len(set(asked)) and {"word,", "a"} <= set(asked)


def test_an_encoder_goes_with_its_task():
    code = packing.Encoder(queries.vocabulary())
    code.encode_all(["one two, three\nfour 4", "", "five  six"])
    held = [weakref.ref(x) for x in (code, code._chunks, code._pieces)]
    assert code._chunks and code._pieces
    gc.disable()  # a worker's collector seldom runs: few of a task's objects are ones that it counts
    try:
        del code
        assert [x() for x in held] == [None] * 3
    finally:
        gc.enable()


def test_pack_cuts_batches_in_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "one two, three\n" * (k % 7) + "end") for k in range(60)] + [(None, None)], "doc_id long, text string")
    want = sorted(rows(packing.digest(packing.pack(docs.repartition(2), queries.vocabulary(), longest=16)).select(
        "doc_id", "start", "ids_crc32", "doc_tokens")), key=str)
    monkeypatch.setattr(packing, "SLICE", 50)
    got = rows(packing.digest(packing.pack(docs.repartition(2), queries.vocabulary(), longest=16)).select(
        "doc_id", "start", "ids_crc32", "doc_tokens"))
    assert sorted(got, key=str) == want and len({r[0] for r in got}) == 61


# Quality rules

def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    hit = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(words) < 3000 else None
    lines = text.split("\n")
    again = sum(1 for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:k])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, None if hit is None else len(hit)


def test_base_statistics(texts):
    for text in [t[1] for t in texts] + [r[1] for r in ODD] + ["a b c a b c a", "x y z\x1cw", "p\n\np\n p\np"]:
        got, want = quality_rules.text_stats(text), plain_stats(text)
        assert got[:4] == want[:4] and want[4] in (None, got[4])


def test_outliers_go_and_others_stay(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 6)) * [0.2, 0.4, 0.4, 0.4, 0.9, 0.9] + 3
    base[:300, 1] += 9
    df = spark.createDataFrame([("g", *map(float, r)) for r in base], ["grp", *(f"x{i}" for i in range(6))])
    fit = quality_rules.mcd(df)
    d = df.join(fit, "grp").select((quality_rules._distance(6) / F.col("scale")).alias("d"), "x1")
    cut = quality_rules.chi2_quantile(1 - quality_rules.BEYOND, 6)
    bad, good = d.where("x1 > 8"), d.where("x1 <= 8")
    assert bad.where(F.col("d") <= cut).count() <= 5 and good.where(F.col("d") > cut).count() == 0
    center = np.array(fit.first()["center"])
    assert abs(center[1] - 3) < 0.1  # the plain mean is 0.9 off


def plain_mcd(x, pool=None):
    """Center, covariance, precision and scale of one group by the definition."""
    at = lambda v, q: np.sort(v, axis=0)[max(math.ceil(q * len(v)) - 1, 0)]
    ridge = np.diag(np.square(quality_rules.FLOORS))
    center = at(x, 0.5)
    precision = np.linalg.inv(np.diag((1.4826 * at(np.abs(x - center), 0.5)) ** 2) + ridge)
    best = math.inf
    while True:
        d = np.einsum("ni,ij,nj->n", x - center, precision, x - center)
        near = x[d <= at(d, quality_rules.KEEP)]
        own = len(near) / (len(near) + quality_rules.PRIOR) if pool else 1.0
        mean, spread = near.mean(axis=0), np.cov(near.T, bias=True) + ridge
        if pool:
            mean, spread = own * mean + (1 - own) * pool[0], own * spread + (1 - own) * pool[1]
        logdet = np.linalg.slogdet(spread)[1]
        fall = best - logdet
        if fall > 0:
            center, cov, precision, best = mean, spread, np.linalg.inv(spread), logdet
        if not fall > quality_rules.SETTLED:
            break
    d = np.einsum("ni,ij,nj->n", x - center, precision, x - center)
    scale = max(at(d, 0.5) / quality_rules.chi2_quantile(0.5, x.shape[1]), 1.0)
    if pool:
        share = len(x) / (len(x) + quality_rules.PRIOR)
        scale = share * scale + (1 - share) * pool[3]
    return center, cov, precision, scale


def test_estimates_equal_the_definition_and_small_groups_are_judged(spark):
    rng = np.random.default_rng(8)
    groups = {"a": 400, "b": 30, "c": 2, "d": 1}
    x = {g: rng.normal(size=(n, 6)) * [0.2, 0.4, 0.4, 0.4, 0.9, 0.9] + 3 + 0.3 * k for k, (g, n) in enumerate(groups.items())}
    x["b"][0] += 25
    items = [("all", g, *map(float, r)) for g, m in x.items() for r in m]
    df = spark.createDataFrame(items, ["parent", "grp", *(f"x{i}" for i in range(6))])
    whole = quality_rules.mcd(df.withColumn("grp", F.col("parent")))
    fit = {r["grp"]: r for r in quality_rules.mcd(df, whole).collect()}
    pool = plain_mcd(np.concatenate(list(x.values())))
    assert set(fit) == set(groups)
    cut = quality_rules.chi2_quantile(1 - quality_rules.BEYOND, 6)
    for g, m in x.items():
        center, cov, _, scale = plain_mcd(m, pool)
        assert np.allclose(fit[g]["center"], center) and np.allclose(fit[g]["cov"], cov.ravel())
        assert math.isclose(fit[g]["scale"], scale, rel_tol=1e-6)
        gap = m - np.asarray(fit[g]["center"])
        far = np.einsum("ni,ij,nj->n", gap, np.asarray(fit[g]["precision"]).reshape(6, 6), gap) / fit[g]["scale"] > cut
        assert far.tolist() == [g == "b" and k == 0 for k in range(len(m))]


def test_judge_odd_rows(spark, docs, empty):
    got = rows(quality_rules.judge(docs).select("doc_id", "stats.n_words", "base_failed", "kept"))
    assert len(got) == docs.count()
    assert all(r[2] and not r[3] for r in got if r[1] < 50)
    assert quality_rules.judge(empty).count() == 0


# Line field

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    chain = line_quality.Chain(rng.normal(size=line_quality.WIDTH), rng.normal(size=(2, 2)), 0.5)
    lines = rng.normal(size=(6, line_quality.WIDTH)) * 0.3
    total, good = 0.0, np.zeros(6)
    for ys in itertools.product((0, 1), repeat=6):
        s = sum(lines[t] @ chain.weight for t in range(6) if ys[t]) + sum(chain.step[a, b] for a, b in zip(ys, ys[1:]))
        total += math.exp(s)
        good += math.exp(s) * np.array(ys)
    assert np.allclose(chain.marginals(lines), good / total)


def test_fit_gradient():
    rng = np.random.default_rng(2)
    samples = [(rng.normal(size=(n, line_quality.WIDTH)), y) for n, y in ((3, 1), (5, 0), (1, 1))]
    lines = np.vstack([f for f, _ in samples])
    label = np.repeat([1.0, 0.0, 1.0], [3, 5, 1])
    pad = np.full((5, 3), -1)
    for d, (a, n) in enumerate(((0, 3), (3, 5), (8, 1))):
        pad[:n, d] = np.arange(a, a + n)
    args = (lines, label, np.array([0, 3, 8]), None, 3, 5, pad)
    w, s = rng.normal(size=line_quality.WIDTH) * 0.3, rng.normal(size=(2, 2)) * 0.3
    _, gw, gs = line_quality._gradient(w, s, *args)
    for k in (0, 4):
        e = np.eye(line_quality.WIDTH)[k] * 1e-5
        num = (line_quality._gradient(w + e, s, *args)[0] - line_quality._gradient(w - e, s, *args)[0]) / 2e-5
        assert abs(num - gw[k]) < 1e-4
    e = np.array([[0, 1e-5], [0, 0]])
    num = (line_quality._gradient(w, s + e, *args)[0] - line_quality._gradient(w, s - e, *args)[0]) / 2e-5
    assert abs(num - gs[0, 1]) < 1e-4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op7_line_crf_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    got = rows(scored.where("held_out").select("quality", "score", "predicted"))
    good, bad = [s for q, s, _ in got if q], [s for q, s, _ in got if not q]
    auc = np.mean([g > b for g in good for b in bad])
    assert auc > 0.97 and np.mean([p for q, _, p in got if q]) > 0.98 and np.mean([p for q, _, p in got if not q]) < 0.3


def test_classify_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(k, k % 3 and 1) for k in range(100)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = rows(line_quality.classify(docs, labels))
    assert len(got) == docs.count() and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.3) for r in got)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in got if r[0] is not None)
    assert line_quality.classify(empty, labels).count() == 0
    assert line_quality.classify(docs, labels.limit(0)).count() == docs.count()


# Personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split("."))
                    or kind == "card" and not (16 <= len(d) <= 19 and sum(
                        int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0)
                    or kind == "phone" and not 8 <= len(d) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


CASES = ["", "@", "a@b", "a@b.c@d.e", "x.y+z@mail.example.com.", "1.2.3.4.5.6.7.8", "1.2.3.256 01.002.3.4",
         "4111 1111-1111 1111 x 4111111111111112", "+1 (017) 555-7713", "+1 (017) 555-7713 4111111111111111", "++12345678+",
         "a@@b.c", "é.a@b-c.d_e", "é@x.y", "1.2.3.4@5.6", "9" * 40, "1" * 5000 + "." + "2", "+1" + " " * 50 + "2"]


def test_base_spans_equal_the_patterns(texts):
    for text in CASES + [t[1] for t in texts]:
        assert personal_data.base_spans(text) == plain_spans(text), text[:60]


def test_best_segmentation_equals_enumeration():
    rng = np.random.default_rng(3)
    field = personal_data.Field()
    field.step = rng.normal(size=(5, 5))
    segments = [(i, j, k, rng.normal(size=personal_data.N_FEATURES).tolist())
                for i in range(5) for j in range(i + 1, 6) for k in range(4) if rng.random() < 0.4]
    field.weight = rng.normal(size=field.weight.shape)

    def walks(at, before):
        if at == 5 + 1:
            yield 0.0, ()
            return
        for i, j, k, s in [(at, at + 1, 4, 0.0)] + [
                (i, j, k, float(field.weight[k] @ f)) for i, j, k, f in segments if i == at]:
            for rest, path in walks(j, k):
                yield rest + s + field.step[before, k], (((i, j, k),) if k < 4 else ()) + path
    assert field.best(6, segments) == list(max(walks(0, 4))[1])


def test_touching_numbers_are_split(spark, sf_dir):
    field = personal_data.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    text = "call +1 (017) 555-7713 4111111111111111 now"
    assert personal_data.found(text, field) == ("", "card:23:39,phone:5:22")
    assert personal_data.masked(text, field) == "call <PHONE> <CARD> now"
    for clean in ("chapter 12, 1990-2020 and 3.14", "token = \"a5da8e9b33fb57beea5cace8e768dbb6a7b2fce6\"", "1234567890123456"):
        assert personal_data.found(clean, field) == ("", "")
    assert personal_data.masked(None, field) is None and personal_data.masked("", field) == ""


def test_find_keeps_base_spans(spark, docs, empty):
    got = rows(personal_data.find(docs))
    assert len(got) == docs.count()
    want = {d: t for d, t in rows(docs.select("doc_id", "text"))}
    order = list(PLAIN)
    for doc, base, spans in got:
        listed = sorted(plain_spans(want[doc] or ""), key=lambda s: (order.index(s[0]), s[1]))
        assert base == ",".join(f"{k}:{a}:{b}" for k, a, b in listed)
        assert set(filter(None, base.split(","))) <= set(spans.split(","))
    assert personal_data.find(empty).count() == 0


# Jaccard join

def plain_join(items, threshold=0.8):
    sets = []
    for doc, text in items:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else None)
    n = len(items)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j] and
             len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9] for i in range(n)]
    out = []
    for i in range(n):
        seen, front = {i}, [i]
        while front:
            front = [j for f in front for j in near[f] if j not in seen and not seen.add(j)]
        name = lambda s: min((items[j][0] for j in s if items[j][0] is not None), default=None)
        equal = {j for j in range(n) if sets[j] == sets[i]} if sets[i] else {i}
        out.append((items[i][0], name(equal), name(seen), len(near[i])))
    return out


@pytest.fixture(scope="module")
def near_texts(texts):
    rng = np.random.default_rng(7)
    out = [(d, t) for d, t, *_ in texts[:40]] + [(d, t) for d, t, *_ in ODD]
    base = " ".join(t for _, t, *_ in texts[40:44]).split()[:300]
    for k in range(60):  # a chain of near copies, more than a block would hold in the test below
        w = list(base)
        for j in rng.integers(0, len(w), k % 9):
            w[j] = f"new{k}"
        out.append((2000 + k, " ".join(w)))
    return out + [(3000, "four words are here"), (3001, "four words  are here"), (3002, "Four words are here"), (None, "four words are here")]


def test_join_equals_brute_force(spark, near_texts, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 16)
    df = spark.createDataFrame(near_texts, "doc_id long, text string").withColumn("print", F.lit(1))
    got = rows(shingle_join.join(df))
    same(got, plain_join(near_texts))
    assert max(r[3] for r in got) > 20


def test_join_empty(spark, empty):
    assert shingle_join.join(empty).count() == 0
    assert shingle_join.kept_once(empty).count() == 0


def test_a_task_leaves_no_words_in_its_worker(spark, near_texts):
    df = spark.createDataFrame(near_texts, "doc_id long, text string")
    assert shingle_join._signed(df, "doc_id", "text").where("print IS NOT NULL").count() > 0

    @F.pandas_udf("long")
    def left(ids: pd.Series) -> pd.Series:
        from subscope.llm import shingle_join

        return ids * 0 + len(shingle_join._MEMO)
    assert spark.range(0, 64, 1, 16).select(left("id").alias("n")).agg(F.max("n")).first()[0] == 0


def test_one_of_each_group_stays(spark, near_texts):
    df = spark.createDataFrame([(d, t, 1) for d, t in near_texts], "doc_id long, text string, print int")
    got = rows(shingle_join.kept_once(df))
    groups = plain_join(near_texts)
    wordless = [(d, t, 1) for d, t in near_texts if not (t or "").split()]
    named = {g for (d, _, g, _), (_, t) in zip(groups, near_texts) if (t or "").split()}
    assert sorted(r[0] for r in got if (r[1] or "").split()) == sorted(named)
    same([r for r in got if not (r[1] or "").split()], wordless)


def test_meeting_probability():
    depth = next(d for d in range(shingle_join.DEEPEST, 0, -1) if shingle_join.meeting(d, 0.8) >= shingle_join.RECALL)
    assert shingle_join.meeting(depth, 0.8) >= shingle_join.RECALL > shingle_join.meeting(depth + 1, 0.8)


def test_components(spark):
    edges = [(5, 4), (4, 3), (9, 8), (1, 1), (7, 9)] + [(100 + k, 101 + k) for k in range(30)]
    got = dict(rows(components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {3: 3, 4: 3, 5: 3, 7: 7, 8: 7, 9: 7} | {100 + k: 100 for k in range(31)}


# Embeddings

def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "BLOCK", 16)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 32))
    x[:60] = x[0] + rng.normal(size=(60, 32)) * 0.10  # a large group near the threshold
    x[60:70] = x[60]
    x[100] = x[60] * 3
    x[200:203] = x[200] + rng.normal(size=(3, 32)) * 0.05
    x = x.astype("float32")
    items = [(k, x[k].tolist(), int(k >= 300)) for k in range(400)]
    items += [(500, None, 0), (501, [0.0] * 32, 0), (502, [float("nan")] * 32, 0), (503, [1.0, None] * 16, 0), (504, [], 0),
              (505, x[0].tolist(), None), (506, x[0].tolist()[:16], 0), (399, x[399].tolist(), 1), (None, x[350].tolist(), 1)]
    df = spark.createDataFrame(items, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit(0))
    got = rows(neighbour_graph.near_duplicates(df))
    sound = [v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v) and b is not None for _, v, b in items]

    def linked(i, j):
        (_, a, p), (_, b, q) = items[i], items[j]
        if i == j or not sound[i] or not sound[j] or p != q or len(a) != len(b):
            return False
        a, b = np.array(a, dtype=float), np.array(b, dtype=float)
        return a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98
    n = len(items)
    near = [[j for j in range(n) if linked(i, j)] for i in range(n)]
    want = []
    for i in range(n):
        seen, front = {i}, [i]
        while front:
            front = [j for f in front for j in near[f] if j not in seen and not seen.add(j)]
        least = min((items[j][0] for j in seen if items[j][0] is not None), default=None)
        want.append((items[i][0], len(near[i]), least, items[i][0] is not None and items[i][0] == least))
    same(got, want)
    assert max(r[1] for r in got) > 30


def test_copies_of_copies_stay_one_component_however_many_rounds(spark, monkeypatch):
    found = iter([0.0, 0.0, 0.0])
    monkeypatch.setattr(neighbour_graph, "audit", lambda *args: next(found, 1.0))
    rng = np.random.default_rng(3)

    def near(x, far, n):
        y = rng.normal(size=(n, 64))
        return x + far * y / np.linalg.norm(y, axis=1)[:, None]
    x = rng.normal(size=64)
    x = np.vstack([near(c, 0.02, 12) for c in near(x / np.linalg.norm(x), 0.1, 6)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert (x @ x.T).min() >= 0.98
    got = rows(neighbour_graph.near_duplicates(spark.createDataFrame(
        [(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")))
    same(got, [(k, 71, 0, k == 0) for k in range(72)])


def test_audit_sees_small_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 16))
    x[1] = x[0] + 0.01
    x[3] = x[2] + 0.01
    items = [(k, "a", b"\x08" + v.astype("<f8").tobytes(), 5000 if k < 2 else 1) for k, v in enumerate(x)]
    nodes = spark.createDataFrame(items, "node long, grp string, vec binary, weight long")
    true, sampled, evident = neighbour_graph.sampled_truth(nodes, 0.98)
    assert true == {0: 1, 1: 1, 2: 1, 3: 1} and sampled == 900 and evident
    assert not neighbour_graph.sampled_truth(nodes, 0.98, sample=2, most=8)[2]
    links = spark.createDataFrame([(0, 0, 5000, 1), (1, 0, 5000, 1)], "node long, cluster long, links long, near long")
    assert neighbour_graph.audit(true, links) == 0.5


def test_labels_below_recall_are_compared_whole_and_orders_follow_the_size(spark, monkeypatch):
    assert [neighbour_graph._orders(n, 0.98) for n in (1, 100, 10**7)][:2] == [4, 4]
    assert neighbour_graph._orders(10**5, 0.98) > 4 and neighbour_graph._orders(10**7, 0.98) > 8
    x = np.random.default_rng(1).normal(size=(60, 8))
    x[1], x[40] = x[0] + 0.001, x[39] + 0.001
    df = spark.createDataFrame([(k, v.tolist(), k // 30) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(neighbour_graph, "ROUNDS", 1)
    monkeypatch.setattr(neighbour_graph, "audit", lambda *args: 0.5)
    # No order and no list finds anything: only whole labels do.
    monkeypatch.setattr(neighbour_graph, "_ordered_neighbours", lambda nodes, turn, threshold: nodes.selectExpr("node", "node AS other", "0D AS s").limit(0))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbour_graph.near_duplicates(df).collect()}
    assert got[0] == got[1] == (1, 0) and got[39] == got[40] == (1, 39) and sum(n for n, _ in got.values()) == 4


def test_rare_links_are_found_by_planted_evidence(spark, monkeypatch):
    turns = []
    orders = neighbour_graph._ordered_neighbours
    monkeypatch.setattr(neighbour_graph, "_ordered_neighbours", lambda n, t, h: turns.append(t) or orders(n, t, h))
    monkeypatch.setattr(neighbour_graph, "AUDIT_MOST", 800)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(0, 20, 2):  # pairs just above the threshold
        away = rng.normal(size=64)
        away -= (away @ x[k]) * x[k]
        x[k + 1] = 0.981 * x[k] + np.sqrt(1 - 0.981 ** 2) * away / np.linalg.norm(away)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["component_id"] for r in neighbour_graph.near_duplicates(df).where("n_links > 0").collect()}
    assert got == {k: k - k % 2 for k in range(20)}
    assert len(turns) <= 3


def test_near_vectors_empty(spark):
    assert neighbour_graph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# Captures

def test_archive_round_trip(spark, monkeypatch):
    monkeypatch.setattr(captures, "BLOCK", 3)
    big, other = "<p>é" + "x" * 2000, "<p>" + "y" * 2000
    items = [(k, f"https://u:p@Host{k % 4}.Example.com:80/a b/{k % 5}?q={k}#f", big if k % 3 else other) for k in range(30)]
    items += [(40, None, big), (41, "http://x.y/", None), (42, "nonsense", ""), (43, "http://x.y/", "short"), (44, "http://x.y/\r\nX: 1", "short"),
              (None, "http://x.y/n", big), (45, "http://x.y/c", "c\r\n\r\nc" * 300), (45, "http://x.y/c", "c\r\n\r\nc" * 300)]
    pages = spark.createDataFrame(items, "page_id long, url string, html string").repartition(3).withColumn("key", F.lit(1)).cache()
    got = rows(captures.archive(pages).captures(pages).select(
        F.col("page_id").cast("long"), "url", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"), "payload"))
    keep = {}
    for i, _, h in items:
        if len((h or "").encode()) >= 1000:
            keep[h] = max(keep.get(h, -1), -1 if i is None else i)
    want = []
    for i, _, h in items:
        data = (h or "").encode()
        kept = keep.get(h, i) if len(data) >= 1000 else i
        revisit = kept != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                     kept if revisit else None, None if revisit else data))
    same([(r[0], *r[2:6], None if r[6] is None else bytes(r[6])) for r in got], want)


def test_single_lookup(spark):
    pages = spark.createDataFrame([(k, f"http://h{k % 7}.org/{k}", "t") for k in range(200)], "page_id long, url string, html string")
    store = captures.archive(pages)
    asked = spark.createDataFrame([("https://H3.org/3",), ("http://h3.org/4",), (None,)], "url string")
    assert [r[0] for r in store.captures(asked).select("page_id").collect()] == ["3"]
    none = captures.archive(pages.limit(0))
    assert none.captures(asked).count() == 0
    assert captures.surt("http://a@B.c.Org:8/x?y#z") == "org,c,b)/x?y" and captures.surt("http://b.org?q") == "org,b)?q"


# Lists

def test_lists_are_judged_as_of_the_fetch(spark):
    events = spark.createDataFrame([
        ("bad", "d:x.org", "add", 10), ("bad", "d:x.org", "remove", 20), ("bad", "d:x.org", "add", 300),
        ("bad", "d:x.org", "add", 20), ("ads", "p:a.x.org/p/", "add", 5), ("ads", "p:a.x.org/p/", "add", 6),
        (None, "d:x.org", "add", 1), ("bad", None, "add", 1), ("bad", "d:y.org", "add", None), ("bad", "d:y.org", "remove", 3)],
        "list string, key string, action string, day long")
    urls = ["http://x.org/", "http://a.x.org/p/q", "http://a.x.org/p", "http://yx.org/", "http://y.org/", None, "", "x.org"]
    items = [(u, d) for u in urls for d in (4, 5, 10, 19, 20, 299, 300, None)] * 2
    df = spark.createDataFrame(items, "url string, day long").withColumns({"key": F.lit(1), "lists": F.lit("own")})
    got = rows(temporal_lists.judge(df, temporal_lists.intervals(events)).select("url", "day", "lists", "n_entries", "blocked"))

    def told(u, d):
        out = []
        if u and d is not None:
            if re.match(r"http://([^/]*\.)?x\.org/", u) and (10 <= d < 20 or d >= 300):
                out.append("bad")
            if u.startswith("http://a.x.org/p/") and d >= 5:
                out.append("ads")
        return u, d, ",".join(sorted(out)), len(out), bool(out)
    same(got, [told(u, d) for u, d in items])


def test_lists_empty(spark):
    none = spark.createDataFrame([], "list string, key string, action string, day long")
    df = spark.createDataFrame([("http://x.org/", 3)], "url string, day long")
    assert rows(temporal_lists.judge(df, temporal_lists.intervals(none)).select("n_entries")) == [(0,)]
    assert temporal_lists.judge(df.limit(0), temporal_lists.intervals(none)).count() == 0


# Main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="post-comments">
<header>Site <b>name</b></header><nav><ul><li>Home</li></ul></nav><div class="ad-box">Buy</div><!-- <p>no</p> -->
<article class="post"><header><h1>A &amp; B</h1></header><p>One<b>two</b>
 three&nbsp;<br>four</p><div class="share">Share</div><p>five &lt;six&gt;<p><b>seven
<section id="comments"><article>me first</article></section></article>
<aside>side</aside><form><p>mail</p></form><footer>&copy; 2020</footer></body>"""


def test_article_without_the_rest():
    assert main_text.split_page(PAGE)[0] == "A & B Onetwo three four five <six> seven"
    assert main_text.split_page(None)[0] == "" and main_text.split_page("<p")[0] == ""
    assert main_text.split_page("<article>a &am")[0] == "a &am" and main_text.split_page("<nav>x<article>y</article>")[0] == "y"


def test_repeats_of_a_host_go_where_no_article_is_marked(spark):
    lead = "this long notice is on every page of the host indeed"
    own = [f"page {k} says something of its own {k * 7} and then {k * 13} ends" for k in range(12)]
    items = [(k, f"http://h.org/{k}", f"<body><div>{lead}</div><p>{own[k]}</p><div class=footer>f</div></body>") for k in range(12)]
    items += [(90, "http://alone.org/", f"<div>{lead}</div><p>text</p>"), (91, None, None), (92, "http://h.org/a", ""),
              (93, "http://h.org/b", f"<article><p>{lead}</p><p>more</p></article>"), (93, "http://h.org/b", f"<article><p>{lead}</p><p>more</p></article>"),
              (94, "http://long.org/", "<article>" + "<p>word</p>" * 20000)]
    pages = spark.createDataFrame(items, "page_id long, url string, html string").withColumns(
        {"text": F.lit("own"), "row": F.lit(1), "host": F.lit("")})
    got = {r[0]: r[2] for r in rows(main_text.extract(pages))}
    for k in range(12):
        assert got[k] == own[k]
    assert got[90] == f"{lead} text" and got[91] == got[92] == "" and got[93] == f"{lead} more" and len(got[94]) == 99999
    assert main_text.extract(pages).count() == len(items) and main_text.extract(pages.limit(0)).count() == 0


def test_doubtful_blocks_of_an_article_are_decided_by_the_host(spark):
    notice = "subscribe now and read every story of this site without limits"
    menu = "home news sport culture weather about us contact"
    rng = np.random.default_rng(9)

    def own(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    items, want = [], {}
    for k in range(20):
        head, lead, tail, unique = own(4), own(60), own(40), own(12)
        items.append((k, f"http://h.org/{k}", f"<ul class=menu><li>{menu}</ul><article><h1>{head}</h1><div class='entry'><p>{lead}</p>"
                      f"<div class='box-7'>{notice}</div><p>{tail}</p><div class='social-history'><p>{unique}</p></div>"
                      f"<p class='banner-year'>{head}</p></div></article>"))
        want[k] = f"{head} {lead} {tail} {unique} {head}"
    # Copies and repeats of an article's own paragraphs are no boilerplate.
    same_lead, box = own(60), own(15)
    copy = f"<article><p>{same_lead}</p><div class='figure-2'>{box}</div></article>"
    items += [(30, "http://h.org/30", copy), (31, "http://h.org/31", copy + "<div class=footer>x</div>"),
              (32, "http://h.org/32", f"<article><p>{same_lead}</p><p>{own(70)}</p></article>"),
              (33, "http://other.org/", f"<article><p>{own(60)}</p><div class='box-7'>{notice}</div></article>")]
    pages = spark.createDataFrame(items, "page_id long, url string, html string")
    got = {r[0]: r for r in rows(main_text.extract(pages))}
    for k in range(20):
        assert got[k][2] == want[k] and got[k][4] and got[k][5] >= len((notice + " " + menu).split())
    assert got[30][2] == got[31][2] == f"{same_lead} {box}"
    assert got[32][2].startswith(same_lead) and got[33][2].endswith(notice)


def test_a_box_that_quotes_another_article_is_in_the_host_array(spark):
    rng = np.random.default_rng(11)

    def own(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    lead, plain, other, unique = own(30), own(40), own(40), own(12)
    quote = f"<div class='box-1'>{' '.join(lead.split()[:15])}</div>"
    pages = spark.createDataFrame([
        (1, "http://h.org/1", f"<article><p>{lead}</p><p>{plain}</p></article>"),
        (2, "http://h.org/2", f"<article><p>{other}</p>{quote}<div class='box-2'>{unique}</div></article>"),
        (3, "http://h.org/3", f"<article><p>{own(50)}</p><p>{plain}</p></article>"),
        (4, "http://i.org/4", f"<article><p>{other}</p>{quote}</article>")], "page_id long, url string, html string")
    got = {r[0]: r for r in rows(main_text.extract(pages))}
    assert got[2][2] == f"{other} {unique}" and got[2][5] == 15
    # Plain paragraphs stay though another article has them; another host's array does not count.
    assert got[1][2] == f"{lead} {plain}" and got[3][2].endswith(plain) and got[4][2].startswith(other + " w")
    streams = spark.createDataFrame([("h", lead.split(), 1)], "host string, stream array<string>, page long")
    again = spark.createDataFrame([("h", lead.split(), 2), ("h", plain.split(), 2), ("h", plain.split(), 3)], streams.schema)
    assert main_text.repeated(streams).count() == 0 and main_text.repeated(streams, again).count() == 30 - main_text.LEAST + 1


def test_articles_are_in_the_array_of_hosts_without_an_open_block(spark):
    rng = np.random.default_rng(12)

    def own(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    lead, menu = own(30), own(9)
    pages = spark.createDataFrame([
        (1, "http://h.org/1", f"<article><p>{lead}</p></article>"),
        (2, "http://h.org/2", f"<article><p>{own(40)}</p></article><aside>{' '.join(lead.split()[5:20])}</aside>"),
        (3, "http://h.org/3", f"<nav>{menu}</nav><article><p>{own(20)}</p></article>"),
        (4, "http://i.org/4", f"<nav>{' '.join(lead.split()[5:20])}</nav><article><p>{own(20)}</p></article>")], "page_id long, url string, html string")
    got = {r[0]: r for r in rows(main_text.extract(pages))}
    assert got[1][2] == lead and [got[k][5] for k in (1, 2, 3, 4)] == [0, 15, 0, 0]


def test_articles_suffixes_are_sorted_only_where_they_may_meet_one_that_is_asked(spark):
    rng = np.random.default_rng(13)
    texts = [(f"h{k % 3}", [f"w{x}" for x in rng.integers(0, 4, 50)], k) for k in range(12)]
    streams = spark.createDataFrame([(h, t[:12] if k % 2 else [], k) for h, t, k in texts], "host string, stream array<string>, page long")
    certain = spark.createDataFrame([(h, " ".join(t), k) for h, t, k in texts] + [("h0", "", 90)], "host string, stream string, page long")
    asked = main_text._asked(streams)
    few = rows(main_text._stream_suffixes(certain, asked))
    every = rows(main_text._stream_suffixes(certain))
    heads = {(h, s[:4 * main_text.LEAST]) for h, s, _ in rows(main_text._stream_suffixes(streams))}
    assert few == [r for r in every if (r[0], r[1][:4 * main_text.LEAST]) in heads] and 0 < len(few) < len(every)


def test_certain_and_doubtful_names():
    told = {name: main_text._unwanted("div", f" class='{name}'", True) for name in
            ("share", "share-buttons", "newsletter-box", "social-history", "banner-year", "box-7", "")}
    assert {k for k, (why, _) in told.items() if why} == {"share", "share-buttons", "newsletter-box"}
    assert {k for k, (_, doubt) in told.items() if doubt} == {"social-history", "banner-year", "box-7"}
    assert main_text._unwanted("p", " class='lead'", True) == ("", False)
    assert main_text._unwanted("div", " class='social-history'", False)[0] == "social"


def test_no_page_text_is_broadcast(spark, monkeypatch):
    joined = []

    def sized(big, written, on, how="inner"):
        joined.append(written.columns)
        return big.join(F.broadcast(written), on, how)
    monkeypatch.setattr(main_text, "sized_join", sized)
    pages = spark.createDataFrame([(1, "http://h.org/1", "<p>open text"), (2, "http://h.org/2", "<article>marked")],
                                  "page_id long, url string, html string")
    got = rows(main_text.extract(pages))
    same([(r[0], r[2], r[3], r[4], r[5]) for r in got], [(1, "open text", 9, False, 0), (2, "marked", 6, True, 0)])
    assert joined == [["row", "n_boilerplate"]]


def test_repeated_runs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    streams = [(k, "h", [f"w{x}" for x in rng.integers(0, 3, 60)]) for k in range(4)]
    df = spark.createDataFrame(streams, "row long, host string, stream array<string>")
    again = main_text.repeated(df)
    hit = rows(main_text._places(df).join(again, "key").select("row", "at", "shared"))
    got = {(r, a + j) for r, a, n in hit for j in range(n)}
    want = set()
    for (r, _, s), (q, _, t) in itertools.permutations(streams, 2):
        grams = {tuple(t[k:k + main_text.LEAST]) for k in range(len(t) - main_text.LEAST + 1)}
        for k in range(len(s) - main_text.LEAST + 1):
            if tuple(s[k:k + main_text.LEAST]) in grams:
                want |= {(r, k + j) for j in range(main_text.LEAST)}
    assert got == want


# Stages

def test_stages(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    names = docs.columns
    good = stages.quality(spark, docs, sf)
    assert good.columns == names and 0 < good.count() <= docs.count()
    masked = stages.personal(spark, docs, sf)
    assert masked.columns == names and masked.count() == docs.count()
    assert masked.where("n_chars <> length(text)").count() == 0 and masked.where("text IS NULL").count() == 1
    mixed = stages.mix(spark, docs, sf)
    assert mixed.columns == names
    plan = mixing.mix(mixing.sized(docs)).agg(F.sum("taken")).first()[0]
    got = mixing.sized(mixed).agg(F.sum("size")).first()[0]
    assert abs(got - plan) < 0.2 * plan
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 6  # twice 901
    for stage in (stages.quality, stages.near_duplicates, stages.personal, stages.mix, stages.pack):
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_decisions_hold(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs.unionAll(docs.limit(5)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "line_crf_quality" and len(corpus_pipeline.STAGES) == 5
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.groupBy("sequence_id").count().where("count > 1").count() == 0
    kept = {r[0] for r in out.select("doc_id").distinct().collect()}
    bad = {r[0] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 0").collect()}
    assert len(kept & bad) < 0.1 * len(bad) and len(kept) > 500


def test_words(texts):
    for t in CASES + ["a b\x1cc　d", "\x85"] + [t[1] for t in texts]:
        assert words_of(t) == re.findall(r"[^\x20\x09-\x0D]+", t)
