"""Operators against brute force on small rows, including one hot key and null keys."""

import random
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from subscope.functions import aggregates as ag
from subscope.functions import columns as x
from subscope.operators import groups as g
from subscope.operators import intervals as iv
from subscope.operators import joins as j
from subscope.operators import ordered as o
from subscope.operators import reshape as r
from subscope.operators import statistics as st
from subscope.plans.engagement import months, weeks_touched
from subscope.plans.sampling import sample_users, stratified_split


def rows(df, *cols):
    return sorted((tuple(row) for row in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows; one key holds a third of them, one key is null, values repeat and are null."""
    rng = random.Random(5)
    data = []
    for i in range(300):
        key = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rng.randrange(12)}")
        day = date(2024, 1, 1) + timedelta(days=rng.randrange(60))
        data.append((i, key, day, rng.choice([None, *range(6)]), rng.randrange(1000) / 10))
    return data, spark.createDataFrame(data, "id int, k string, d date, v int, amount double")


def duck(data, sql):
    con = duckdb.connect()
    con.execute("create table t (id int, k varchar, d date, v int, amount double)")
    con.executemany("insert into t values (?, ?, ?, ?, ?)", data)
    return sorted(con.execute(sql).fetchall(), key=str)


def test_keep_group_max_keeps_ties_and_null_group(skewed):
    data, df = skewed
    want = duck(data, "select id from (select *, max(v) over (partition by k) m from t) where v = m")
    assert rows(g.keep_group_max(df, ["k"], "v"), "id") == want
    want = duck(data, "select id from (select *, min(v) over (partition by k) m from t) where v = m")
    assert rows(g.keep_group_min(df, ["k"], "v"), "id") == want


def test_group_stat_reaches_null_keys(skewed):
    data, df = skewed
    want = duck(data, "select id, max(v) over (partition by k) from t")
    assert rows(g.with_group_stat(df, ["k"], {"m": F.max("v")}), "id", "m") == want


def test_sequence_number_equals_row_number(skewed):
    data, df = skewed
    want = duck(data, "select id, row_number() over (partition by k order by d, id) from t")
    for bucket in (F.col("d"), F.trunc("d", "month"), F.lit(1)):
        assert rows(o.sequence_number(df, ["k"], ["d", "id"], bucket, "n"), "id", "n") == want


def test_dense_number_equals_dense_rank(skewed):
    data, df = skewed
    want = duck(data, "select id, dense_rank() over (partition by k order by d) from t")
    assert rows(o.dense_number(df, ["k"], "d", F.trunc("d", "week"), "n"), "id", "n") == want


@pytest.mark.parametrize("step,fn", [(1, "lead"), (-1, "lag")])
def test_neighbour_crosses_buckets_and_keeps_nulls(skewed, step, fn):
    data, df = skewed
    want = duck(data, f"select id, {fn}(v) over w, {fn}(d) over w from t "
                      "window w as (partition by k order by d, id)")
    out = o.neighbour(df, ["k"], ["d", "id"], F.trunc("d", "week"), {"nv": "v", "nd": "d"}, step)
    assert rows(out, "id", "nv", "nd") == want


def test_running_sum_and_carry_forward(skewed):
    data, df = skewed
    want = duck(data, "select id, count(v) over (partition by k order by d, id) from t")
    seen = df.withColumn("one", F.col("v").isNotNull().cast("int"))
    out = o.running_sum(seen, ["k"], ["d", "id"], F.trunc("d", "week"), "one", "s")
    assert rows(out, "id", "s") == want
    want = duck(data, "select id, last_value(v ignore nulls) over (partition by k order by d, id "
                      "rows unbounded preceding) from t")
    out = o.carry_forward(df, ["k"], ["d", "id"], F.trunc("d", "week"), "v", "f")
    assert rows(out, "id", "f") == want


@pytest.mark.parametrize("by", [["k"], []])
def test_quantiles_are_exact(skewed, by):
    data, df = skewed
    group = "group by k" if by else ""
    want = duck(data, f"select {'k,' if by else ''} quantile_cont(amount, 0.1), median(amount), "
                      f"quantile_cont(amount, 0.95) from t {group}")
    out = o.quantiles(df, by, "amount", [0.1, 0.5, 0.95], ["a", "b", "c"], parts=8)
    got = rows(out, *by, "a", "b", "c")
    assert len(got) == len(want)
    for u, v in zip(got, want):
        assert u[: len(by)] == v[: len(by)]
        assert u[len(by):] == pytest.approx(v[len(by):])


def test_quantile_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None)], "k string, v double")
    assert rows(o.quantiles(df, ["k"], "v", [0.5], ["m"]), "k", "m") == [("a", 5.0)]


def test_day_streaks_over_month_end_and_single_days(spark):
    days = ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-05", "2024-02-28", "2024-02-29",
            "2024-03-01", "2024-01-31"]
    df = spark.createDataFrame([("u", d) for d in days], "u string, d string").withColumn(
        "d", F.to_date("d"))
    got = rows(o.day_streaks(df, ["u"], "d"), "start", "end", "n_days")
    assert sorted(got) == [
        (date(2024, 1, 30), date(2024, 2, 1), 3), (date(2024, 2, 5), date(2024, 2, 5), 1),
        (date(2024, 2, 28), date(2024, 3, 1), 3),
    ]


def test_streak_days_sum_to_distinct_days(skewed):
    data, df = skewed
    total = o.day_streaks(df, ["k"], "d").agg(F.sum("n_days")).first()[0]
    assert total == df.select("k", "d").distinct().count()


def test_top_k_keeps_ties_at_the_edge(spark):
    df = spark.createDataFrame(
        [("a", "x", 9), ("a", "y", 7), ("a", "z", 7), ("a", "w", 1), ("b", "x", 3)],
        "k string, n string, w int")
    assert rows(g.top_k_ties(df, 2, "w"), "n", "w") == [("x", 9), ("y", 7), ("z", 7)]
    assert len(rows(g.top_k_ties(df, 2, "w", ["k"]), "k", "n")) == 4
    assert len(rows(g.top_k_ties(df, 99, "w"), "n")) == 5


def test_shares_sum_to_100_within_the_stated_group(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 5)],
                               "k string, n string, w int")
    per_group = g.share_of(df, ["k"], "w")
    assert rows(per_group, "k", "n", "share") == [
        ("a", "x", 25.0), ("a", "y", 75.0), ("b", "x", 100.0)]
    overall = g.share_of(df, [], "w").agg(F.sum("share")).first()[0]
    assert overall == pytest.approx(100)


def test_tuple_distinct_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (1, 2)], "a int, b int")
    assert df.agg(ag.n_distinct("a", "b")).first()[0] == 3
    assert df.agg(F.count_distinct("a", "b")).first()[0] == 1


def test_sums_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    row = df.agg(ag.sum0("b"), ag.sum_if(F.col("a") > 5, "a"), F.max("b"),
                 ag.mean_if(F.col("a") > 5, "a")).first()
    assert tuple(row) == (0, 0, None, None)


def test_distinct_rollup_counts_a_key_once(spark):
    df = spark.createDataFrame(
        [("g", 1, 5, True), ("g", 1, 7, False), ("g", 2, 1, False), ("h", 1, 2, None)],
        "g string, k int, v int, f boolean")
    out = ag.distinct_rollup(df, ["g"], ["k"], {"flagged": F.col("f")}, {"s": F.col("v")})
    assert rows(out, "g", "n", "flagged", "s", "s_n") == [("g", 2, 1, 13, 3), ("h", 1, 0, 2, 1)]


def test_unknown_condition_stays_unknown(spark):
    df = spark.createDataFrame([(None,), (1,), (3,)], "a int")
    out = df.select("a", x.if_na(F.col("a") > 2, F.lit("y"), F.lit("n")).alias("r"))
    assert rows(out, "a", "r") == [(1, "n"), (3, "y"), (None, None)]


def test_anti_join_survives_nulls_on_both_sides(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(j.anti_on(a, ["k"], b), "k") == [(2,)]
    assert rows(j.semi_in(a, ["k"], b), "k") == [(1,), (None,)]
    assert rows(j.anti_on(a, ["k"], b.where("k = 1")), "k") == [(2,), (None,)]


def test_missing_on_either(spark):
    a = spark.createDataFrame([(1, 1), (1, 9), (9, 1), (9, 9)], "p int, q int")
    ref = spark.createDataFrame([(1, 2), (2, 1)], "p int, q int")
    out = j.missing_on_either(a, ref, ("p", "p"), ("q", "q"))
    assert rows(out, "p", "q") == [(1, 9), (9, 1), (9, 9)]


def test_next_term_does_not_bridge_gaps(spark):
    df = spark.createDataFrame([("s", 1, 10), ("s", 2, 20), ("s", 4, 40)],
                               "k string, n int, v int")
    out = j.next_term(df, "k", "n", {"nv": "v"})
    assert rows(out, "n", "nv") == [(1, 20), (2, None), (4, None)]


def test_next_term_shuffles_once_and_pairs_all_rows_of_the_next_number(spark):
    data = [("s", 1023, 1), ("s", 1024, 2), ("s", 1024, 3), ("s", 1025, 4), ("s", None, 5), (None, 1, 6), (None, 2, 7),
            ("t", -1, 8), ("t", 0, 9)]
    df = spark.createDataFrame(data, "k string, n int, v int")
    out = j.next_term(df, "k", "n", {"nv": "v"})
    want = [(v, w) for k, n, v in data
            for w in [x for a, b, x in data if k and n is not None and a == k and b == n + 1] or [None]]
    assert sorted(map(tuple, out.select("v", "nv").collect()), key=str) == sorted(want, key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_duplicate_rows_that_are_their_keys_are_not_joined_back(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, s string")
    out = g.duplicate_rows(df, ["s", "k"])
    assert out.columns == ["k", "s", "n"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a", 3)] * 3 + [(None, "b", 2)] * 2
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_identity_maps_are_tried_in_order(spark):
    u = spark.createDataFrame([(1,), (2,), (3,), (None,)], "uid int")
    a = spark.createDataFrame([(1, "A")], "id int, key string")
    b = spark.createDataFrame([(1, "B"), (2, "B")], "id int, key string")
    out = j.resolve_identity(u, "uid", [(a, "id", "key"), (b, "id", "key")], "ref")
    assert rows(out, "uid", "ref") == [(1, "A"), (2, "B")]


def test_ids_dates_and_text(spark):
    df = spark.createDataFrame(
        [("", "January 5, 2023", "Red (one) (two)"), ("NO_ID", "bad", "Plain"),
         ("12", "March 31, 2024", None), ("x1", None, "(7)")], "u string, d string, c string")
    out = df.select(
        x.clean_id("u").alias("id"), x.parse_date("d", "MMMM d, yyyy").alias("day"),
        x.extract_code("c").alias("code"), x.strip_code("c").alias("rest"),
        x.paste(["u", "c"], "|").alias("p"))
    assert [tuple(v) for v in out.collect()] == [
        (None, date(2023, 1, 5), "one", "Red  (two)", "|Red (one) (two)"),
        (None, None, None, "Plain", "NO_ID|Plain"),
        (12, date(2024, 3, 31), None, None, "12|NA"),
        (None, None, "7", "", "x1|(7)"),
    ]


def test_week_notions_differ(spark):
    df = spark.sql("select date'2023-01-01' d union all select date'2023-01-07' "
                   "union all select date'2023-01-08'")
    out = df.select("d", x.week7("d").alias("w"), x.week_floor("d").alias("s"),
                    x.is_weekend("d").alias("e"))
    assert rows(out, "d", "w", "s", "e") == [
        (date(2023, 1, 1), 1, date(2023, 1, 1), True),
        (date(2023, 1, 7), 1, date(2023, 1, 1), True),
        (date(2023, 1, 8), 2, date(2023, 1, 8), True),
    ]
    assert months("2024-02", "2024-03") == [("2024-02", "2024-02-01", "2024-02-29"),
                                            ("2024-03", "2024-03-01", "2024-03-31")]
    assert weeks_touched("2023-01-01", "2023-05-31") == 22
    assert weeks_touched("2024-01-01", "2024-05-31") == 22


def test_labels(spark):
    df = spark.createDataFrame([(0.155,), (1.0,), (None,)], "s double")
    got = [v[0] for v in df.select(x.pct_label("s").alias("a")).collect()]
    assert got == ["16%", "100%", None]
    assert [v[0] for v in df.select(x.pct_label("s", 1)).collect()][:2] == ["15.5%", "100.0%"]
    b = spark.createDataFrame([(1,), (2,), (3,), (12,), (13,), (None,)], "n int").select(
        x.bucket("n", [2, 5, 12], ["1-2", "3-5", "6-12", "13+"]))
    assert [v[0] for v in b.collect()] == ["1-2", "1-2", "3-5", "6-12", "13+", None]


def test_coalesce_like_skips_blanks(spark):
    df = spark.createDataFrame([("", "2", None), (None, "", "3"), (None, None, "")],
                               "a_sub string, b_sub string, c_sub string")
    assert [v[0] for v in df.select(x.coalesce_like(df.columns, "_sub")).collect()] == [
        "2", "3", None]


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(9)
    data = []
    for i in range(120):
        start = date(2020, 1, 1) + timedelta(days=rng.randrange(-20, 90))
        length = rng.choice([0, 1, 6, 7, 8, 28, 200])
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(9)}"
        data.append((rng.choice("AB"), key, start, start + timedelta(days=length), i % 4 + 1))
    df = spark.createDataFrame(data, "b string, k string, s date, e date, a int")
    return data, df.withColumn("a", F.col("a").cast("decimal(18,2)"))


FIRST, WEEKS = "2020-01-05", 10


def _weeks():
    first = date.fromisoformat(FIRST)
    return [(first + timedelta(days=7 * i), first + timedelta(days=7 * i + 7))
            for i in range(WEEKS)]


def test_weekly_totals_equal_the_day_by_day_sum(spans):
    data, df = spans
    got = {(v["b"], v["week_start"]): (float(v["per_day_total"]), float(v["per_week_total"]))
           for v in iv.weekly_totals(df, ["b"], "s", "e", FIRST, WEEKS, "a", "a").collect()}
    for b in "AB":
        for lo, hi in _weeks():
            days = [(max((min(e, hi) - max(s, lo)).days, 0), a)
                    for bb, _, s, e, a in data if bb == b]
            want = (sum(d * a for d, a in days), sum(a for d, a in days if d > 0))
            assert got[(b, lo)] == want


def test_live_keys_equal_a_set_count(spans):
    data, df = spans
    out = iv.live_keys_per_week(df, ["b"], ["k"], "s", "e", FIRST, WEEKS, "n")
    got = {(v["b"], v["week_start"]): v["n"] for v in out.collect()}
    for b in "AB":
        for lo, hi in _weeks():
            want = {k for bb, k, s, e, _ in data if bb == b and s < hi and e > lo and e > s}
            assert got[(b, lo)] == len(want)


def test_clipped_days_stay_within_a_week_and_cover_the_term(spans):
    data, df = spans
    out = iv.overlap_weeks(df, "s", "e", FIRST, WEEKS)
    assert out.where("days < 1 or days > 7").count() == 0
    lo, hi = _weeks()[0][0], _weeks()[-1][1]
    covered = sum(max((min(e, hi) - max(s, lo)).days, 0) for _, _, s, e, _ in data)
    assert out.agg(F.sum("days")).first()[0] == covered


def test_unions_align_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n int")
    assert r.union_distinct(a, b).count() == 1
    assert r.union_all(a, b).count() == 2
    assert rows(r.bind_rows(a, b.drop("s")), "n", "s") == [(1, "x"), (1, None)]
    assert r.align(b, {"n": "bigint", "z": "string"}).dtypes == [("n", "bigint"), ("z", "string")]


def test_closed_form_estimates(spark):
    c = spark.createDataFrame([("a", 30, 100), ("b", 45, 100)], "p string, k int, n int")
    post = st.beta_posterior(c, "k", "n")
    assert rows(post, "p", "post_mean")[0] == ("a", pytest.approx(31 / 102))
    d = st.proportion_diff(post, "p", "a", "b").first()
    assert d["diff"] == pytest.approx(15 / 102) and 0.98 < d["p_positive"] < 0.99
    # prop.test(c(30, 45), c(100, 100)): X-squared = 4.1813
    assert st.prop_test(c, "p", "a", "b", "k", "n").first()["chi_square"] == pytest.approx(
        4.18133, abs=1e-4)
    z = spark.createDataFrame([(0.0,), (1.96,), (-1.0,)], "z double").select(
        st.normal_cdf("z").alias("p"))
    assert [v[0] for v in z.collect()] == pytest.approx([0.5, 0.9750021, 0.1586553], abs=1e-6)


def test_welch_t_known_value(spark):
    df = spark.createDataFrame(
        [("a", v) for v in (1.0, 2.0, 3.0, 4.0)] + [("b", v) for v in (2.0, 4.0, 6.0, 9.0)],
        "g string, v double")
    t = st.welch_t(df, "v", "g", "a", "b").first()
    # by hand: var/n = 5/12 and 26.75/12, t = -2.75 / sqrt(31.75/12)
    assert t["t"] == pytest.approx(-2.75 / (31.75 / 12) ** 0.5)
    assert t["dof"] == pytest.approx(31.75 ** 2 * 3 / (5 ** 2 + 26.75 ** 2))


def test_split_is_exact_per_class_and_repeatable(spark):
    df = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 10 < 7, "big").otherwise("small").alias("c"))
    one = stratified_split(df, "c", "id", 0.8, 3)
    n = {(v["c"], v["part"]): v["count"] for v in one.groupBy("c", "part").count().collect()}
    assert n == {("big", "train"): 560, ("big", "test"): 140, ("small", "train"): 240,
                 ("small", "test"): 60}
    again = stratified_split(df.repartition(7), "c", "id", 0.8, 3)
    assert one.exceptAll(again).count() == 0
    s = sample_users(df, "id", 0.3, 1)
    assert 230 < s.count() < 370 and s.exceptAll(sample_users(df, "id", 0.5, 1)).count() == 0


def test_split_never_gathers_a_class(spark):
    data = [(c, i % 300) for c in ("a", "b", None) for i in range(500)] + [("one", 1)]
    df = spark.createDataFrame(data, "c string, id int").repartition(5)
    out = stratified_split(df, "c", "id", 0.8, 3)
    n = {(v["c"], v["part"]): v["count"] for v in out.groupBy("c", "part").count().collect()}
    assert n == {(c, p): k for c in ("a", "b", None) for p, k in (("train", 400), ("test", 100))} | {("one", "test"): 1}
    # train are the rows of the least hashes, copies of a key included
    worst = out.withColumn("h", F.md5(F.concat_ws(":", F.lit("3"), F.col("id").cast("string")))).groupBy("c").agg(
        F.max(F.when(F.col("part") == "train", F.col("h"))).alias("a"), F.min(F.when(F.col("part") == "test", F.col("h"))).alias("b"))
    assert worst.where("a > b").count() == 0
    assert stratified_split(df, "c", "id", 1.0, 3).where("part = 'test'").count() == 0
    assert stratified_split(df, "c", "id", 0.0, 3).where("part = 'train'").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_sequence_equals_its_parts(skewed):
    data, df = skewed
    by, order, day = ["k"], ["d", "id"], F.col("d")
    whole = o.sequence(df, by, order, day, number="n", rank="r", near={"next_d": "d", "next_v": "v"}, running={"total": "v"})
    want = duck(data, """select id, row_number() over w, dense_rank() over (partition by k order by d),
        lead(d) over w, lead(v) over w, sum(v) over w from t window w as (partition by k order by d, id)""")
    assert whole.columns == [*df.columns, "n", "r", "next_d", "next_v", "total"]
    assert rows(whole, "id", "n", "r", "next_d", "next_v", "total") == want
    back = o.sequence(df, by, order, day, near={"prev": "id"}, step=-1)
    want = duck(data, "select id, lag(id) over (partition by k order by d, id) from t")
    assert rows(back, "id", "prev") == want
