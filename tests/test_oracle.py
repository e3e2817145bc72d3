"""Every registered query against its SQL, and the entry contract."""

import duckdb
import pytest

import __spark_entry__ as entry
from subscope.catalog import ORACLE, QUERIES
from tools.check import TABLES, rows_of



@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(name, spark, con, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert df.columns == cols
    got, want = rows_of(df.columns, df.collect()), rows_of(cols, cur.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for u, v in zip(a, b):
            if isinstance(u, float) and isinstance(v, float):
                # a value halfway between two roundings may fall on either side
                assert u == pytest.approx(v, rel=1e-12, abs=1.1e-6)
            else:
                assert u == v


def test_oracle_covers_all_but_models():
    models = {"t5_negbin_random_intercept", "t9_fit_multinomial", "t10_compare_models", "t10_held_out_log_loss", "t11_vif",
              "t12_odds_ratios", "t12_odds_ratio_intervals_basic", "t13_score_long", "t14_predicted_counts", "t15_effect_grid",
              "t15_effect_intervals_basic", "n17_fit_and_score", "n18_score_by_distinct_channels", "n19_score_by_segment",
              "n20_score_by_visit_count"}
    assert set(QUERIES) - set(ORACLE) == models


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "pubcode" and df.count() > 0
