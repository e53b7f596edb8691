"""Queries against their SQL twins at the smallest scale.

A selection by default; HOURGRID_ALL=1 runs them all (about ten minutes).
"""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools_check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
ALL = os.environ.get("HOURGRID_ALL") == "1"
CHOSEN = (
    "prj", "str", "dt", "mth", "enc", "fil", "flt", "ded", "agg1_", "agg3", "agg5", "agg7", "agg8", "win1_", "win4", "win5",
    "smp1", "mod5_linear_f", "mod6_tree", "mod7_boosted_o", "mod8_poisson_b", "mod11_t", "mod12_linear", "srv3_score_n", "cv4_simple_sp",
    "dq5", "dq6", "grd5", "jn1_", "jn5_p", "jn6_n", "jn7_n", "jn10_s", "grd3", "wx1_w", "dq1_", "dq10_l", "src1", "snk3", "met1_d", "mod3", "mod16")


def selected(names):
    return sorted(n for n in names if ALL or n.startswith(CHOSEN))



@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", selected(contract.oracle_sql()))
def test_equals_sql(spark, db, name):
    import pandas as pd

    got = contract.queries()[name](spark, FOLDER).toPandas()
    rel = db.sql(contract.oracle_sql()[name])
    want = pd.DataFrame(rel.fetchall(), columns=rel.columns)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted({"smp1_sample_rows", "mod11_seasonal_trend"} if not ALL else
                                        set(contract.queries()) - set(contract.oracle_sql())))
def test_has_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    out = contract.entry(spark)
    assert out.columns[:3] == ["area", "hour_ts", "n"] and out.count() > 0


def test_names_match():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name,most", [("win1_dense_lags", 0), ("agg7_dense_panel", 0), ("grd1_grid_cells", 1), ("wx1_weather_flags", 1)])
def test_events_are_not_scanned_again_and_again(spark, name, most):
    """What is left to scan after the counts were written once."""
    from conftest import plan

    assert plan(contract.queries()[name](spark, FOLDER)).split("== Initial Plan")[0].count("events.parquet") <= most


@pytest.mark.parametrize("name", ["win1_dense_lags", "agg7_dense_panel", "jn9_hour_grid", "mod1_mean_baseline", "jn7_nearest_site"])
def test_plans_have_no_cross_joins(spark, name):
    from conftest import plan

    text = plan(contract.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert operator not in text
