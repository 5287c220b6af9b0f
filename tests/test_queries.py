"""Every registered query against its comparison SQL, on the smallest data and
on a copy in which single keys hold a third of the rows."""

import os

import compare
import pytest

import __spark_entry__ as entry_point
from tradewind import queries as registry

SF = "/root/testdata/sf0.001"
ALL = entry_point.queries()
JOBS = {name: ALL[name] for name in registry.JOBS}  # tests/llm has the others
SQL = {name: sql for name, sql in entry_point.oracle_sql().items() if name in JOBS}
SKEWED = [n for n in SQL if n.startswith(
    ("gold_", "dash_", "rfm_", "eda_pareto", "eda_top20", "eda_gmv", "bi_top", "bi_delay",
     "bi_kpi", "dq_payment", "dq_ref", "join_interval", "join_topn", "win_ntile",
     "win_cumsum"))]


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the lines in one order and of one product, a third of the
    orders by one customer."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = compare.duck(SF)
    changed = {
        "lineitem": """SELECT * EXCLUDE (i) REPLACE (
            CASE WHEN i % 3 = 0 THEN (SELECT min(o_orderkey) FROM orders
                WHERE o_orderstatus = 'F') ELSE l_orderkey END AS l_orderkey,
            CASE WHEN i % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)
            FROM (SELECT *, row_number() OVER () AS i FROM lineitem) x""",
        "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END
            AS o_custkey) FROM orders""",
    }
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        if table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            continue
        select = changed.get(table, f"SELECT * FROM {table}")
        con.execute(f"COPY ({select}) TO '{folder}/{name}' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", list(JOBS))
def test_query(spark, con, name):
    assert compare.compare(spark, con, SF, name, JOBS[name], SQL.get(name)) == ""


@pytest.mark.parametrize("name", SKEWED)
def test_skewed(spark, skewed, name):
    con = compare.duck(skewed)
    assert compare.compare(spark, con, skewed, name, JOBS[name], SQL[name]) == ""


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and df.columns[0] == "report_month"


def test_every_comparison_has_a_query():
    assert set(SQL) == set(JOBS) and len(JOBS) > 180
