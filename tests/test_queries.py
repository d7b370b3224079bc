"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, compare, duck

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# These write tables of one file per store and month, so here they run on the bills of a few months.
FILES = {
    "all_lines_round_trip",
    "compacted_lines",
    "idempotent_runs",
    "layout_metrics",
    "partition_round_trip",
    "streamed_item_revenue",
}


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.fixture(scope="module")
def few_months(folder, tmp_path_factory):
    """The tables with the bills around the month that the queries ask for."""
    target, con = tmp_path_factory.mktemp("months"), duckdb.connect()
    months = "o_orderdate >= timestamp '1998-09-01' and o_orderdate < timestamp '1998-12-01'"
    chosen = {
        "orders": f"select * from '{folder}/orders.parquet' where {months}",
        "lineitem": f"select * from '{folder}/lineitem.parquet' semi join"
        f" (select o_orderkey as l_orderkey from '{folder}/orders.parquet' where {months}) using (l_orderkey)",
    }
    for table in TABLES:
        sql = chosen.get(table, f"select * from '{folder}/{table}.parquet'")
        con.execute(f"copy ({sql}) to '{target}/{table}.parquet'")
    return str(target)


@pytest.mark.parametrize("name", sorted(FILES))
def test_queries_of_files_equal_sql(spark, few_months, name):
    assert compare(QUERIES[name](spark, few_months), duck(few_months), ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted((set(QUERIES) & set(ORACLE)) - FILES))
def test_query_equals_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLE[name]) == ""


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
