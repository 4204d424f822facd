"""Regression guard: a representative set of catalogued queries must match
their DuckDB oracle exactly (row multiset) on the smallest data set."""
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["monthly_flows", "f_empresa_mes", "validate", "relation_importance", "ego_nodes", "concentration_metrics",
         "risk_scenarios", "risk_report", "stage_features", "supervised_features", "peer_ranking", "company_summary",
         "metric_correlation", "format_report", "company_ids"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def _rows(tbl):
    cols = sorted(tbl.column_names)
    data = {c: tbl.column(c).to_pylist() for c in cols}
    return cols, Counter(tuple(_norm(data[c][i]) for c in cols) for i in range(tbl.num_rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["supplier", "orders", "lineitem", "customer"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    spark_tbl = E.queries()[name](spark, SF).toArrow()
    duck_tbl = con.sql(E.oracle_sql()[name]).to_arrow_table()
    assert _rows(spark_tbl) == _rows(duck_tbl)
