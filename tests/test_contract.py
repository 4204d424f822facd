import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "overall_risk_score" in df.columns


def test_every_oracle_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 60


def test_oracle_sql_runs_on_duckdb():
    import duckdb
    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in ["supplier", "orders", "lineitem", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ["monthly_flows", "risk_report", "peer_ranking"]:
        assert len(con.execute(E.oracle_sql()[name]).fetchall()) > 0
