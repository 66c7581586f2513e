"""The driver contract: entry runs, every query has a callable, oracle keys are known."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"harmonicSumNorm", "cal_score", "allBBW", "allWD"} <= set(df.columns)


def test_oracle_keys_are_queries():
    from phenoscope.plans import catalog, oracle_sql
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.registry()) == set(oracle_sql.build())


def test_weights_csv_reader(spark, tmp_path):
    from phenoscope.sources.readers import read_phenotype_weights_csv
    path = tmp_path / "w.csv"
    path.write_text("id,label,score,\nMP:1,a,1,\nMP:2,b,0.75,*\nMP:3,c,0,\n")
    rows = {r.idLabel: r.curatedScore for r in read_phenotype_weights_csv(spark, str(path)).collect()}
    assert rows == {"MP:1": 1.0, "MP:2": 0.75, "MP:3": 0.0}


def test_approvals_csv_reader_and_list_flag(spark, tmp_path):
    from phenoscope.operators.nested import list_flag
    from phenoscope.sources.readers import read_approvals_csv, release_path
    path = tmp_path / "approvals.csv"
    path.write_text(',targetIds\n0," T1 ; T2"\n1,T2;T3\n')
    ids = sorted(r.id for r in list_flag(read_approvals_csv(spark, str(path)), "targetIds").collect())
    assert ids == ["T1", "T2", "T3"]
    assert release_path("gs://bucket/", "24.09", "targets") == "gs://bucket/24.09/output/etl/parquet/targets"
