import __spark_entry__ as ent


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert set(df.columns) >= {"Day", "feature", "statistic", "p_value", "is_drifted"}
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())
