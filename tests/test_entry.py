import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_flagship_runs(spark):
    out = entry.entry(spark)
    assert out.columns == ["root", "year", "month", "num"]
    assert out.count() > 0
