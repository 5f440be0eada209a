import __spark_entry__ as entry


def test_registry_consistent():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["item_id", "doc_id", "rank", "score"]
    assert len(rows) > 0
