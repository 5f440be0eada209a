"""A few registered queries against their DuckDB twins at sf0.001."""
import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
NAMES = ["analyze_porter", "ranked_search", "conj_search", "custom_score", "faceted_search",
         "extract_fields", "monotone_path", "polygon_centroid"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    res = con.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    cols = sorted(sdf.columns)
    s = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    oi = [res.columns.index(c) for c in cols]
    o = sorted(tuple(_norm(r[i]) for i in oi) for r in res.fetchall())
    assert s == o
