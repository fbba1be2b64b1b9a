"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from folioflow import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_rows(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda d: d[columns].astype(object).where(d[columns].notna(), None).astype(str).sort_values(columns).reset_index(drop=True)
    assert plain(got).equals(plain(want))


def test_columns_of_whole_texts(spark, duck):
    """Words of a long page of either parity, counted by hand."""
    got = {r["file_id"]: r["text"] for r in queries.column_layout(spark, SF).collect()}
    for odd in (0, 1):
        doc, text = duck.sql(f"select doc_id, text from documents where n_chars >= 4000 and doc_id % 2 = {odd} and doc_id % 10 <> 3 order by doc_id limit 1").fetchall()[0]
        seen = [w for i, w in enumerate(text.split()) if i % 29 != 5]
        assert len(seen) > 400 and sorted(got[f"doc_{doc}"].replace("§", "").split()) == sorted(w.replace("§", "") for w in seen)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
