import pytest

import __spark_entry__ as contract


def test_every_twin_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 150


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["total"] >= rows[-1]["total"]


@pytest.mark.parametrize("name", ["p26_top_k", "a11_histogram", "w04_difference_1_1", "t13_ranked_search", "r04_streaming_top_k"])
def test_sample_of_queries_against_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.check_oracle import TABLES, rows_of
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = contract.queries()[name](spark, folder).toPandas()
    want = con.execute(contract.oracle_sql()[name]).fetchdf()
    assert rows_of(got) == rows_of(want)
