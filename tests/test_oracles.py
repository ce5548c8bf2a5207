"""Every query with an oracle gives the same rows as the SQL on the small scale."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(table):
    names = sorted(table.column_names)

    def clean(v):
        if isinstance(v, float):
            return None if v != v else round(v, 6)
        return v

    out = [tuple(clean(r[n]) for n in names) for r in table.to_pylist()]
    return names, sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, sf, con, name):
    got = rows(entry.queries()[name](spark, sf).toArrow())
    want = rows(con.sql(entry.oracle_sql()[name]).to_arrow_table())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
