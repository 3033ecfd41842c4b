"""Every registered query against its DuckDB oracle at sf0.001, and the
rows-only queries for a non-empty result with a stable schema."""

import os

import duckdb
import pytest

from opinari.plans.registry import ORACLE, QUERIES, load_all
from opinari.sources.tables import TABLES

from conftest import SF_SMALL

load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.columns == ["aspect", "total_comments", "positive_count", "negative_count", "unknown_count",
                          "positive_percentage", "negative_percentage"]
    assert df.count() >= 0
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
    assert df.columns == QUERIES[name](spark, SF_SMALL).columns
