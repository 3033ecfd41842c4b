"""The registered queries: DuckDB where SQL can express them, names, stages."""

import os

import duckdb
import pytest

import corpus_pipeline
import __spark_entry__ as entry
from opinari.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    want = sorted((tuple(_norm(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall()), key=repr)
    assert got == want


def test_names():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "redact_secrets", "pack"]


def test_nothing_else_imports_the_subpackage():
    top = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(top, "opinari")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "opinari.llm" not in open(os.path.join(folder, f)).read(), f
