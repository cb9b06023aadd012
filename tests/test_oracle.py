"""Each registered batch query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_sql import ORACLE
from tools.check import TABLES, digest

SF = "/root/testdata/sf0.001"
BATCH_KEYS = [k for k in ORACLE if not k.startswith("stream_")]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_every_query_has_an_oracle():
    """Queries of the optional subpackage may go without (SQL can't express all of them)."""
    from indicata.plans.io_queries import IO_REGISTRY
    from indicata.plans.queries import REGISTRY
    from indicata.streaming.queries import STREAM_REGISTRY

    assert {*REGISTRY, *IO_REGISTRY, *STREAM_REGISTRY} <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "status_comparacao" in df.columns


def test_entry_without_the_subpackage_or_what_it_needs(tmp_path):
    """With xxhash missing, the other queries are there, and importing the pipeline itself fails."""
    import subprocess
    import sys

    (tmp_path / "xxhash.py").write_text("raise ImportError('no xxhash here')")
    code = ("import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; from indicata.plans.queries import REGISTRY\n"
            "q, o = e.queries(), e.oracle_sql(); assert set(REGISTRY) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in {**q, **o})\n"
            "try:\n    import corpus_pipeline\nexcept ImportError:\n    print('fails')")
    root = entry._HERE
    out = subprocess.run([sys.executable, "-c", code], env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{tmp_path}:{root}"}, cwd=tmp_path,
                         capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "fails", out.stderr
