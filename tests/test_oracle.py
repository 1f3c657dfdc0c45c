"""Every catalog query against its SQL oracle in DuckDB, on sf0.001."""

import os
import duckdb
import pytest

import __spark_entry__ as E
from contrail.plans.catalog import QUERIES
from contrail.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows) > 0
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["airport", "flights"]
    assert 0 < df.count() <= 10


def test_entry_survives_a_missing_library():
    """Without a library that the training-data queries need, all other queries stay."""
    import subprocess
    import sys

    code = (
        "import sys, warnings; sys.modules['zstandard'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as E; "
        "q = E.queries(); print(len(q), 'airports_top10' in q, any(k.startswith('op') for k in q), set(E.oracle_sql()) <= set(q))"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[1:] == ["True", "False", "True"], out.stderr[-500:]
