"""Registered queries against their SQL oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, compare

FAST = ("p", "f", "j1_", "j3_", "j6_", "j10_", "r2_", "r5_bm25_plus", "r6_", "d1_encode_hash", "d4_", "d7_", "h1_", "h5_", "c1_", "c5_", "m5_", "w1_", "a")


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


NAMES = [n for n in entry.queries() if n.startswith(FAST) and n in entry.oracle_sql() and not n.startswith(("a7", "f2")) and "stored" not in n]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*cols).collect()]
    rel = con.execute(entry.oracle_sql()[name])
    header = [d[0] for d in rel.description]
    assert sorted(header) == cols
    want = [tuple(r[header.index(c)] for c in cols) for r in rel.fetchall()]
    assert compare(got, want) == "ok"


def test_registry_is_complete():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120
