"""Driver contract and a subset of the SQL oracles (sf0.001 for speed)."""

import duckdb
import pytest

from conftest import SF001

FAST = ["velocity", "cust_counts", "cust_amounts", "device", "rolling", "rolling_delta", "priors",
        "ap", "rank", "eda_amounts", "sequences", "val_split"]


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "cnt_24h" in df.columns


def test_registry_consistent():
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF001}/events.parquet')")
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    return c


def _canon(rows):
    def v(x):
        if isinstance(x, float) and x.is_integer():
            return str(int(x))
        return str(x)
    return sorted(tuple(v(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_oracle(spark, con, name):
    import __spark_entry__ as e
    sdf = e.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    got = _canon([tuple(r[c] for c in cols) for r in sdf.collect()])
    res = con.execute(e.oracle_sql()[name])
    names = [d[0] for d in res.description]
    exp = _canon([tuple(r[names.index(c)] for c in cols) for r in res.fetchall()])
    assert sorted(names) == cols
    assert got == exp
