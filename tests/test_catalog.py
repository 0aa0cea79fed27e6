"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from skein.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(map(text, r)) for r in df.select(*cols).collect())
    if name not in catalog.ORACLES:
        assert rows
        return
    r = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert rows == sorted(tuple(text(x[names.index(c)]) for c in cols) for x in r.fetchall())
