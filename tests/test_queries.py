"""Every query against its SQL over the smallest tables."""

from pathlib import Path

import pytest

from cardloom import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not Path(DATA).exists():
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str(tuple(r[i] for i in order)) for r in data)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    got = duck.execute(registry.SQL[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, got.fetchall())
