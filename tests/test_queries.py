"""Every query against its SQL on the smallest tables, as the driver compares them."""

import math

import duckdb
import pytest

from tidemark.plans import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b if isinstance(a, (int, bool)) or a is None or b is None else str(a) == str(b)


def order(row):
    return tuple((v is None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order)
    if name not in oracle_sql():
        assert rows
        return
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    wanted = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=order)
    assert len(rows) == len(wanted)
    for a, b in zip(rows, wanted):
        assert all(map(same, a, b)), (a, b)
