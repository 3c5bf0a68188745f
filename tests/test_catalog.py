"""Every query that has an oracle gives the oracle's rows."""

import os
from collections import Counter

import duckdb
import pytest

from quireline.plans import catalog, pages  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def rows(found):
    return Counter(tuple(round(v, 6) + 0.0 if isinstance(v, float) else tuple(v) if isinstance(v, list) else v for v in r) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    q = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.select(*names).collect()) == rows(q.fetchall())
