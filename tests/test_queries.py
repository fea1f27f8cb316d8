"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from timbre.plans import catalog
from timbre.plans.standins import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    got = catalog.QUERIES[name](spark, SF).toArrow()
    if name not in catalog.ORACLE_SQL:
        assert got.num_rows > 0
        return
    want = con.sql(catalog.ORACLE_SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    rows = lambda t: sorted((tuple(map(plain, r)) for r in zip(*(t[c].to_pylist() for c in sorted(t.column_names)))), key=repr)
    assert rows(got) == rows(want)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def test_cer_of_whole_texts(spark, con):
    texts = dict(con.sql("SELECT item_id, text FROM benchmark").fetchall())
    got = {r.item_id: r.cer for r in catalog.QUERIES["cer_whole"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    other = [i for i, t in texts.items() if not t.isascii()][:10] + [i for i, t in texts.items() if t.isascii()][:10]
    assert len(other) > 10
    for i in other:
        t = texts[i]
        assert abs(got[i] - edits(t, t.replace("e", "a") + " added") / len(t)) < 1e-6
