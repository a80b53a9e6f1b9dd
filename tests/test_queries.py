"""Every registered query against its SQL twin over the smallest tables."""

import math
import os

import pytest

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
from kerbstone import plans  # noqa: E402


def shown(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return f"{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return f"{float(value):.9g}" if isinstance(value, int) and not isinstance(value, bool) else str(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(shown(r[k]) for k in order) for r in rows), key=lambda r: [(x is None, x or "") for x in r])


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    found = plans.queries()[name](spark, FOLDER)
    rows = found.collect()
    got = duck.execute(plans.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert rows and sorted(found.columns) == sorted(names)
    assert sorted_rows(found.columns, rows) == sorted_rows(names, got.fetchall())
