"""Every query with SQL must equal DuckDB."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from sievework.plans import catalog

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    yield con
    con.close()


def rows(names, found):
    """Rows with their columns by name, in an order that does not look at floats before all else."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(r[i] for i in order) for r in found]
    return sorted(made, key=lambda r: ([str(x) for x in r if not isinstance(x, float)], [round(x, 4) for x in r if isinstance(x, float)]))


def same(a, b):
    """Equal in every digit."""
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isnan(a) and math.isnan(b)
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(map(same, a, b))
    return str(a) == str(b)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    found = duck.execute(catalog.ORACLE[name])
    names = [x[0] for x in found.description]
    assert sorted(df.columns) == sorted(names)
    got, expected = rows(df.columns, [tuple(r) for r in df.collect()]), rows(names, found.fetchall())
    assert len(got) == len(expected)
    assert [(a, b) for a, b in zip(got, expected, strict=True) if not same(a, b)] == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_others_have_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_flagship_is_registered():
    assert catalog.FLAGSHIP in catalog.QUERIES and set(catalog.ORACLE) <= set(catalog.QUERIES)
