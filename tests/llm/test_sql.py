"""The corpus queries that SQL can express, against it."""

import pytest

import __spark_entry__ as entry
from tests.test_queries import duck, rows  # noqa: F401

NAMES = [n for n in entry.oracle_sql() if n.startswith("op")]


def test_names():
    assert len(NAMES) == 7


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, sf, name):  # noqa: F811
    df = entry.queries()[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == rows(cols, rel.fetchall())
