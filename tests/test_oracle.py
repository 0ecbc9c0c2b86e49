"""Every registered query against its SQL, on whole tables of the smallest scale."""

import inspect

import pytest

import __spark_entry__ as entry
from compare import compare

QUERIES = {n: q for m in entry.MODULES for n, q in m.QUERIES.items()}
SQL = {n: q for m in entry.MODULES for n, q in m.ORACLE.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    verdict, _ = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
    assert verdict.startswith(("ok", "rows")), verdict


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_no_name_is_registered_twice():
    import re

    names = [n for m in entry.MODULES for n in re.findall(r'@R\.add\("(\w+)"', inspect.getsource(m))]
    assert len(names) == len(set(names)) == len(QUERIES)
