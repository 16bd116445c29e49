"""The driver contract over the smallest tables: every query runs, and agrees with its SQL where there is one."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data here")
SLOW = {"persona_pairs", "error_examples"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def core_names():
    from corpusmill.plans import registry

    return sorted(set(registry.queries()) - SLOW)


@pytest.mark.parametrize("name", core_names())
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, str(DATA))
    names = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    sql = contract.oracle_sql().get(name)
    if sql:
        other = duck.sql(sql)
        at = [other.columns.index(c) for c in names]
        assert sorted(other.columns) == names
        assert rows == sorted((tuple(plain(r[i]) for i in at) for r in other.fetchall()), key=repr)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_nothing_in_the_core_imports_the_llm_package():
    root = Path(contract.__file__).parent / "corpusmill"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "corpusmill.llm" not in p.read_text()
