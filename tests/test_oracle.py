"""Every core query against its SQL in DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from fluvion import queries as core

SF = Path("/root/testdata/sf0.001")


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    return str(value)


def rows_of(rows, names):
    return sorted([tuple(plain(r[n]) for n in names) for r in rows], key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_matches_sql(spark, duck, name):
    got = core.QUERIES[name](spark, str(SF))
    names = sorted(got.columns)
    want = duck.execute(core.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == names
    expected = [dict(zip(columns, r, strict=True)) for r in want.fetchall()]
    assert rows_of(got.collect(), names) == rows_of(expected, names)


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_runs(spark, name):
    assert core.QUERIES[name](spark, str(SF)).count() > 0


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
