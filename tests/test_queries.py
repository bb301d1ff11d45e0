"""Every query that has an SQL twin gives the same rows as the twin."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import canonical

TWINS = entry.oracle_sql()


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_rows(spark, sql, small, name):
    ours = entry.queries()[name](spark, small).toPandas()
    theirs = sql.execute(TWINS[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark, small, capsys):
    entry.queries()["session_rollup"](spark, small).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(price,0.0)" in plan and "LessThanOrEqual(order,100)" in plan
    assert "price_2" not in plan and "event_id" not in plan
