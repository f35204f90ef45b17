"""Registered queries and the whole dense result against SQL written from the rules."""

from __future__ import annotations

from functools import cache
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import TABLES, canonical
from checks.oracle import oracle_queries, with_steps
from shelfledger.plans.gates import GATES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared_runs():
    """Queries of this module share staged ledgers; each registered query stages its own."""
    original = contract.export
    contract.export = cache(original)
    yield
    contract.export = original


OWN = oracle_queries(list(GATES))


def test_every_query_has_sql():
    assert OWN.keys() <= contract.queries().keys() and OWN.keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())


def test_whole_dense_result(spark, duck, tmp_path):
    """All 31 columns of every product and day, row by row."""
    contract.entry(spark).write.parquet(f"{tmp_path}/daily")
    duck.execute(f"create view spark_daily as select * from read_parquet('{tmp_path}/daily/*.parquet')")
    duck.execute(f"create table sql_daily as {with_steps('daily', 'SELECT * FROM daily')}")
    names = ", ".join(f'"{c}"' for c in contract.export(spark, FOLDER).daily.columns)
    counts = [duck.execute(f"select count(*) from {t}").fetchone()[0] for t in ("sql_daily", "spark_daily")]
    assert counts[0] == counts[1] > 300_000
    for left, right in (("spark_daily", "sql_daily"), ("sql_daily", "spark_daily")):
        differing = duck.execute(f"select {names} from {left} except all select {names} from {right}")
        assert differing.fetchall() == []
