"""Movement and opening stock straight from the ledgers: one dealing of rows, and NULLs as sums by day leave them."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfledger import ExportParams
from shelfledger.operators import stock
from shelfledger.plans.daily_export import PARTITIONS_PER_FACT_TASK, DailyExport
from tests.store import minimal_store

FIRST, LAST = date(2024, 1, 1), date(2024, 1, 31)
BEFORE, DAY = date(2023, 12, 5), date(2024, 1, 9)
TARGETS = "site int, product int, window_start date, window_end date"
LEDGER = "site int, product int, business_date date, discount int, is_return boolean, qty decimal(38,6), has_null_qty boolean"
IMEX = "site int, product int, business_date date, net_qty decimal(38,6), has_unknown_qty boolean"


@pytest.fixture(scope="module")
def frames(spark):
    def ledger_row(product, day, returned, qty, discount=None):
        return 0, product, day, discount, returned, None if qty is None else Decimal(qty), qty is None

    ledger = [
        ledger_row(1, DAY, False, 5), ledger_row(1, DAY, False, 2, 6), ledger_row(1, DAY, True, 1), ledger_row(1, BEFORE, False, 3),
        ledger_row(2, DAY, False, None), ledger_row(2, BEFORE, False, None), ledger_row(2, BEFORE, True, 4),
        ledger_row(3, DAY, False, None), ledger_row(3, DAY, True, None), ledger_row(4, DAY, False, None),
        ledger_row(5, None, False, 9), ledger_row(9, DAY, False, 9),
    ]
    imex = [(0, 1, DAY, Decimal(20), False), (0, 1, BEFORE, Decimal(10), False), (0, 4, DAY, Decimal(7), False), (0, 6, DAY, None, True)]
    targets = spark.createDataFrame([(0, product, FIRST, LAST) for product in range(1, 8)], TARGETS)
    return targets, spark.createDataFrame(ledger, LEDGER), spark.createDataFrame(imex, IMEX)


def test_movement_of_a_day(frames):
    found = {row.product: row for row in stock.daily_movement(*frames, FIRST, LAST).collect()}
    assert sorted(found) == [1, 2, 3, 4, 6]
    values = {product: tuple(found[product])[3:] for product in found}
    assert values[1] == (True, 20, 7, 1, 14, False)
    assert values[2] == (False, 0, None, 0, None, False)  # only sale rows, none with a quantity
    assert values[3] == (False, 0, 0, 0, 0, False)  # sale and return rows: each is zero beside the other
    assert values[4] == (True, 7, 0, 0, 7, False)
    assert values[6] == (True, None, 0, 0, None, True)


def test_stock_at_the_start_of_the_window(frames):
    found = {row.product: (row.seed_net_movement, row.is_seed_known) for row in stock.stock_seed(*frames).collect()}
    assert found == {1: (7, True), 2: (None, False)} | {product: (0, True) for product in range(3, 8)}


@pytest.mark.parametrize("step", [stock.daily_movement, stock.stock_seed])
def test_ledgers_are_dealt_by_product_once(spark, frames, step):
    """The ledgers' union is shuffled for its join with the targets; the sums need no other dealing."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = step(*frames)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") == (2 if step is stock.daily_movement else 3), plan
    assert "Sort [site" not in plan


def test_tasks_of_event_days_follow_the_products(spark):
    """They grow with the products, whatever the session's number of shuffle partitions; no other dealing follows the join."""
    store = minimal_store()
    for code in range(2, 40):
        store.line(store.product(code), LAST, 4, 40)
    params = ExportParams(run_date=date(2024, 3, 10), rows_per_partition=1_000)
    run = DailyExport(spark, store.sources(spark), params)
    assert run.fact_tasks == run.partitions // PARTITIONS_PER_FACT_TASK > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = run.facts._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [product#" in plan and f", {run.fact_tasks}" in plan, plan
    assert run.facts.where(F.col("day") == LAST).count() == 38
