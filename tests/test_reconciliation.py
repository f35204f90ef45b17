"""Totals of the ledgers, equal tasks, stored events and the reconciliation of published rows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfledger import ExportParams, GateError, run_export, write_export
from shelfledger.operators import ledgers, placement
from shelfledger.plans import gates
from shelfledger.plans.daily_export import DailyExport, prepare_export
from shelfledger.sources.staging import Staging
from tests.store import LAST, Store, minimal_store

RUN = ExportParams(run_date=date(2024, 3, 10))


def codes(error) -> list[str]:
    return [v.gate for v in error.value.violations]


def two_products() -> Store:
    store = minimal_store()
    store.line(1, LAST - timedelta(3), 2, 20, discount=61)
    store.line(1, LAST - timedelta(3), 5, 20, returned=True)
    store.line(store.product(2), LAST, 4, 40)
    store.document(1, LAST, 1, 3, 5, quantity=5)
    store.document(1, LAST, 99, 3, 7)  # out of scope, but counted
    return store


@pytest.mark.parametrize(
    "change",
    [
        lambda ledger: ledger.where("product <> 2"),
        lambda ledger: ledger.withColumn("qty", F.when(F.col("product") == 2, 2 * F.col("qty")).otherwise(F.col("qty")).cast("decimal(38,6)")),
        lambda ledger: ledger.withColumn("unknown_lines", F.lit(1)),
        lambda ledger: ledger.withColumn("is_return", ~F.col("is_return")),
    ],
)
def test_lost_or_changed_lines_stop_a_default_run(spark, monkeypatch, change):
    sound = ledgers.pos_ledger
    monkeypatch.setattr(ledgers, "pos_ledger", lambda *tables: change(sound(*tables)))
    with pytest.raises(GateError) as error:
        run_export(spark, two_products().sources(spark), RUN)
    assert codes(error) == ["G22"]


def test_lost_warehouse_lines_stop_a_default_run(spark, monkeypatch):
    sound = ledgers.imex_book
    monkeypatch.setattr(ledgers, "imex_book", lambda lines: sound(lines.where("kept")))
    with pytest.raises(GateError) as error:
        run_export(spark, two_products().sources(spark), RUN)
    assert codes(error) == ["G22"]


def test_one_line_for_another_is_seen(spark):
    """Equal counts and sums, other lines."""
    store = two_products()
    given = ledgers.pos_line_totals(store.sources(spark).pos_detail)
    table = store.rows["tbl_SALPoSDetails"]
    moved = [(2, *row[1:]) if n == 0 else (1, *row[1:]) if row[0] == 2 else row for n, row in enumerate(table)]
    store.rows["tbl_SALPoSDetails"] = moved
    sources = store.sources(spark)
    held = ledgers.pos_ledger_totals(ledgers.pos_ledger(sources.pos_detail, sources.pos_master))
    assert [v.gate for v in gates.failures(gates.line_control("K4a", held, given))] == ["G22"]


def crowded(spark) -> Store:
    """Ten busy products and 3,000 quiet ones."""
    store = Store()
    for code in range(1, 3011):
        store.line(store.product(code), LAST, 1, 10)
    for code in range(1, 11):
        for day in range(300):
            store.line(code * 7, LAST - timedelta(day), 1, 10)
    return store


def test_equal_tasks_in_order(spark):
    params = ExportParams(run_date=RUN.run_date, rows_per_partition=300_000)
    result = prepare_export(spark, crowded(spark).sources(spark), params)
    tasks = result.daily.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("ProductCode").alias("low"), F.max("ProductCode").alias("high")
    )
    rows = sorted(tasks.collect())
    assert [r.task for r in rows] == list(range(result.run.partitions)) and sum(r.rows for r in rows) == 3010 * 1827
    assert max(r.rows for r in rows) <= 300_000 + 1827 and min(r.rows for r in rows) >= max(r.rows for r in rows) - 2 * 1827
    assert all(left.high < right.low for left, right in zip(rows, rows[1:]))
    result.cleanup()


def test_a_label_deals_to_its_slot(spark):
    labels = placement.labels(spark, 37)
    dealt = labels.repartition(37, "label").select("slot", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.slot for r in dealt) == list(range(37)) and all(r.slot == r.task for r in dealt)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_events_are_neither_moved_nor_sorted_again(spark):
    ordering = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    spark.conf.set(ordering, "true")
    try:
        result = prepare_export(spark, two_products().sources(spark), RUN)
        run = result.run
        per_product = gates.by_product(run.grid, gates.GRID_COLUMNS, ["label", *placement.PRODUCT])
        for df in (result.daily, run.runs, gates.check_runs(run.runs), per_product):
            plan = plan_of(df)
            assert "Bucketed: true" in plan and "Exchange" not in plan and "Sort [" not in plan
        assert "rangepartitioning" not in plan_of(gates.result_gates(run))
        assert gates.failures(gates.result_gates(run)) == []
        tables = list(result.staging.tables)
        result.cleanup()
        assert tables and not any(spark.catalog.tableExists(t) for t in tables)
    finally:
        spark.conf.unset(ordering)


def test_products_that_are_not_exported_leave_before_the_grouping(spark):
    store = two_products()
    for code in range(100, 150):
        store.line(store.product(code, "H bundle"), LAST, 1, 10)
    result = prepare_export(spark, store.sources(spark), RUN)
    assert {r.product for r in result.run.facts.select("product").distinct().collect()} == {1, 2}
    for broadcast in ("-1", "10MB"):  # by a shuffle that the grouping uses too, or by a broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        plan = plan_of(result.run.facts)
        assert plan.index("HashAggregate") < plan.index("Join") < plan.index("Union")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    result.cleanup()


def test_steps_of_the_window_skip_other_row_groups(spark, monkeypatch):
    monkeypatch.setattr("shelfledger.sources.staging.ROW_GROUP_BYTES", 64 << 10)
    days = spark.range(200_000).select(
        F.date_add(F.lit(date(2000, 1, 1)), (F.col("id") * 7919 % 9000).cast("int")).alias("business_date"), F.xxhash64("id").alias("value")
    )
    staging = Staging(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = staging.write_clustered("ledger", days.coalesce(1), "business_date")
        window = stored.where(F.col("business_date").between(F.lit(date(2020, 1, 1)), F.lit(date(2020, 12, 31))))
        rows = window.collect()
        scan = window._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        read = scan.metrics().apply("numOutputRows").value()
        assert len(rows) == days.where("year(business_date) = 2020").count() and len(rows) <= read < 200_000 / 5
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        staging.cleanup()
    result = prepare_export(spark, two_products().sources(spark), RUN)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    for step in (result.run.daily_promo, result.run.ledger_in_scope, result.run.movement):
        assert "GreaterThanOrEqual(business_date,2019-03-01)" in plan_of(step)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    result.cleanup()


def spoiled(monkeypatch, change):
    sound = DailyExport.daily
    monkeypatch.setattr(DailyExport, "daily", property(lambda run: change(sound.func(run))))


def stopped_write(spark, tmp_path) -> list[str]:
    with pytest.raises(GateError) as error:
        write_export(spark, two_products().sources(spark), RUN, str(tmp_path))
    return codes(error)


def test_a_zero_day_that_moves_is_seen(spark, tmp_path, monkeypatch):
    """Sums, counts and the rules of open and closed days all hold."""
    zero, shut = LAST - timedelta(3), LAST - timedelta(10)  # product 2 sold nothing on the first

    def swap(df):
        day = F.when(F.col("Date") == F.lit(zero), F.lit(shut)).when(F.col("Date") == F.lit(shut), F.lit(zero)).otherwise(F.col("Date"))
        return df.withColumn("Date", F.when(F.col("ProductCode") == 2, day).otherwise(F.col("Date")))

    spoiled(monkeypatch, swap)
    assert stopped_write(spark, tmp_path) == ["I-2"]


def test_a_doubled_row_raises_the_key_gate_itself(spark, tmp_path, monkeypatch):
    spoiled(monkeypatch, lambda df: df.unionByName(df.where(f"ProductCode = 2 and Date = '{LAST - timedelta(10)}'")))
    found = stopped_write(spark, tmp_path)
    assert "I-5" in found and "I-2" not in found and "I-8" not in found


def test_a_doubled_row_in_place_of_a_closed_day(spark, tmp_path, monkeypatch):
    """As many rows as before."""
    lost, doubled = LAST - timedelta(9), LAST - timedelta(10)
    change = F.when((F.col("ProductCode") == 2) & (F.col("Date") == F.lit(lost)), F.lit(doubled)).otherwise(F.col("Date"))
    spoiled(monkeypatch, lambda df: df.withColumn("Date", change))
    assert stopped_write(spark, tmp_path) == ["I-5"]
