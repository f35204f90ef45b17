"""Queries on the dense result leave its rows where they lie, and give what plain grouping gives."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.oracle import ATTRIBUTE_COLUMNS, DAILY_SUMMARY
from shelfledger import ExportParams
from shelfledger.operators import ledgers, stock
from shelfledger.plans import gates
from shelfledger.plans.daily_export import DailyExport
from shelfledger.sources.staging import Staging
from tests.store import LAST, minimal_store

STOCK = ["product", "business_date", "open_stock", "close_stock", "daily_net_movement", "stock_status"]


@pytest.fixture(scope="module")
def run(spark):
    """Product 2 stands in the catalog eight times, so that it lies under several labels."""
    store = minimal_store()
    for code in (2, 3, 4):
        store.line(store.product(code), LAST - timedelta(code), 4, 40)
        store.line(code, LAST - timedelta(3 * code), 2, 10, returned=True)
        store.document(code, LAST - timedelta(5), 1, 3, 9)
    for _ in range(7):
        store.product(2)
    found = DailyExport(spark, store.sources(spark), ExportParams(run_date=date(2024, 3, 10)), Staging(spark))
    assert [r.product for r in found.split_products.collect()] == [2]
    yield found
    found.staging.cleanup()


def above_dense_rows(df) -> list[str]:
    """Operators above the expansion into days, nearest first, up to the first exchange or join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan[: plan.index("Generate posexplode")].splitlines()[-2::-1]
    stop = next(n for n, line in enumerate(lines) if "Exchange" in line or "LeftSemi" in line)
    return lines[:stop]


@pytest.mark.parametrize("query", ["daily_source_digest", "stock_digest", "daily_source_by_product"])
def test_days_of_a_product_are_gathered_in_place(run, query):
    assert sum("Aggregate" in line for line in above_dense_rows(getattr(contract, query)(run))) >= 2


@pytest.mark.parametrize("query", ["daily_source_digest", "stock_digest"])
def test_rows_are_hashed_ahead_of_the_grouping(run, query):
    """Inside ``collect_list`` they would be hashed one call at a time, and whole rows would be sorted."""
    above = above_dense_rows(getattr(contract, query)(run))
    assert any("Project" in line and "concat_ws" in line for line in above)
    assert not any("Aggregate" in line and "concat_ws" in line for line in above)


def test_days_without_movement_leave_before_the_join(run):
    assert any("Filter" in line and "offset" in line for line in above_dense_rows(contract.stock_event_days(run)))


def test_days_are_compared_in_place(run):
    assert any("Window" in line for line in above_dense_rows(contract.stock_continuity(run)))


def plain_digest(rows, product, day):
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in sorted(rows.columns)]
    row = F.struct(F.col(day).alias("day"), F.md5(F.concat_ws("|", *cells).cast("binary")).alias("row"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["row"]), "")
    return rows.groupBy(F.col(product).alias("product")).agg(F.count(F.lit(1)).alias("days"), F.md5(text.cast("binary")).alias("digest"))


def plain(run, query):
    if query == "daily_source_digest":
        return plain_digest(run.daily, "ProductCode", "Date")
    if query == "stock_digest":
        return plain_digest(run.grid.select(*STOCK), "product", "business_date")
    if query == "stock_event_days":
        days = run.movement.select(*stock.PRODUCT, "business_date")
        return run.grid.join(days, [*stock.PRODUCT, "business_date"], "left_semi").select(*STOCK)
    if query == "stock_by_product":
        return run.grid.groupBy(*stock.PRODUCT).agg(
            F.count(F.lit(1)), F.sum("open_stock"), F.sum("close_stock"), F.sum("daily_net_movement"),
            *[F.count_if(F.col("stock_status") == status) for status in ("VALID", "NEGATIVE", "UNKNOWN_QUANTITY")],
        )
    if query == "stock_continuity":
        by_day = stock.W.partitionBy(*stock.PRODUCT).orderBy("business_date")
        pairs = run.grid.select("open_stock", F.lag("close_stock").over(by_day).alias("previous"))
        return pairs.agg(F.count("previous"), F.count_if(F.abs(F.col("open_stock") - F.col("previous")) > 0.000001))
    values = [F.expr(sql.replace('"', "`")).alias(name) for name, sql in DAILY_SUMMARY]
    if query == "daily_source_by_date":
        return run.daily.groupBy("Date", "HasSalesRecord").agg(*values)
    return run.daily.groupBy("ProductCode", *ATTRIBUTE_COLUMNS).agg(F.min("Date"), F.max("Date"), *values)


@pytest.mark.parametrize(
    "query",
    ["daily_source_digest", "stock_digest", "stock_event_days", "stock_by_product", "stock_continuity", "daily_source_by_date", "daily_source_by_product"],
)
def test_a_product_under_several_labels_counts_once(run, query):
    found = getattr(contract, query)(run)
    expected = plain(run, query)
    assert [f.dataType for f in found.schema] == [f.dataType for f in expected.schema]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, (tuple(r) for r in expected.collect())))


def test_sums_of_the_row_checks_pass_over_zeros(spark):
    """Closed days and zeros add nothing, quantities beside them do, and rows that break a rule are counted as before."""
    cells = {1: [("0", "0"), (None, None)], 2: [("0", "0"), ("2.5", "1"), ("-1", "0")], 3: [("1", "2"), ("0", None)]}
    rows = [
        (0, product, LAST + timedelta(place), sales is not None, sales, promo)
        for product, given in cells.items()
        for place, (sales, promo) in enumerate(given)
    ]
    df = spark.createDataFrame(rows, "site int, product int, day date, open boolean, s string, p string").selectExpr(
        "site", "product", "day", "open", "cast(s as decimal(38,6)) sales", "cast(p as decimal(38,6)) promo", "false is_promo", "'893' barcode"
    )
    names = ("day", "open", "sales", "promo", "is_promo", "barcode")
    found = {r["product"]: r for r in gates.by_product(df, dict(zip(names, names)), stock.PRODUCT).collect()}
    assert [found[1][name] for name in ("sales_total", "promo_total", "rows", "I-1", "I-2b")] == [None, None, 2, 0, 0]
    assert [found[2][name] for name in ("sales_total", "promo_total", "rows", "I-1", "I-2b")] == [Decimal("1.5"), 1, 3, 0, 1]
    assert [found[3][name] for name in ("sales_total", "promo_total", "rows", "I-1", "I-2b")] == [1, 2, 2, 1, 1]
    expected = df.select(*stock.PRODUCT).distinct().selectExpr(
        "*", "if(product = 1, 2L, if(product = 2, 3L, 2L)) expected_rows", "if(product = 2, cast(1.5 as decimal(38,6)), null) sale_lines",
        "if(product = 1, null, cast(product as decimal(38,6))) promo_lines", "0L sale_print", "0L promo_print",
    )
    gate = {r.gate: r.violations for r in gates.product_gates(expected, gates.by_product(df, dict(zip(names, names)), stock.PRODUCT).withColumn("label", F.lit(0))).collect()}
    assert gate["I-4"] == 0 and gate["I-8"] == 1  # of product 3, whose lines have no sale


def test_queries_on_steps_stage_no_control_columns(spark, monkeypatch):
    """Nothing but the gates reads them. Other runs stage and read the same ledgers otherwise, and refuse the gates."""
    store = minimal_store()
    store.line(1, LAST - timedelta(3), 2, 8, returned=True)
    store.document(1, LAST - timedelta(5), 1, 3, 9)
    params, staged = ExportParams(run_date=date(2024, 3, 10)), []
    runs = [DailyExport(spark, store.sources(spark), params, Staging(spark), controlled) for controlled in (True, False)]
    try:
        for name in ("pos_lines", "imex_daily", "movement", "metadata"):
            whole, plain = (sorted(map(str, getattr(run, name).collect())) for run in runs)
            assert whole == plain and whole, name
        for run in runs:
            staged.append([set(spark.read.parquet(f"{run.staging.path}/{name}").columns) for name in ("pos_ledger", "imex_book")])
        assert staged[0][0] - staged[1][0] == {"line_print"}
        assert staged[0][1] - staged[1][1] == set(ledgers.IMEX_CONTROLS)
        assert gates.failures(runs[0].ledger_gates()) == []
        with pytest.raises(ValueError, match="control"):
            runs[1].ledger_gates()
    finally:
        for run in runs:
            run.staging.cleanup()

    class Asked(Exception):
        pass

    def export(spark, sf_dir, staged, params, controlled):
        raise Asked(controlled)

    monkeypatch.setattr(contract, "export", export)
    for name, wanted in {"pos_lines": False, "metadata": False, "gate_report": True}.items():
        with pytest.raises(Asked, match=str(wanted)):
            contract.queries()[name](spark, "")
