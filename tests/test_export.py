"""One hand-made store; every product is one case."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from shelfledger import ExportParams, read_export, run_export, write_export
from shelfledger.plans.daily_export import prepare_export
from shelfledger.schemas import DAILY_COLUMNS, METADATA_COLUMNS
from tests.store import LAST, Store

DAY = date(2024, 2, 10)
RETURNS_ONLY = date(2024, 2, 12)
CLOSED = date(2024, 2, 13)
NULL_PRODUCT_DAY = date(2024, 2, 14)
BEFORE = date(2018, 5, 1)
FULL = ExportParams(run_date=date(2024, 3, 10))
GATED = ExportParams(run_date=date(2024, 3, 10), sales_data_cutoff_date=LAST)


def build() -> Store:
    s = Store()
    s.line(s.product(1, group=300, brand=5), LAST, 1, 10)
    s.line(1, DAY, 5, 50)
    s.line(1, DAY, 2, 20, returned=True)
    s.line(1, RETURNS_ONLY, 1, 10, returned=True)
    s.line(None, NULL_PRODUCT_DAY, 3, 30)
    # Prices.
    s.line(s.product(10), DAY, 3, 2)  # 2/3 rounds up
    s.line(s.product(11), DAY, 1, 10)
    s.line(11, DAY, 2, 22)
    s.line(11, date(2024, 2, 11), 2, 20)
    s.line(11, date(2024, 2, 11), 1, 10)
    s.line(s.product(12), DAY, 1, 10, discount=61)
    s.line(12, DAY, 0, 10)
    # Promotions.
    s.promotion(61, 1, 2, date(2024, 2, 5), date(2024, 2, 10))
    s.promotion(62, 2, 1, date(2024, 1, 1), date(2024, 12, 31))
    s.promotion(63, 3, None, date(2024, 1, 1), date(2024, 12, 31))
    s.promotion(64, 4, False, None, None)
    s.promotion(66, 6, 7, None, date(2024, 12, 31))
    s.product(20)
    for day in (date(2024, 2, 4), date(2024, 2, 5), date(2024, 2, 10), date(2024, 2, 11)):
        s.line(20, day, 2, 20, discount=61)
        s.line(20, day, 1, 10)
    s.line(20, date(2024, 2, 6), 4, 40, discount=61, returned=True)
    for code in (62, 63, 64, 65, 66):
        s.line(20, date(2024, 2, 7), 1, 10, discount=code)
    # Stock: a known opening, an unknown opening, an unknown day, document kinds.
    s.line(s.product(30), LAST, 1, 10)
    s.document(30, BEFORE, 1, 3, 40)
    s.document(30, DAY, 5, 6, 7)
    s.document(30, DAY, 10, 5, 100)
    s.document(30, DAY, 99, 3, 100)
    s.document(30, DAY, 2, 2, None, quantity=7)  # in progress: known zero unless asked for
    s.line(s.product(31), BEFORE, None)
    s.document(31, DAY, 1, 3, 5)
    s.line(s.product(32), date(2024, 1, 1), 1, 10)
    s.document(32, DAY, 1, 3, None)
    s.document(32, date(2024, 2, 20), 1, 3, 9)
    # Receipts.
    s.line(s.product(40), DAY, 1, 10)
    s.document(40, DAY, 1, 3, 1, receipt=datetime(2024, 2, 10, 9, 15))
    s.document(40, DAY, 1, 3, 1, receipt=datetime(2024, 2, 10, 8, 30, 0, 400_000))
    s.document(40, date(2024, 2, 11), 1, 3, 1)
    s.document(40, date(2024, 2, 12), 1, 3, 1, receipt=datetime(2024, 2, 13, 8, 0))
    s.document(40, date(2024, 2, 15), 1, 3, 1, receipt=None)
    s.document(40, date(2024, 2, 15), 1, 3, 1)
    s.document(40, date(2024, 2, 16), 1, 3, 1, receipt=datetime(2024, 2, 16, 23, 59, 59, 700_000))
    s.document(40, date(2024, 2, 17), 21, 3, 1, receipt=datetime(2024, 2, 17, 7, 0))
    # Population.
    for code, barcode in ((50, None), (51, ""), (52, "  "), (53, " H1"), (54, "H1"), (55, "HL1"), (56, "h1")):
        s.line(s.product(code, barcode), DAY, 1, 10)
    s.line(57, DAY, 1, 10)  # not in the catalog
    s.line(57, DAY, 1, 10, header=False)  # an orphan outside the population does not matter
    s.document(s.product(58), DAY, 1, 3, 5)  # stocked, never sold
    s.document(s.product(59, "H59"), DAY, 1, 3, 5)
    s.line(s.product(60, "shared"), DAY, 1, 10)
    s.line(s.product(61, "shared"), DAY, 1, 10)
    # Inactivity, window 2022-03-01 .. 2024-02-29.
    old = date(2020, 1, 1)

    def quiet(code):
        s.line(s.product(code), old, 5, 50)
        s.document(code, old, 3, 3, 5)

    for code in range(70, 78):
        quiet(code)
    s.line(71, date(2022, 3, 1), 1, 10)
    s.document(71, date(2022, 3, 1), 3, 3, 1)
    s.document(72, date(2023, 1, 1), 1, 3, 1)
    s.document(72, date(2023, 1, 1), 5, 6, 1)
    s.document(73, LAST, 3, 3, 1)
    s.document(74, old, 3, 3, 1)
    s.document(75, date(2023, 1, 1), 3, 3, None)
    s.document(76, date(2023, 1, 1), 5, 6, 1)
    s.document(77, date(2023, 1, 1), 1, 3, 0, receipt=date(2023, 1, 2))  # misdated receipt is no receipt
    # Catalog.
    s.group(100)
    s.group(200, 100)
    s.group(300, 200)
    s.rows["tbl_LSBrand"] += [(5, "Acme"), (5, "Bcme"), (None, "x")]
    return s


@pytest.fixture(scope="module")
def full(spark):
    return run_export(spark, build().sources(spark), FULL)


@pytest.fixture(scope="module")
def daily(full):
    rows = full.daily.collect()
    return {(r["ProductCode"], r["Date"]): r for r in rows}, rows


@pytest.fixture(scope="module")
def metadata(full):
    return full.metadata.first()


def test_contract(full, daily):
    cells, rows = daily
    assert full.daily.columns == list(DAILY_COLUMNS)
    assert full.metadata.columns == list(METADATA_COLUMNS)
    assert len(cells) == len(rows)
    kinds = dict(full.daily.dtypes)
    assert kinds["ProductCode"] == "int" and kinds["Date"] == "date" and kinds["FirstReceiptDateTime"] == "timestamp_ntz"
    assert {kinds[c] for c in ("SalesQty", "PromoSalesQty", "OpenStock", "CloseStock", "Price")} == {"decimal(38,6)"}
    assert {kinds[c] for c in ("HolidayEvent", "HolidayGroup", "HolidayRelation", "Barcode")} == {"string"}


def test_leap_window_is_dense_and_ordered(daily):
    cells, rows = daily
    products = {p for p, _ in cells}
    days = sorted({d for _, d in cells})
    assert (days[0], days[-1]) == (date(2019, 3, 1), LAST)
    assert len(days) == 1827 and len(rows) == len(products) * 1827
    assert [(r["ProductCode"], r["Date"]) for r in rows] == sorted(cells)


def test_sales_exclude_returns_and_stock_includes_them(daily):
    row = daily[0][1, DAY]
    assert row["SalesQty"] == 5
    assert row["CloseStock"] - row["OpenStock"] == -3


def test_open_and_closed_days(daily):
    cells, _ = daily
    back = cells[1, RETURNS_ONLY]
    assert back["HasSalesRecord"] and back["SalesQty"] == 0 and back["PromoSalesQty"] == 0
    for day in (CLOSED, NULL_PRODUCT_DAY):
        shut = cells[1, day]
        assert not shut["HasSalesRecord"] and shut["SalesQty"] is None and shut["PromoSalesQty"] is None
        assert not shut["IsPromo"] and shut["CloseStock"] is not None


def test_price(daily, metadata):
    cells, _ = daily
    assert cells[10, DAY]["Price"] == Decimal("0.666667")
    assert cells[11, DAY]["Price"] is None
    assert cells[11, date(2024, 2, 11)]["Price"] == 10
    assert cells[12, DAY]["Price"] is None and cells[12, DAY]["SalesQty"] == 1
    assert metadata["PriceConflictSkuDayCount"] == 1


def test_promotion_dates_types_and_mapping(daily):
    cells, _ = daily
    got = {d: (cells[20, d]["SalesQty"], cells[20, d]["PromoSalesQty"], cells[20, d]["IsPromo"]) for _, d in cells}
    assert got[date(2024, 2, 4)] == (3, 0, False)
    assert got[date(2024, 2, 5)] == (3, 2, True)
    assert got[date(2024, 2, 10)] == (3, 2, True)
    assert got[date(2024, 2, 11)] == (3, 0, False)
    assert got[date(2024, 2, 6)] == (0, 0, False)
    assert got[date(2024, 2, 7)] == (5, 0, False)


def test_discount_warnings(full):
    found = dict(full.warnings)
    assert (found["DiscountMappingMissing"], found["DiscountPromotionMissing"], found["DiscountTypeNotEligible"]) == (1, 1, 1)
    assert found["CUTOFF_NOT_DECLARED"] == 1 and found["BARCODE_SHARED_BY_MULTIPLE_PRODUCTCODE"] == 1


def test_stock(daily):
    cells, _ = daily
    assert cells[30, date(2019, 3, 1)]["OpenStock"] == 40
    assert (cells[30, DAY]["OpenStock"], cells[30, DAY]["CloseStock"]) == (40, 33)
    assert cells[30, LAST]["CloseStock"] == 32
    assert {r["CloseStock"] for (p, _), r in cells.items() if p == 31} == {None}
    assert cells[32, DAY - timedelta(1)]["CloseStock"] == -1
    assert {cells[32, d]["CloseStock"] for _, d in cells if d >= DAY} == {None}
    assert {cells[32, d]["OpenStock"] for _, d in cells if d >= DAY} == {None}
    assert cells[10, date(2019, 3, 1)]["OpenStock"] == 0


def test_stock_continues(daily):
    cells, _ = daily
    for (product, day), row in cells.items():
        before = cells.get((product, day - timedelta(1)))
        if before and row["OpenStock"] is not None and before["CloseStock"] is not None:
            assert row["OpenStock"] == before["CloseStock"]


def test_first_receipt(daily):
    cells, _ = daily
    got = {d: cells[40, d]["FirstReceiptDateTime"] for _, d in cells}
    assert got[DAY] == datetime(2024, 2, 10, 8, 30)
    assert got[date(2024, 2, 11)] == datetime(2024, 2, 11)
    for day in (date(2024, 2, 12), date(2024, 2, 15), date(2024, 2, 16), date(2024, 2, 17)):
        assert got[day] is None


def test_receipt_status(full):
    got = {r["business_date"].day: r for r in full.run.first_receipt.where("product = 40").collect()}
    assert {d: r["receipt_status"] for d, r in got.items()} == {
        10: "TIMED",
        11: "DATE_ONLY",
        12: "DATE_MISMATCH",
        15: "MISSING",
        16: "DATE_MISMATCH",
    }
    assert got[10]["receipt_hour"] == 8 and got[16]["first_receipt_date"] == date(2024, 2, 17)


def test_population(daily, metadata):
    products = {p for p, _ in daily[0]}
    assert products & set(range(50, 62)) == {53, 56, 60, 61}
    assert metadata["ProductsInSALPoSDetails"] == len(products) + 6
    assert metadata["ProductsNotInProductMaster"] == 1
    assert metadata["ProductsWithMissingBarcode"] == 3
    assert (metadata["HPrefixExcludedBarcodeCount"], metadata["HPrefixExcludedProductCount"]) == (2, 2)
    assert metadata["PosOnlyRuleDroppedStockedProductCount"] == 1
    assert metadata["BarcodeSharedByMultipleProductCode"] == 1
    assert metadata["FinalExportProductCount"] == len(products) == metadata["ExportedBarcodeCount"] + 1
    assert metadata["InactiveNoReceipt"] is None and metadata["InactivityWindowStartDate"] is None


def test_attributes(daily):
    row = daily[0][1, DAY]
    assert [row["GroupID"], row["GroupID2"], row["GroupID3"], row["GroupID4"]] == ["G100", "G200", "G300", None]
    assert (row["BrandCode"], row["BrandName"], row["LocationCode"], row["LocationName"]) == (
        "5",
        "Bcme",
        "Main street",
        "Main street",
    )
    assert daily[0][10, DAY]["GroupName"] is None


def test_inactivity_keeps_every_near_miss(spark, full):
    result = prepare_export(spark, build().sources(spark), GATED)
    verdict = {r["product"]: r for r in result.run.candidates.collect()}
    assert {p for p, r in verdict.items() if r["is_long_term_inactive"]} == {70, 77}
    close_only = verdict[73]
    assert close_only["max_close_stock"] == 1 and close_only["max_open_stock"] == 0
    assert verdict[72]["has_receipt"] and not verdict[77]["has_receipt"]
    assert verdict[74]["max_open_stock"] == 1 and verdict[76]["min_stock"] == -1
    assert verdict[75]["has_untrusted_stock"] and verdict[76]["has_untrusted_stock"]
    row = result.metadata.first()
    assert row["LongTermInactiveExcludedProductCount"] == 2 and row["InactivityWindowStartDate"] == date(2022, 3, 1)
    assert row["FinalExportProductCount"] == full.metadata.first()["FinalExportProductCount"] - 2
    assert row["DataEndDate"] == LAST


def test_in_progress_documents(spark):
    params = ExportParams(run_date=FULL.run_date, include_in_progress_documents=True)
    result = prepare_export(spark, build().sources(spark), params)
    row = result.daily.where(f"ProductCode = 30 and Date = '{DAY}'").first()
    assert row["CloseStock"] - row["OpenStock"] == -7 + 7  # type 10 in progress has no effect


def test_sample_keeps_shared_products_and_the_window(spark, full):
    params = ExportParams(run_date=FULL.run_date, test_mode_max_barcodes=5)
    result = run_export(spark, build().sources(spark), params)
    row = result.metadata.first()
    assert row["ExportedBarcodeCount"] == 5 and row["TestModeMaxBarcodes"] == 5
    assert row["RetailBarcodeBeforeTestMode"] == full.metadata.first()["RetailBarcodeBeforeTestMode"]
    assert row["DataStartDate"] == date(2019, 3, 1)
    assert result.daily.count() == row["FinalExportProductCount"] * 1827
    assert result.daily.select("ProductCode").distinct().join(
        full.daily.select("ProductCode").distinct(), "ProductCode", "left_anti"
    ).isEmpty()
    assert result.daily.exceptAll(full.daily).isEmpty()


def test_input_order_and_unsold_catalog_rows_do_not_matter(spark, full):
    store = build()
    for rows in store.rows.values():
        rows.reverse()
    for code in range(900, 905):
        store.product(code)
    again = prepare_export(spark, store.sources(spark), FULL)
    assert again.daily.exceptAll(full.daily).isEmpty() and full.daily.exceptAll(again.daily).isEmpty()


def test_collation(spark):
    params = ExportParams(run_date=FULL.run_date, barcode_collation="UTF8_LCASE")
    result = prepare_export(spark, build().sources(spark), params)
    assert result.run.targets.where("product = 56").isEmpty()
    assert dict(result.daily.dtypes)["Barcode"] == "string"


def test_written_export_is_published_with_metadata_last(spark, full, tmp_path):
    warnings = write_export(spark, build().sources(spark), FULL, str(tmp_path))
    assert dict(warnings) == dict(full.warnings)
    written = read_export(spark, str(tmp_path))
    assert written.daily.count() == full.daily.count()
    assert written.daily.exceptAll(full.daily).isEmpty()
    assert written.metadata.first() == full.metadata.first() and written.locations == ("Main street",)


def test_scan_reconciliation_and_header_keys_pass(spark):
    params = ExportParams(run_date=FULL.run_date, reconcile_scans=True)
    prepare_export(spark, build().sources(spark), params)
