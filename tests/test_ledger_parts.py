"""Quantities as whole millionths beside wide decimals, and evidence whose rows of the window are dealt once."""

from __future__ import annotations

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from shelfledger import ExportParams
from shelfledger.functions.expressions import DEC, millionths, millionths_of_double, millionths_of_whole, price_millionths, unit_price
from shelfledger.operators import inactivity, ledgers
from tests.store import minimal_store

QUANTITIES = [0.0, -0.0, 0.1, 0.1 + 0.2, -2.5, 0.000001, 0.0000004, 12.345678, 99999.999999, -99999.999999, 100000.0, 2.5e7, 1e30, 1e300, float("nan"), None]
STEP = Decimal("0.000001")


def test_small_numbers_are_those_of_the_decimals(spark):
    df = spark.createDataFrame([(q,) for q in QUANTITIES], "q double").withColumn("d", F.col("q").try_cast(DEC))
    df = df.select("q", "d", millionths_of_double(F.col("q")).alias("fast"), millionths(F.col("d")).alias("slow"))
    rows = df.collect()
    for row in rows:
        expected = None if row.d is None or abs(row.d) >= 100_000 else int(row.d * 1_000_000)
        assert row.slow == expected and row.fast in (None, expected), row
    assert {row.q for row in rows if row.fast is not None} >= {0.0, 0.1, -2.5, 0.000001, 12.345678, 99999.999999}
    whole = spark.createDataFrame([(3,), (-99_999,), (100_000,), (2**63 - 1,), (None,)], "q bigint").select(millionths_of_whole(F.col("q")))
    assert [row[0] for row in whole.collect()] == [3_000_000, -99_999_000_000, None, None, None]


def test_prices_of_small_numbers_round_as_decimals_do(spark):
    pairs = [("10", "3"), ("-10", "3"), ("1", "80000"), ("0.000001", "2"), ("-0.000001", "2"), ("99999.999999", "0.000001"), ("0", "7")]
    df = spark.createDataFrame([(Decimal(a), Decimal(q)) for a, q in pairs], f"a {DEC}, q {DEC}")
    small = price_millionths(millionths(F.col("a")), millionths(F.col("q")))
    for row in df.select("a", "q", small.alias("small"), unit_price(F.col("a"), F.col("q")).alias("wide")).collect():
        assert Decimal(row.small) * STEP == row.wide == (row.a / row.q).quantize(STEP, ROUND_HALF_UP), row


def lines_of(spark):
    """Two days of a product with small, large and unknown quantities, and the header of all of them."""
    given = [(q, a) for q in ("2.5", "250000.5", None, "99999.999999") for a in ("7", "1234567.891", "-0.000005", None)] * 3
    rows = [(0, 1, k % 2, q and Decimal(q), a and Decimal(a), 5 if k % 7 == 0 else None, 6 if k % 5 == 0 else None) for k, (q, a) in enumerate(given)]
    lines = spark.createDataFrame(rows, f"site int, product int, pos_master bigint, qty {DEC}, amount {DEC}, re_pos_details bigint, discount int")
    return lines, spark.sql("select 0 site, id code, timestamp_ntz'2024-02-10 23:59:59' + make_dt_interval(cast(id as int)) transaction_ts from range(2)")


def test_large_and_small_quantities_meet_in_one_sum(spark):
    lines, masters = lines_of(spark)
    price = F.when(F.expr("re_pos_details is null and discount is null and qty > 0 and amount is not null"), unit_price(F.col("amount"), F.col("qty")))
    day = F.date_add(F.lit(date(2024, 2, 10)), F.col("pos_master").cast("int")).alias("business_date")
    expected = lines.groupBy("site", "product", day, "discount", F.col("re_pos_details").isNotNull().alias("is_return")).agg(
        F.sum("qty").alias("qty"),
        F.count(F.lit(1)).alias("line_count"),
        F.bool_or(F.col("qty").isNull()).alias("has_null_qty"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )
    found = ledgers.pos_ledger(lines, masters)
    assert found.schema["qty"].dataType == expected.schema["qty"].dataType
    assert sorted(map(str, found.drop(*ledgers.CONTROLS).collect())) == sorted(map(str, expected.collect()))
    held, given = ledgers.pos_ledger_totals(found).first(), ledgers.pos_line_totals(lines).first()
    assert held.asDict() == given.asDict() and given.unknown_lines == 12


def test_no_wide_decimal_of_a_small_line_is_dealt_to_its_header(spark):
    """Sources bring whole millionths; the join moves them, and a decimal column that only large quantities fill."""
    sources = minimal_store().sources(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (
            ledgers.pos_ledger(sources.pos_detail, sources.pos_master),
            ledgers.imex_book(ledgers.imex_lines(sources.imex_detail, sources.imex_master)),
        ):
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            below = plan[plan.index("Join LeftOuter") :]
            assert "small_q" in below.split("\n")[1] and "large_q" in below.split("\n")[1], plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


PARAMS = ExportParams(run_date=date(2024, 3, 31), sales_data_cutoff_date=date(2024, 2, 29))
LEDGER = f"site int, product int, business_date date, discount int, is_return boolean, qty {DEC}, has_null_qty boolean"
IMEX = (
    f"site int, product int, business_date date, net_qty {DEC}, has_unknown_qty boolean, has_receipt boolean, "
    "first_candidate_ts timestamp_ntz, any_missing_receipt boolean, any_receipt_mismatch boolean"
)


def test_evidence_deals_rows_of_the_window_once(spark):
    start, later, old = date(2022, 3, 1), date(2024, 1, 20), date(2020, 1, 1)

    def sold(product, day, qty, returned=False, discount=None):
        return 0, product, day, discount, returned, None if qty is None else Decimal(qty), qty is None

    ledger = spark.createDataFrame(
        [
            sold(1, old, 4), sold(1, old, 1, True), sold(1, start, None), sold(1, later, 5),
            sold(2, start, None), sold(2, start, None, True), sold(2, later, 3), sold(2, later, -3, False, 6),
            sold(3, later, 2, True), sold(5, date(2024, 3, 5), 9), sold(6, old, None),
        ],
        LEDGER,
    )
    imex = spark.createDataFrame([(0, 1, old, Decimal(20), False, False, None, False, None), (0, 4, later, None, True, False, None, False, None)], IMEX)
    candidates = spark.createDataFrame([(0, product) for product in range(1, 8)], "site int, product int")
    found = inactivity.inactivity_evidence(candidates, ledger, imex, PARAMS)
    values = {row.product: tuple(row)[2:9] for row in found.collect()}
    # sold, received, stock at the start, highest opening and closing stock, lowest stock, unknown
    assert values[1] == (True, False, 17, 17, 12, 12, True)  # nothing is known of the first day, so it has no closing stock
    assert values[2] == (False, False, 0, 0, 0, 0, True)  # sale and return rows side by side: a net of zero, and none is sold in all
    assert values[3] == (False, False, 0, 2, 2, 0, False)
    assert values[4] == (False, False, 0, 0, 0, 0, True)
    assert values[5] == values[7] == (False, False, 0, 0, 0, 0, False)  # after the cutoff; no movement at all
    assert values[6] == (False, False, 0, 0, 0, 0, True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    window = plan[plan.index("Window") :]
    window = window[: window.index("Union")]
    assert window.count("Exchange") == 1, plan
