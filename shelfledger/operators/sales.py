"""Daily sales and regular price."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from shelfledger.functions.expressions import PRODUCT_KEYS, regular_price_line, unit_price
from shelfledger.functions.joins import sorted_side


def in_scope(day_frame: DataFrame, targets: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows of a ledger that belong to the final population and its window.

    ``first`` and ``last`` bound all windows; as plain values they reach the scan, which then passes over other days.
    """
    if first is not None and last is not None:
        day_frame = day_frame.where(F.col("business_date").between(F.lit(first), F.lit(last)))
    scope = targets.select("site", "product", "window_start", "window_end")
    return (
        day_frame.join(sorted_side(scope), PRODUCT_KEYS)
        .where("business_date between window_start and window_end")
        .drop("window_start", "window_end")
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    """What customers bought. Return lines never enter, not even as a reduction."""
    return lines.where(~F.col("is_return")).groupBy("site", "product", "business_date").agg(F.sum("qty").alias("sales_qty"))


def daily_price(ledger: DataFrame) -> DataFrame:
    """Regular unit price of each product-day that has one. Several prices give NULL and a conflict flag.

    The prices of a day agree exactly when their least and greatest do.
    """
    return (
        ledger.where("min_price is not null")
        .groupBy("site", "product", "business_date")
        .agg(F.min("min_price").alias("low"), F.max("max_price").alias("high"))
        .select(
            "site",
            "product",
            "business_date",
            F.when(F.col("low") == F.col("high"), F.col("high")).alias("price"),
            (F.col("low") < F.col("high")).alias("is_conflict"),
        )
    )


def price_conflicts(lines: DataFrame) -> DataFrame:
    """Product-days with several regular unit prices, and how many, from the lines themselves."""
    regular = regular_price_line(F.col("is_return"), F.col("discount"), F.col("qty"), F.col("amount"))
    return (
        lines.where(regular)
        .groupBy("site", "product", "business_date")
        .agg(F.count_distinct(unit_price(F.col("amount"), F.col("qty"))).alias("distinct_unit_prices"))
        .where("distinct_unit_prices > 1")
    )


def price_conflict_days(ledger_in_scope: DataFrame) -> DataFrame:
    return (
        daily_price(ledger_in_scope)
        .where("is_conflict")
        .groupBy("site")
        .agg(F.count(F.lit(1)).alias("PriceConflictSkuDayCount"))
    )
