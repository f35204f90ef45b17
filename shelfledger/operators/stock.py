"""Opening and closing stock from movement, kept sparse until the last step.

A product's state changes only on days with an event. The running sums therefore work on one row per product and event
day, and each such row is then repeated for the days up to the next event. The dense grid of products and days is never
shuffled, sorted or joined.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfledger.functions.expressions import DEC, PRODUCT_KEYS, sales_or_null, stock_status
from shelfledger.functions.joins import sorted_side
from shelfledger.operators.catalog import group_columns
from shelfledger.operators.promo import promo_rows
from shelfledger.operators.receipts import clean_receipt_ts
from shelfledger.operators.sales import in_scope

ATTRIBUTES = (
    "product_name",
    "barcode",
    *group_columns(),
    "brand_code",
    "brand_name",
    "quantitative",
    "packing_size",
    "window_start",
    "window_end",
)
STORE = ("location_code", "location_name")
PRODUCT = ["site", "product"]


def stock_seed(targets: DataFrame, ledger: DataFrame, imex_daily: DataFrame) -> DataFrame:
    """Stock at the start of the window. No movement before it is a known zero; any unknown quantity makes it unknown.

    Both ledgers meet the targets in one join, which deals them by product as the sums need.
    """
    scope = targets.select(*PRODUCT, "window_start")
    before = (
        ledger.select(
            *PRODUCT,
            "business_date",
            F.when(F.col("is_return"), F.col("qty")).otherwise(-F.col("qty")).cast(DEC).alias("net_qty"),
            F.col("has_null_qty").alias("unknown"),
        )
        .unionByName(imex_daily.select(*PRODUCT, "business_date", "net_qty", F.col("has_unknown_qty").alias("unknown")))
        .join(sorted_side(scope), PRODUCT_KEYS)
        .where("business_date < window_start")
        .groupBy(*PRODUCT)
        .agg(F.sum("net_qty").alias("net_qty"), F.bool_or("unknown").alias("unknown"))
    )
    known = ~F.coalesce("unknown", F.lit(False))
    return (
        targets.select(*PRODUCT)
        .join(sorted_side(before), PRODUCT_KEYS, "left")
        .select(
            *PRODUCT,
            F.when(known, F.coalesce("net_qty", F.lit(0).cast(DEC))).alias("seed_net_movement"),
            known.alias("is_seed_known"),
        )
    )


def daily_movement(
    targets: DataFrame, ledger: DataFrame, imex_daily: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Net stock movement per product and day of the window. One unknown warehouse quantity makes the day unknown.

    Both ledgers meet the targets in one join, which deals them by product as the sums need.
    """
    kinds = {"imex_net": 1, "pos_out": 2, "pos_back": 4}
    returned = F.col("is_return")
    rows = imex_daily.select(
        *PRODUCT,
        "business_date",
        F.lit(kinds["imex_net"]).alias("kind"),
        F.col("net_qty").alias("imex_net"),
        F.col("has_unknown_qty").alias("unknown"),
    ).unionByName(
        ledger.select(
            *PRODUCT,
            "business_date",
            F.when(returned, F.lit(kinds["pos_back"])).otherwise(F.lit(kinds["pos_out"])).alias("kind"),
            F.when(~returned, F.col("qty")).alias("pos_out"),
            F.when(returned, F.col("qty")).alias("pos_back"),
            F.lit(False).alias("unknown"),
        ),
        allowMissingColumns=True,
    )

    def summed(name: str) -> Column:
        """Zero beside rows of another kind; NULL where a day has rows of this kind alone, all without a quantity."""
        return F.coalesce(name, F.when(F.col("kinds") != kinds[name], F.lit(0).cast(DEC))).alias(name)

    sums = in_scope(rows, targets, first, last).groupBy(*PRODUCT, "business_date").agg(
        F.bit_or("kind").alias("kinds"),
        F.sum("imex_net").alias("imex_net"),
        F.sum("pos_out").alias("pos_out"),
        F.sum("pos_back").alias("pos_back"),
        F.bool_or("unknown").alias("has_unknown_movement"),
    )
    sums = sums.select(
        *PRODUCT,
        "business_date",
        (F.col("kinds").bitwiseAND(kinds["imex_net"]) != 0).alias("has_inventory_movement"),
        summed("imex_net"),
        summed("pos_out").alias("pos_out_qty"),
        summed("pos_back").alias("return_qty"),
        "has_unknown_movement",
    )
    known = ~F.col("has_unknown_movement")
    net = F.col("imex_net") - F.col("pos_out_qty") + F.col("return_qty")
    return sums.select(
        *PRODUCT,
        "business_date",
        "has_inventory_movement",
        F.when(known, F.col("imex_net")).alias("inventory_net_movement"),
        "pos_out_qty",
        "return_qty",
        F.when(known, net).cast(DEC).alias("daily_net_movement"),
        "has_unknown_movement",
    )


def daily_facts(ledger: DataFrame, imex_daily: DataFrame, eligible: DataFrame, targets: DataFrame, tasks: int) -> DataFrame:
    """Everything known about a product-day, one row per exported product and event day, with the product's ``label``.

    Everything before the window falls on one opening day, the day before it, which makes the opening stock part of the
    same running sum. Each product has a row on the window's first day. Rows are dealt by product to so many ``tasks``: as their
    number follows that of the products, what a task sums does not grow with the input. Products that are not exported leave in
    the join that brings label and window, ahead of the grouping, which needs no other dealing.
    """
    events = (
        ledger.select(
            *PRODUCT,
            "business_date",
            F.when(F.col("is_return"), F.col("qty")).otherwise(-F.col("qty")).cast(DEC).alias("net_qty"),
            F.col("has_null_qty").alias("unknown"),
            F.when(~F.col("is_return"), F.col("qty")).alias("sales_qty"),
            "min_price",
            "max_price",
        )
        .unionByName(
            promo_rows(ledger, eligible).select(
                *PRODUCT, "business_date", F.col("qty").alias("promo_qty"), F.lit(True).alias("is_promo")
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            imex_daily.select(
                *PRODUCT,
                "business_date",
                "net_qty",
                F.col("has_unknown_qty").alias("unknown"),
                clean_receipt_ts().alias("receipt_ts"),
            ),
            allowMissingColumns=True,
        )
        .unionByName(targets.select(*PRODUCT, F.col("window_start").alias("business_date")), allowMissingColumns=True)
    )
    scope = targets.select(*PRODUCT, "label", "window_start", "window_end")
    scope = sorted_side(scope.repartition(tasks, *PRODUCT_KEYS))
    rows = events.repartition(tasks, *PRODUCT_KEYS).join(scope, PRODUCT_KEYS).where("business_date <= window_end")
    day = F.greatest("business_date", F.date_sub("window_start", 1)).alias("day")
    return rows.groupBy("label", *PRODUCT, day).agg(
        F.sum("net_qty").alias("net_qty"),
        F.bool_or("unknown").alias("unknown"),
        F.sum("sales_qty").alias("sales_qty"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("promo_qty").alias("promo_qty"),
        F.bool_or("is_promo").alias("is_promo"),
        F.max("receipt_ts").alias("receipt_ts"),
    )


#: How stored event days are dealt and sorted.
STORED_BY, STORED_ORDER = "label", ("label", *PRODUCT, "day")


def ordered_events(facts: DataFrame, targets: DataFrame, partitions: int) -> DataFrame:
    """Event days dealt to the task that writes their product, while still sparse.

    A header row ahead of each product's first day brings the attributes and its store's name and open days, so no join
    follows. Every task has products of an equal share of the dense rows, whatever their number of events.
    """
    header = targets.select(
        "label",
        *PRODUCT,
        F.date_sub("window_start", 2).alias("day"),
        F.struct(*ATTRIBUTES, *STORE).alias("attributes"),
        "open_days",
    )
    return facts.unionByName(header, allowMissingColumns=True).repartition(partitions, STORED_BY)


def stock_runs(events: DataFrame) -> DataFrame:
    """Event days with running stock, the number of days each state holds, and the product's attributes.

    Events that are dealt by label and sorted are neither moved nor, where Spark is told of it, sorted again.
    """
    by_day = W.partitionBy("label", *PRODUCT).orderBy("day")
    so_far = by_day.rowsBetween(W.unboundedPreceding, W.currentRow)
    known_net = F.when(~F.coalesce("unknown", F.lit(False)), F.col("net_qty"))
    net = F.coalesce(known_net, F.lit(0).cast(DEC))
    window_start, window_end = F.col("attributes.window_start"), F.col("attributes.window_end")
    low, high = F.col("min_price"), F.col("max_price")
    return (
        events.withColumn("net_qty", net)
        .select(
            "label",
            *PRODUCT,
            "day",
            "net_qty",
            F.sum("net_qty").over(so_far).alias("close_if_clean"),
            F.bool_or("unknown").over(so_far).alias("tainted"),
            F.lead("day").over(by_day).alias("next_day"),
            F.first("attributes", ignorenulls=True).over(so_far).alias("attributes"),
            F.first("open_days", ignorenulls=True).over(so_far).alias("open_days"),
            "sales_qty",
            "promo_qty",
            "is_promo",
            F.when(low == high, high).alias("price"),
            "receipt_ts",
        )
        .where(F.col("attributes").isNotNull() & (F.col("day") >= window_start))
        .withColumn("tainted", F.coalesce("tainted", F.lit(False)))
        .withColumn("run_days", F.date_diff(F.coalesce("next_day", F.date_add(window_end, 1)), "day"))
        .drop("next_day")
    )


def expand_runs(runs: DataFrame) -> DataFrame:
    """One row per product and calendar day. Events belong to the first day of a run; stock holds for all of it."""
    first = F.date_diff("day", "attributes.window_start") + 1
    open_days = F.slice("open_days", first, F.col("run_days"))
    days = runs.select("*", F.posexplode(open_days).alias("offset", "has_sales_record"))
    event = F.col("offset") == 0
    is_open, clean = F.col("has_sales_record"), ~F.col("tainted")
    open_stock = F.when(event, F.col("close_if_clean") - F.col("net_qty")).otherwise(F.col("close_if_clean")).cast(DEC)

    def on_event(name: str) -> Column:
        return F.when(event, F.col(name))

    return days.select(
        "label",
        *PRODUCT,
        F.date_add("day", F.col("offset")).alias("business_date"),
        "has_sales_record",
        sales_or_null(is_open, on_event("sales_qty")).alias("sales_qty"),
        sales_or_null(is_open, on_event("promo_qty")).alias("promo_qty"),
        F.coalesce(is_open & on_event("is_promo"), F.lit(False)).alias("is_promo"),
        F.when(clean, open_stock).alias("open_stock"),
        F.when(clean, F.col("close_if_clean")).alias("close_stock"),
        F.coalesce(on_event("net_qty"), F.lit(0).cast(DEC)).alias("daily_net_movement"),
        stock_status(F.col("tainted"), open_stock, F.col("close_if_clean")).alias("stock_status"),
        on_event("receipt_ts").alias("first_receipt_ts"),
        on_event("price").alias("price"),
        event.alias("starts_run"),
        "attributes",
    )


def check_runs(runs: DataFrame) -> DataFrame:
    """Per run: does its opening stock differ from the closing stock before it, and does it start on the wrong day?

    Runs that follow each other without gap or overlap give each product every day once.
    """
    by_day = W.partitionBy("label", *PRODUCT).orderBy("day")
    clean = ~F.col("tainted")
    opening = F.when(clean, F.col("close_if_clean") - F.col("net_qty"))
    previous_close = F.lag(F.when(clean, F.col("close_if_clean"))).over(by_day)
    expected_day = F.lag(F.date_add("day", F.col("run_days"))).over(by_day)
    jump = F.abs(opening - previous_close) > F.lit("0.000001").cast(DEC)
    misplaced = (F.col("run_days") < 1) | (F.col("day") != expected_day)
    return runs.select(
        *PRODUCT,
        "day",
        F.coalesce(jump, F.lit(False)).alias("stock_jumps"),
        F.coalesce(misplaced, F.lit(False)).alias("is_misplaced"),
    )
