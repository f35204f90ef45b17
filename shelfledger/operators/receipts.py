"""First completed internal receipt of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfledger.functions.expressions import PRODUCT_KEYS, receipt_status
from shelfledger.functions.joins import sorted_side


def clean_receipt_ts() -> Column:
    """First receipt time of a day in the warehouse day ledger; NULL if any receipt of that day is undated or misdated."""
    doubtful = F.col("any_missing_receipt") | F.coalesce(F.col("any_receipt_mismatch"), F.lit(False))
    return F.when(F.col("has_receipt") & ~doubtful, F.col("first_candidate_ts"))


def first_receipt(imex_daily: DataFrame, targets: DataFrame) -> DataFrame:
    """Receipt days of the final population inside its window, with the reason when no time can be given."""
    scope = targets.select("site", "product", "window_start", "window_end")
    first = clean_receipt_ts()
    return (
        imex_daily.where("has_receipt")
        .join(sorted_side(scope), PRODUCT_KEYS)
        .where("business_date between window_start and window_end")
        .select(
            "site",
            "product",
            "business_date",
            F.col("first_receipt_date"),
            first.alias("first_receipt_ts"),
            F.hour(first).alias("receipt_hour"),
            receipt_status(
                F.coalesce("any_receipt_mismatch", F.lit(False)),
                F.col("any_missing_receipt"),
                F.coalesce("any_date_only_receipt", F.lit(False)),
            ).alias("receipt_status"),
        )
    )
