"""Discount codes, the promotions behind them, and quantity sold on promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfledger.functions.expressions import promo_type_eligible


def used_discounts(lines: DataFrame) -> DataFrame:
    return lines.where("discount is not null").select("site", "discount").distinct()


def promotion_of_code(bundle: DataFrame) -> DataFrame:
    """One promotion per discount code. Codes with several are refused by a gate before this is relied on."""
    return (
        bundle.where("discount is not null")
        .groupBy("site", "discount")
        .agg(F.max("promotion").alias("promotion"), F.count_distinct("promotion").alias("promotions"))
    )


def resolve_discounts(used: DataFrame, bundle: DataFrame, promotion: DataFrame) -> DataFrame:
    """Each used code with what was found for it: a bundle, a promotion, its type and dates."""
    found = promotion_of_code(bundle).select("site", "discount", "promotion", F.lit(True).alias("in_bundle"))
    promo = promotion.where("promotion is not null").withColumn("in_promotion", F.lit(True))
    no = F.lit(False)
    return (
        used.join(found, ["site", "discount"], "left")
        .join(promo, ["site", "promotion"], "left")
        .select(
            "site",
            "discount",
            F.coalesce("in_bundle", no).alias("bundle_found"),
            F.coalesce("in_promotion", no).alias("promotion_found"),
            F.when(F.col("in_promotion"), F.col("promotion")).alias("promotion"),
            "start_date",
            "end_date",
            "promotion_type",
        )
    )


def discount_audit(resolution: DataFrame) -> DataFrame:
    """Why used codes did not become promotions. A NULL type counts neither as eligible nor as ineligible."""
    return resolution.groupBy("site").agg(
        F.count_if(~F.col("bundle_found")).alias("DiscountMappingMissing"),
        F.count_if(F.col("bundle_found") & ~F.col("promotion_found")).alias("DiscountPromotionMissing"),
        F.count_if(F.col("promotion_found") & ~promo_type_eligible(F.col("promotion_type"))).alias(
            "DiscountTypeNotEligible"
        ),
    )


def eligible_promotions(bundle: DataFrame, promotion: DataFrame) -> DataFrame:
    """Discount codes that can make a sale a promotion sale, with the days on which they do."""
    return (
        promotion_of_code(bundle)
        .join(promotion, ["site", "promotion"])
        .where(promo_type_eligible(F.col("promotion_type")) & F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
        .select("site", "discount", "start_date", "end_date")
    )


def promo_rows(lines: DataFrame, eligible: DataFrame) -> DataFrame:
    """Sale rows whose discount code stands for an eligible promotion on that day."""
    return (
        lines.where("not is_return and discount is not null")
        .join(eligible, ["site", "discount"])
        .where("business_date between start_date and end_date")
    )


def daily_promo(lines: DataFrame, bundle: DataFrame, promotion: DataFrame) -> DataFrame:
    return (
        promo_rows(lines, eligible_promotions(bundle, promotion))
        .groupBy("site", "product", "business_date")
        .agg(F.sum("qty").alias("promo_qty"))
    )
