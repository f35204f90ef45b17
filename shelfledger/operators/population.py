"""Which products are exported, over which days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shelfledger.functions.expressions import PRODUCT_KEYS, has_bundle_prefix, missing_barcode
from shelfledger.functions.joins import sorted_side
from shelfledger.operators.catalog import brand_names, group_columns, group_path
from shelfledger.params import ExportParams

ATTRIBUTES = ("product_name", "group_code", "brand_code", "quantitative", "packing_size")


def pos_product_audit(ledger: DataFrame, product: DataFrame, collation: str = "UTF8_BINARY") -> DataFrame:
    """Every product seen in POS, with its catalog row and the reasons that could exclude it."""
    catalog = product.where("product is not null").withColumn("in_catalog", F.lit(True))
    if collation != "UTF8_BINARY":
        catalog = catalog.withColumn("barcode", F.collate("barcode", collation))
    return (
        ledger.select("site", "product")
        .distinct()
        .join(sorted_side(catalog), PRODUCT_KEYS, "left")
        .select(
            "site",
            "product",
            "barcode",
            F.col("in_catalog").isNull().alias("missing_from_master"),
            missing_barcode(F.col("barcode")).alias("missing_barcode"),
            has_bundle_prefix(F.col("barcode")).alias("has_h_prefix"),
            *ATTRIBUTES,
        )
    )


def retail_candidates(audit: DataFrame) -> DataFrame:
    return audit.where("not missing_from_master and not missing_barcode and not has_h_prefix")


def population_audit(audit: DataFrame) -> DataFrame:
    """Counters per site. Names say whether they count products or distinct barcodes."""
    with_code = ~F.col("missing_from_master")
    return audit.groupBy("site").agg(
        F.count(F.lit(1)).alias("ProductsInSALPoSDetails"),
        F.count_if("missing_from_master").alias("ProductsNotInProductMaster"),
        F.count_if(with_code & F.col("missing_barcode")).alias("ProductsWithMissingBarcode"),
        F.count_distinct(F.when(~F.col("missing_barcode"), F.col("barcode"))).alias("SourceBarcodeBeforePrefixRule"),
        F.count_distinct(F.when(F.col("has_h_prefix"), F.col("barcode"))).alias("HPrefixExcludedBarcodeCount"),
        F.count_if("has_h_prefix").alias("HPrefixExcludedProductCount"),
        F.count_if(with_code & ~F.col("missing_barcode") & ~F.col("has_h_prefix")).alias(
            "RetailCandidateProductBeforeInactivity"
        ),
    )


def pos_only_dropped(imex_daily: DataFrame, audit: DataFrame, product: DataFrame) -> DataFrame:
    """Products with a valid retail barcode and warehouse rows that never appeared in POS, counted per site."""
    stocked = imex_daily.select("site", "product").distinct()
    never_sold = stocked.join(sorted_side(audit.select("site", "product")), ["site", "product"], "left_anti")
    retail = product.where(~missing_barcode(F.col("barcode")) & ~has_bundle_prefix(F.col("barcode")))
    return (
        never_sold.join(sorted_side(retail), ["site", "product"])
        .groupBy("site")
        .agg(F.count(F.lit(1)).alias("PosOnlyRuleDroppedStockedProductCount"))
    )


def export_windows(pos_ledger: DataFrame, imex_daily: DataFrame, params: ExportParams) -> DataFrame:
    """Latest source date of each site up to the run date, and the window that ends there.

    Looks at every product and also at documents without a stock effect; never at the population.
    """
    dates = pos_ledger.select("site", "business_date").unionByName(imex_daily.select("site", "business_date"))
    past = F.when(F.col("business_date") <= F.lit(params.run_date), F.col("business_date"))
    return (
        dates.groupBy("site")
        .agg(F.max(past).alias("window_end"))
        .withColumn("window_start", F.date_add(F.add_months("window_end", -12 * params.lookback_years), 1))
    )


#: Parts of a site that are ranked apart before the site is.
SAMPLE_PARTS = 64


def sample_barcodes(products: DataFrame, n: int) -> DataFrame:
    """Products of ``n`` distinct barcodes per site in a stable hash order; a shared barcode keeps all its products.

    The first ``n`` of each part of a site are found first, so only they meet in one task.
    """
    order = F.xxhash64(F.col("barcode").cast("string"))
    barcodes = products.select("site", "barcode").distinct()
    barcodes = barcodes.select("*", order.alias("order"), F.pmod(F.hash(order), F.lit(SAMPLE_PARTS)).alias("part"))
    for keys in (["site", "part"], ["site"]):
        place = F.row_number().over(W.partitionBy(*keys).orderBy("order", "barcode"))
        barcodes = barcodes.withColumn("place", place).where(F.col("place") <= n)
    return products.join(barcodes.select("site", "barcode"), ["site", "barcode"], "left_semi")


def target_products(candidates: DataFrame, groups: DataFrame, brands: DataFrame, windows: DataFrame) -> DataFrame:
    """Candidates that stay, with display attributes and window. A missing group or brand leaves NULL, never drops."""
    if "is_long_term_inactive" in candidates.columns:
        candidates = candidates.where(~F.coalesce("is_long_term_inactive", F.lit(False)))
    paths = group_path(groups).withColumnRenamed("assigned_group", "group_code")
    return (
        candidates.join(paths, ["site", "group_code"], "left")
        .join(brand_names(brands), ["site", "brand_code"], "left")
        .join(windows, "site")
        .select(
            "site",
            "product",
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
    )


def barcode_counts(targets: DataFrame) -> DataFrame:
    """Products, distinct barcodes and barcodes shared by several products, per site."""
    per_barcode = targets.groupBy("site", "barcode").agg(F.count(F.lit(1)).alias("products"))
    return per_barcode.groupBy("site").agg(
        F.sum("products").alias("FinalExportProductCount"),
        F.count("barcode").alias("ExportedBarcodeCount"),
        F.count_if(F.col("products") > 1).alias("BarcodeSharedByMultipleProductCode"),
    )
