"""Source tables and result contracts.

Every source table is read under its ERP name and columns and turned into the frame named here. ``site``, added to each
frame, says which store database a row came from, and leads every grouping key downstream.
"""

from __future__ import annotations

from dataclasses import dataclass


# Type of header keys: any integer type.
KEY = "key"


@dataclass(frozen=True)
class SourceTable:
    name: str
    frame: str
    columns: dict[str, tuple[str, str]]  # source column -> (frame column, Spark type or KEY)
    gate: str
    optional: bool = False


# Table and column names of the source database.
CONFIG = SourceTable("tbl_SYSConfiguration", "config", {"Store": ("store_code", "int")}, "G3")
STORE = SourceTable("tbl_LSStore", "store", {"Code": ("store_code", "int"), "Store": ("store_name", "string")}, "G4")
PRODUCT = SourceTable(
    "tbl_LSProduct",
    "product",
    {
        "Code": ("product", "int"),
        "GroupID": ("group_code", "string"),
        "Barcode": ("barcode", "string"),
        "VName": ("product_name", "string"),
        "Brand": ("brand_code", "string"),
        "Quantitative": ("quantitative", "string"),
        "PackingSize": ("packing_size", "string"),
    },
    "G7",
)
PRODUCT_GROUP = SourceTable(
    "tbl_LSGroup",
    "product_group",
    {
        "Code": ("group_code", "string"),
        "ParentID": ("parent_code", "string"),
        "GroupID": ("group_id", "string"),
        "GroupName": ("group_name", "string"),
    },
    "G8",
)
POS_DETAIL = SourceTable(
    "tbl_SALPoSDetails",
    "pos_detail",
    {
        "Product": ("product", "int"),
        "PoSMaster": ("pos_master", KEY),
        "Qty": ("qty", "decimal(38,6)"),
        "Amount": ("amount", "decimal(38,6)"),
        "RePosDetails": ("re_pos_details", "bigint"),
        "Discount": ("discount", "int"),
    },
    "G9",
)
POS_MASTER = SourceTable(
    "tbl_SALPoSMaster",
    "pos_master",
    {"Code": ("code", KEY), "TransactionDate": ("transaction_ts", "timestamp_ntz")},
    "G10",
)
IMEX_DETAIL = SourceTable(
    "tbl_OPSImExDetails",
    "imex_detail",
    {
        "Product": ("product", "int"),
        "DocumentNo": ("document_no", KEY),
        "Quantity": ("quantity", "decimal(38,6)"),
        "QtyReceived": ("qty_received", "decimal(38,6)"),
    },
    "S5",
)
IMEX_MASTER = SourceTable(
    "tbl_OPSImExMaster",
    "imex_master",
    {
        "Code": ("code", KEY),
        "EffDate": ("eff_ts", "timestamp_ntz"),
        "DocumentType": ("document_type", "int"),
        "DocumentStatus": ("document_status", "int"),
        "ReceiptDate": ("receipt_ts", "timestamp_ntz"),
    },
    "S5",
)
BUNDLE = SourceTable("tbl_POLBundle", "bundle", {"Code": ("discount", "int"), "Promotion": ("promotion", "int")}, "S5")
PROMOTION = SourceTable(
    "tbl_POLPromotion",
    "promotion",
    {
        "Code": ("promotion", "int"),
        "StartDate": ("start_date", "date"),
        "EndDate": ("end_date", "date"),
        "Type": ("promotion_type", "int"),
    },
    "S5",
)
# The brand table may be absent, and the column with the name is found at run time.
BRAND = SourceTable("tbl_LSBrand", "brand", {"Code": ("brand_code", "string")}, "", optional=True)
BRAND_NAME_COLUMNS = ("BrandName", "Brand", "VName", "Name")

REQUIRED_TABLES = (
    CONFIG,
    STORE,
    PRODUCT,
    PRODUCT_GROUP,
    POS_DETAIL,
    POS_MASTER,
    IMEX_DETAIL,
    IMEX_MASTER,
    BUNDLE,
    PROMOTION,
)
ALL_TABLES = (*REQUIRED_TABLES, BRAND)

GROUP_LEVELS = 5

# The 31 columns of the daily result, in order.
DAILY_COLUMNS = (
    "ProductCode",
    "ProductName",
    "Barcode",
    "LocationCode",
    "LocationName",
    "Date",
    "HasSalesRecord",
    "SalesQty",
    "PromoSalesQty",
    "IsPromo",
    "OpenStock",
    "CloseStock",
    "FirstReceiptDateTime",
    "Price",
    "GroupID",
    "GroupName",
    "GroupID2",
    "GroupName2",
    "GroupID3",
    "GroupName3",
    "GroupID4",
    "GroupName4",
    "GroupID5",
    "GroupName5",
    "BrandCode",
    "BrandName",
    "Quantitative",
    "PackingSize",
    "HolidayEvent",
    "HolidayGroup",
    "HolidayRelation",
)

# The 28 columns of the metadata row, in order.
METADATA_COLUMNS = (
    "LatestAvailableSourceDate",
    "LatestConfirmedCompleteDate",
    "SalesDataCutoffDate",
    "DataStartDate",
    "DataEndDate",
    "InactivityWindowMonths",
    "InactivityWindowStartDate",
    "ProductsInSALPoSDetails",
    "ProductsNotInProductMaster",
    "ProductsWithMissingBarcode",
    "SourceBarcodeBeforePrefixRule",
    "HPrefixExcludedBarcodeCount",
    "HPrefixExcludedProductCount",
    "RetailCandidateProductBeforeInactivity",
    "PosOnlyRuleDroppedStockedProductCount",
    "InactiveNoPositiveSales",
    "InactiveNoPositiveOpenStock",
    "InactiveNoPositiveCloseStock",
    "InactiveNoReceipt",
    "InactiveUntrustedStockKept",
    "LongTermInactiveExcludedProductCount",
    "LongTermInactiveExcludedBarcodeCount",
    "RetailBarcodeBeforeTestMode",
    "FinalExportProductCount",
    "ExportedBarcodeCount",
    "BarcodeSharedByMultipleProductCode",
    "PriceConflictSkuDayCount",
    "TestModeMaxBarcodes",
)
