"""A hand-made store database for tests."""

from __future__ import annotations

from datetime import date, datetime, time
from decimal import Decimal

from pyspark.sql import SparkSession

from shelfledger import load_sources

SCHEMAS = {
    "tbl_SYSConfiguration": "Store int",
    "tbl_LSStore": "Code int, Store string",
    "tbl_LSProduct": "Code int, GroupID int, Barcode string, VName string, Brand int, Quantitative string, PackingSize string",
    "tbl_LSGroup": "Code int, ParentID int, GroupID string, GroupName string",
    "tbl_LSBrand": "Code int, BrandName string",
    "tbl_SALPoSDetails": "Product int, PoSMaster int, Qty decimal(18,3), Amount decimal(18,2), RePosDetails int, Discount int",
    "tbl_SALPoSMaster": "Code int, TransactionDate timestamp_ntz",
    "tbl_OPSImExDetails": "Product int, DocumentNo int, Quantity decimal(18,3), QtyReceived decimal(18,3)",
    "tbl_OPSImExMaster": "Code int, EffDate timestamp_ntz, DocumentType int, DocumentStatus int, ReceiptDate timestamp_ntz",
    "tbl_POLBundle": "Code int, Promotion int",
    "tbl_POLPromotion": "Code int, StartDate date, EndDate date, Type int",
}
LAST = date(2024, 2, 29)
SAME = "same"


def dec(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def at(day: date | datetime | None) -> datetime | None:
    return datetime.combine(day, time()) if isinstance(day, date) and not isinstance(day, datetime) else day


class Store:
    def __init__(self, code: int = 7, name: str = "Main street"):
        self.rows: dict[str, list[tuple]] = {table: [] for table in SCHEMAS}
        self.schemas = dict(SCHEMAS)
        self.rows["tbl_SYSConfiguration"].append((code,))
        self.rows["tbl_LSStore"].append((code, name))
        self.next = 1

    def product(self, code, barcode=SAME, group=None, brand=None, name=None):
        bar = f"893{code}" if barcode == SAME else barcode
        self.rows["tbl_LSProduct"].append((code, group, bar, name or f"product {code}", brand, None, None))
        return code

    def group(self, code, parent=None):
        self.rows["tbl_LSGroup"].append((code, parent, f"G{code}", f"group {code}"))

    def line(self, product, day, qty, amount=None, discount=None, returned=False, header=True):
        code = self.next
        self.next += 1
        if header:
            self.rows["tbl_SALPoSMaster"].append((code, at(day)))
        self.rows["tbl_SALPoSDetails"].append((product, code, dec(qty), dec(amount), code if returned else None, discount))

    def document(self, product, day, kind, status, received, quantity=None, receipt=SAME, header=True):
        code = self.next
        self.next += 1
        if header:
            stamp = at(day) if receipt == SAME else at(receipt)
            self.rows["tbl_OPSImExMaster"].append((code, at(day), kind, status, stamp))
        self.rows["tbl_OPSImExDetails"].append((product, code, dec(quantity), dec(received)))

    def promotion(self, discount, promotion, kind, start, end):
        self.rows["tbl_POLBundle"].append((discount, promotion))
        if kind is not False:
            self.rows["tbl_POLPromotion"].append((promotion, start, end, kind))

    def reader(self, spark: SparkSession):
        def read(table):
            if table not in self.schemas:
                return None
            return spark.createDataFrame(self.rows[table], self.schemas[table]).coalesce(1)

        return read

    def sources(self, spark: SparkSession, site: int = 0):
        return load_sources(spark, self.reader(spark), site)


def minimal_store(last: date = LAST, **kwargs) -> Store:
    """One product that sold once, on the last day."""
    store = Store(**kwargs)
    store.line(store.product(1), last, 1, 10)
    return store
