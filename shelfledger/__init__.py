"""Daily store demand ledger on Spark: sales, price, promotion, stock and receipts per product and day."""

from shelfledger.params import ExportParams
from shelfledger.plans.daily_export import DailyExport, ExportResult, run_export, write_export
from shelfledger.plans.merge import merge_stores
from shelfledger.plans.published import PublishedExport, merge_published, read_export
from shelfledger.sources.bundle import Sources, combine_sites, load_sources
from shelfledger.sources.readers import catalog_tables, jdbc_tables, parquet_tables
from shelfledger.violations import GateError, Violation

__all__ = [
    "DailyExport",
    "ExportParams",
    "ExportResult",
    "GateError",
    "PublishedExport",
    "Sources",
    "Violation",
    "catalog_tables",
    "combine_sites",
    "jdbc_tables",
    "load_sources",
    "merge_published",
    "merge_stores",
    "parquet_tables",
    "read_export",
    "run_export",
    "write_export",
]
