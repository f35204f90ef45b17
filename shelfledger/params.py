"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class ExportParams:
    """What a person declares for one run. Pass ``run_date`` for a repeatable run."""

    run_date: date = field(default_factory=date.today)
    # Declared by the planning run. None means no inactivity gate; it is never replaced by a date from the data.
    sales_data_cutoff_date: date | None = None
    # None means full export; N keeps the products of N distinct barcodes.
    test_mode_max_barcodes: int | None = None
    # Declared by the source owner and only echoed in the metadata.
    latest_confirmed_complete_date: date | None = None
    inactivity_window_months: int = 24
    lookback_years: int = 5
    include_in_progress_documents: bool = False
    # Any Spark collation name, for sources whose barcodes compare without case or trailing blanks.
    barcode_collation: str = "UTF8_BINARY"
    # Read the POS lines a second time at line grain and compare the totals (gate G22).
    reconcile_scans: bool = False
    # Dense rows one task writes; sets the partition count from the projected row count.
    rows_per_partition: int = 2_000_000

    def problems(self) -> list[tuple[str, str]]:
        """Gate code and text of every parameter that cannot be run with."""
        found = []
        if self.test_mode_max_barcodes is not None and self.test_mode_max_barcodes <= 0:
            found.append(("G1", "test_mode_max_barcodes must be positive, or None for a full export"))
        if self.inactivity_window_months <= 0:
            found.append(("G2", "inactivity_window_months must be positive"))
        if self.sales_data_cutoff_date is not None and self.sales_data_cutoff_date > self.run_date:
            found.append(("G2b", "sales_data_cutoff_date lies after run_date"))
        return found

    @property
    def gated(self) -> bool:
        return self.sales_data_cutoff_date is not None

    def cutoff(self) -> Column:
        return F.lit(self.sales_data_cutoff_date).cast("date")

    def inactivity_start(self) -> Column:
        """First day of the inactivity window; month arithmetic clamps to the month's last day."""
        return F.date_add(F.add_months(self.cutoff(), -self.inactivity_window_months), 1)
