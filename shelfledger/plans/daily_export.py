"""The daily export: from source tables to the daily result and its metadata.

``DailyExport`` names every step once. Steps are lazy; those that feed several others go through ``staging``, which either
writes them to a folder of the run or leaves them inside the plan.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfledger.operators import calendar, catalog, inactivity, ledgers, placement, population, promo, receipts, sales, stock
from shelfledger.params import ExportParams
from shelfledger.plans import gates
from shelfledger.plans.published import is_published, publish
from shelfledger.schemas import DAILY_COLUMNS, METADATA_COLUMNS
from shelfledger.sources.bundle import Sources
from shelfledger.sources.staging import Staging, WithoutStaging, remove
from shelfledger.violations import GateError, Violation

LOG = logging.getLogger("shelfledger")
#: Shares of the dense rows whose products one task brings to event days.
PARTITIONS_PER_FACT_TASK = 8

# The daily columns and what they are called in the grid.
DAILY_SOURCE = {
    "ProductCode": "product",
    "LocationCode": "attributes.location_code",
    "LocationName": "attributes.location_name",
    "Date": "business_date",
    "HasSalesRecord": "has_sales_record",
    "SalesQty": "sales_qty",
    "PromoSalesQty": "promo_qty",
    "IsPromo": "is_promo",
    "OpenStock": "open_stock",
    "CloseStock": "close_stock",
    "FirstReceiptDateTime": "first_receipt_ts",
    "Price": "price",
    "ProductName": "attributes.product_name",
    "Barcode": "attributes.barcode",
    "BrandCode": "attributes.brand_code",
    "BrandName": "attributes.brand_name",
    "Quantitative": "attributes.quantitative",
    "PackingSize": "attributes.packing_size",
}
for _level in ("", "2", "3", "4", "5"):
    DAILY_SOURCE[f"GroupID{_level}"] = f"attributes.group_id{_level}"
    DAILY_SOURCE[f"GroupName{_level}"] = f"attributes.group_name{_level}"


def daily_columns(names: list[str]) -> list[Column]:
    """Daily columns from those of the grid."""
    columns = []
    for name in names:
        if name in DAILY_SOURCE:
            column = F.col(DAILY_SOURCE[name])
            columns.append((column.cast("string") if name == "Barcode" else column).alias(name))
        else:
            columns.append(F.lit(None).cast("string").alias(name))  # filled by a later enrichment
    return columns


class DailyExport:
    def __init__(
        self,
        spark: SparkSession,
        sources: Sources,
        params: ExportParams,
        staging: Staging | WithoutStaging | None = None,
        controlled: bool = True,
    ):
        """``controlled`` runs stage what the control of the ledgers' lines reads; others, of steps alone, cannot check gates."""
        self.spark = spark
        self.sources = sources
        self.params = params
        self.controlled = controlled
        self.staging = staging or WithoutStaging()
        self.stage = self.staging.write

    # Ledgers: the only joins of the transaction tables. They are stored by day, as most later steps want the window only.

    @cached_property
    def pos_ledger(self) -> DataFrame:
        def stage(book: DataFrame) -> DataFrame:
            book = book if self.controlled else book.drop("line_print")
            return self.staging.write_clustered("pos_ledger", book, "business_date")

        return ledgers.pos_ledger(self.sources.pos_detail, self.sources.pos_master, stage)

    @cached_property
    def imex_ledger(self) -> DataFrame:
        return ledgers.imex_ledger(
            self.sources.imex_detail, self.sources.imex_master, self.params.include_in_progress_documents
        )

    @cached_property
    def imex_book(self) -> DataFrame:
        sources, params = self.sources, self.params
        lines = ledgers.imex_lines(sources.imex_detail, sources.imex_master, params.include_in_progress_documents)
        book = ledgers.imex_book(lines)
        book = book if self.controlled else book.drop(*ledgers.IMEX_CONTROLS)
        return self.staging.write_clustered("imex_book", book, "business_date")

    @cached_property
    def imex_daily(self) -> DataFrame:
        return ledgers.imex_daily(self.imex_book)

    @cached_property
    def pos_daily(self) -> DataFrame:
        return ledgers.pos_daily(self.pos_ledger)

    # Population.

    @cached_property
    def audit(self) -> DataFrame:
        return self.stage(
            "pos_products",
            population.pos_product_audit(self.pos_ledger, self.sources.product, self.params.barcode_collation),
        )

    @cached_property
    def windows(self) -> DataFrame:
        return self.stage("windows", population.export_windows(self.pos_ledger, self.imex_daily, self.params))

    @cached_property
    def candidates(self) -> DataFrame:
        """Retail candidates; with a cutoff they carry their inactivity evidence."""
        found = population.retail_candidates(self.audit)
        if not self.params.gated:
            return found
        return self.stage(
            "candidates",
            inactivity.inactivity_evidence(found, self.pos_ledger, self.imex_daily, self.params),
        )

    @cached_property
    def all_targets(self) -> DataFrame:
        """The final population before any sampling."""
        return self.stage(
            "targets",
            population.target_products(self.candidates, self.sources.product_group, self.sources.brand, self.windows),
        )

    @cached_property
    def targets(self) -> DataFrame:
        if self.params.test_mode_max_barcodes is None:
            return self.all_targets
        return self.stage(
            "sample", population.sample_barcodes(self.all_targets, self.params.test_mode_max_barcodes)
        )

    # Lines in scope: final population, export window.

    @cached_property
    def bounds(self) -> tuple[date | None, date | None]:
        """First and last day of all windows, as plain values, which reach the scans."""
        return tuple(self.windows.agg(F.min("window_start"), F.max("window_end")).first())

    @cached_property
    def pos_lines(self) -> DataFrame:
        return ledgers.pos_lines(self.sources.pos_detail, self.sources.pos_master, self.targets, *self.bounds)

    @cached_property
    def ledger_in_scope(self) -> DataFrame:
        return sales.in_scope(self.pos_ledger, self.targets, *self.bounds)

    @cached_property
    def used_discounts(self) -> DataFrame:
        return promo.used_discounts(self.ledger_in_scope)

    @cached_property
    def promotion_codes(self) -> DataFrame:
        return promo.promotion_of_code(self.sources.bundle)

    @cached_property
    def discount_resolution(self) -> DataFrame:
        return promo.resolve_discounts(self.used_discounts, self.sources.bundle, self.sources.promotion)

    @cached_property
    def daily_promo(self) -> DataFrame:
        return promo.daily_promo(self.ledger_in_scope, self.sources.bundle, self.sources.promotion)

    # Stock pieces on their own.

    @cached_property
    def seed(self) -> DataFrame:
        return stock.stock_seed(self.targets, self.pos_ledger, self.imex_daily)

    @cached_property
    def movement(self) -> DataFrame:
        return stock.daily_movement(self.targets, self.pos_ledger, self.imex_daily, *self.bounds)

    @cached_property
    def first_receipt(self) -> DataFrame:
        return receipts.first_receipt(self.imex_daily, self.targets)

    # The grid.

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar.store_calendar(self.windows, ledgers.activity_days(self.pos_ledger))

    @cached_property
    def projection(self) -> dict[str, int]:
        """Sites and dense rows to expect, counted before any product is multiplied by days."""
        days = F.date_diff("window_end", "window_start") + 1
        row = self.targets.groupBy("site").agg(F.sum(days).alias("rows"), F.max(days).alias("days"))
        row = row.agg(F.count(F.lit(1)).alias("sites"), F.sum("rows").alias("rows"), F.max("days").alias("days")).first()
        return {"sites": row["sites"], "rows": row["rows"] or 0, "days": row["days"] or 0}

    @cached_property
    def partitions(self) -> int:
        """Enough partitions for the dense rows: the sparse input is too small to tell how much work follows.

        A multiple of the parallelism, so that the last wave of equally large tasks is full.
        """
        slots = self.spark.sparkContext.defaultParallelism
        wanted = -(-self.projection["rows"] // self.params.rows_per_partition)
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        return min(max(-(-wanted // slots), 1) * slots, most)

    @cached_property
    def fact_tasks(self) -> int:
        """Tasks that sum event days: fewer than ``partitions``, as every one of them deals its rows to all of those."""
        return max(self.partitions // PARTITIONS_PER_FACT_TASK, self.spark.sparkContext.defaultParallelism)

    @cached_property
    def placed(self) -> DataFrame:
        """The targets with the task that writes them."""
        return self.stage("placed", placement.placed(self.targets, self.partitions, self.stage))

    @cached_property
    def facts(self) -> DataFrame:
        eligible = promo.eligible_promotions(self.sources.bundle, self.sources.promotion)
        return stock.daily_facts(self.pos_ledger, self.imex_daily, eligible, self.placed, self.fact_tasks)

    @cached_property
    def events(self) -> DataFrame:
        """Event days as the result and its checks read them: dealt and sorted once."""
        events = stock.ordered_events(self.facts, self.placed.join(F.broadcast(self.site_days), "site"), self.partitions)
        return self.staging.write_bucketed("events", events, self.partitions, stock.STORED_BY, stock.STORED_ORDER)

    @cached_property
    def runs(self) -> DataFrame:
        return stock.stock_runs(self.events)

    @cached_property
    def identity(self) -> DataFrame:
        return self.stage("stores", catalog.store_identity(self.sources.config, self.sources.store))

    @cached_property
    def site_days(self) -> DataFrame:
        """Name and open days of each store; every product brings its store's along, so no join follows the ordering."""
        return calendar.open_day_flags(self.calendar).join(self.identity, "site")

    @cached_property
    def grid(self) -> DataFrame:
        return stock.expand_runs(self.runs)

    @cached_property
    def dealt_daily(self) -> DataFrame:
        """The daily rows with what dealt them to tasks: groups that begin with ``label`` meet in place, unshuffled."""
        return self.grid.select("label", "site", "attributes", *daily_columns(DAILY_COLUMNS))

    @cached_property
    def daily(self) -> DataFrame:
        """The 31 columns in order, partitioned and sorted by product and date within each site."""
        return self.dealt_daily.select(*DAILY_COLUMNS)

    @cached_property
    def split_products(self) -> DataFrame:
        """Products that lie under several labels: at most one for each place where slots are cut, as a repeated code may."""
        dealt = self.placed.groupBy("product").agg(F.count_distinct("label", "site").alias("labels"))
        return dealt.where("labels > 1").select("product")

    # Totals and metadata.

    @cached_property
    def expected(self) -> DataFrame:
        """What every product of the result must add up to: days, quantities, and fingerprints of all its days."""
        return gates.expected_products(
            self.targets, self.calendar, sales.daily_sales(self.ledger_in_scope), self.daily_promo
        )

    @cached_property
    def site_metadata(self) -> DataFrame:
        """The metadata columns for each site."""
        p = self.params
        pieces = [
            population.population_audit(self.audit),
            population.pos_only_dropped(self.imex_daily, self.audit, self.sources.product),
            self.all_targets.groupBy("site").agg(F.count_distinct("barcode").alias("RetailBarcodeBeforeTestMode")),
            population.barcode_counts(self.targets),
            sales.price_conflict_days(self.ledger_in_scope),
        ]
        if p.gated:
            pieces.append(inactivity.inactivity_audit(self.candidates))
        row = self.windows
        for piece in pieces:
            row = row.join(piece, "site", "left")
        start = p.inactivity_start() if p.gated else F.lit(None).cast("date")
        declared = {
            "LatestAvailableSourceDate": F.col("window_end"),
            "LatestConfirmedCompleteDate": F.lit(p.latest_confirmed_complete_date).cast("date"),
            "SalesDataCutoffDate": p.cutoff(),
            "DataStartDate": F.col("window_start"),
            "DataEndDate": F.col("window_end"),
            "InactivityWindowMonths": F.lit(p.inactivity_window_months),
            "InactivityWindowStartDate": start,
            "TestModeMaxBarcodes": F.lit(p.test_mode_max_barcodes).cast("int"),
        }
        columns = []
        for name in METADATA_COLUMNS:
            if name in declared:
                value = declared[name]
            elif name.startswith(("Inactive", "LongTerm")) and not p.gated:
                value = F.lit(None).cast("bigint")  # not assessed, which differs from none found
            else:
                value = F.coalesce(name, F.lit(0))
            columns.append(value.alias(name))
        return self.stage("metadata", row.select("site", *columns))

    @cached_property
    def metadata(self) -> DataFrame:
        return self.site_metadata.select(*METADATA_COLUMNS)

    # Checks.

    def check_parameters(self) -> None:
        found = [Violation(gate, text) for gate, text in self.params.problems()]
        if found:
            raise GateError(found)

    def source_gates(self) -> DataFrame:
        s = self.sources
        found = [gates.identity_gates(s.config, s.store), gates.key_gates(s.product)]
        if s.refused is not None:
            found.append(gates.value_gates(s.refused))
        return gates.union_all(found)

    def ledger_gates(self) -> DataFrame:
        if not self.controlled:
            raise ValueError("this run stages its ledgers without what their control reads")
        return gates.ledger_gates(self)

    def gate_report(self) -> DataFrame:
        """Violations of every gate, one row per gate.

        NULL where this report does not evaluate a gate: those on parameters and schemas, which stop a run before there
        is data to report on, and those that the parameters leave off.
        """
        return self._report(gates.union_all([self.gates_before_result(), gates.result_gates(self)]), gates.not_evaluated(self.params))

    def gates_before_result(self) -> DataFrame:
        """All gates that precede the dense result."""
        return gates.union_all(
            [
                self.source_gates(),
                self.ledger_gates(),
                gates.population_gates(self),
                gates.line_gates(self),
                gates.calendar_gate(self),
            ]
        )

    def report_before_result(self) -> DataFrame:
        """The same without those on the dense result, for sources that are not fit to give one."""
        return self._report(self.gates_before_result(), gates.not_evaluated(self.params) | set(gates.ON_RESULT))

    def _report(self, report: DataFrame, silent: set[str]) -> DataFrame:
        names = self.spark.createDataFrame([(g, g not in silent) for g in gates.GATES], "gate string, evaluated boolean")
        counted = report.groupBy("gate").agg(F.sum("violations").alias("violations"))
        return names.join(counted, "gate", "left").select(
            "gate", "evaluated", F.when(F.col("evaluated"), F.coalesce("violations", F.lit(0))).alias("violations")
        )

    def check_sources(self) -> None:
        gates.stop_on(self.source_gates())

    def check_ledgers(self) -> None:
        gates.stop_on(self.ledger_gates())

    def check_population(self) -> None:
        gates.stop_on(gates.population_gates(self))

    def check_lines(self) -> None:
        gates.stop_on(gates.union_all([gates.line_gates(self), gates.calendar_gate(self)]))

    def check_result(self) -> None:
        gates.stop_on(gates.result_gates(self))

    def warnings(self) -> list[tuple[str, int]]:
        """Findings that do not stop a run, with their counts over all sites."""
        found = [(w, 1) for w in self.sources.warnings]
        if not self.params.gated:
            found.append(("CUTOFF_NOT_DECLARED", 1))
        if self.params.test_mode_max_barcodes is not None:
            found.append(("SAMPLE_MODE_ON", self.params.test_mode_max_barcodes))
        # The codes of these warnings.
        counted = {
            "PosOnlyRuleDroppedStockedProductCount": "POS_ONLY_POPULATION_DROPPED_STOCKED_SKU",
            "BarcodeSharedByMultipleProductCode": "BARCODE_SHARED_BY_MULTIPLE_PRODUCTCODE",
            "PriceConflictSkuDayCount": "PRICE_SOURCE_AGGREGATION_BLOCKED",
        }
        totals = self.site_metadata.agg(*[F.sum(c).alias(c) for c in counted]).first()
        found += [(code, totals[column]) for column, code in counted.items() if totals[column]]
        mapping = ("DiscountMappingMissing", "DiscountPromotionMissing", "DiscountTypeNotEligible")
        lost = promo.discount_audit(self.discount_resolution).agg(*[F.sum(c).alias(c) for c in mapping]).first()
        found += [(c, lost[c] or 0) for c in mapping]  # reported at zero too
        return found


@dataclass(frozen=True)
class ExportResult:
    daily: DataFrame
    metadata: DataFrame
    run: DailyExport
    staging: Staging
    warnings: list[tuple[str, int]] = field(default_factory=list)

    def cleanup(self) -> None:
        self.staging.cleanup()


def prepare_export(spark: SparkSession, sources: Sources, params: ExportParams) -> ExportResult:
    """Stage the ledgers and the population and pass every gate that precedes the result. Nothing stays on failure."""
    staging = Staging(spark)
    try:
        run = DailyExport(spark, sources, params, staging)
        run.check_parameters()
        run.check_sources()
        run.check_ledgers()
        run.check_population()
        run.check_lines()
        warnings = run.warnings()
        LOG.info("expanding to %s rows in %s partitions; warnings: %s", run.projection["rows"], run.partitions, warnings)
        if not params.gated:
            LOG.warning("no cutoff is declared: %s rows include products that may be inactive", run.projection["rows"])
        return ExportResult(run.daily, run.metadata, run, staging, warnings)
    except BaseException:
        staging.cleanup()
        raise


def run_export(spark: SparkSession, sources: Sources, params: ExportParams) -> ExportResult:
    """Result frames, released only after the invariants hold over the whole population.

    The frames read the staged ledgers; ``cleanup()`` removes those once the result is used.
    """
    result = prepare_export(spark, sources, params)
    try:
        result.run.check_result()
    except BaseException:
        result.cleanup()
        raise
    return result


def write_export(spark: SparkSession, sources: Sources, params: ExportParams, path: str) -> list[tuple[str, int]]:
    """Publish the daily result and its metadata at a place, or nothing; ``read_export`` reads them.

    Both are written to a folder of the run, which readers of the place pass over by its name. Every invariant is checked
    per store on the rows that were written; only then does one small file name the folder. A run that fails leaves neither
    its folder nor its staged tables.
    """
    path = path.rstrip("/")
    if is_published(spark, path):
        raise FileExistsError(f"{path} has an export")
    result = prepare_export(spark, sources, params)
    folder = f"_run-{uuid.uuid4().hex}"
    done = False
    try:
        result.daily.write.parquet(f"{path}/{folder}/daily")
        gates.stop_on(gates.written_gates(result.run, spark.read.parquet(f"{path}/{folder}/daily")))
        result.metadata.write.parquet(f"{path}/{folder}/metadata")
        publish(spark, path, folder, [row.location_code for row in result.run.identity.select("location_code").collect()])
        done = True
    finally:
        if not done:
            remove(spark, f"{path}/{folder}")
        result.cleanup()
    return result.warnings
