"""Each gate stops the run with its code."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfledger import ExportParams, GateError, load_sources, merge_stores
from shelfledger.plans import gates
from shelfledger.plans.daily_export import DailyExport, prepare_export
from tests.store import LAST, minimal_store

RUN = ExportParams(run_date=date(2024, 3, 10))


def stopped(spark, store, params=RUN) -> list[str]:
    with pytest.raises(GateError) as error:
        prepare_export(spark, store.sources(spark), params)
    assert error.value.violations == sorted(error.value.violations, key=lambda v: list(gates.GATES).index(v.gate))
    return [v.gate for v in error.value.violations]


@pytest.fixture(scope="module")
def sound(spark):
    return prepare_export(spark, minimal_store().sources(spark), RUN).run


@pytest.mark.parametrize(
    ("changes", "gate"),
    [
        ({"test_mode_max_barcodes": 0}, "G1"),
        ({"inactivity_window_months": 0}, "G2"),
        ({"sales_data_cutoff_date": date(2024, 3, 11)}, "G2b"),
    ],
)
def test_parameters(changes, gate):
    assert [g for g, _ in ExportParams(run_date=RUN.run_date, **changes).problems()] == [gate]


@pytest.mark.parametrize(
    ("table", "gate"),
    [
        ("tbl_SYSConfiguration", "G3"),
        ("tbl_LSStore", "G4"),
        ("tbl_LSProduct", "G7"),
        ("tbl_LSGroup", "G8"),
        ("tbl_SALPoSDetails", "G9"),
        ("tbl_SALPoSMaster", "G10"),
        ("tbl_OPSImExMaster", "S5"),
    ],
)
def test_missing_table(spark, table, gate):
    store = minimal_store()
    del store.schemas[table]
    with pytest.raises(GateError) as error:
        store.sources(spark)
    assert [v.gate for v in error.value.violations] == [gate]


def test_missing_column_and_decimal_discount(spark):
    read = minimal_store().reader(spark)

    def changed(table):
        df = read(table)
        if table == "tbl_LSGroup":
            df = df.drop("ParentID")
        if table == "tbl_SALPoSDetails":
            df = df.withColumn("Discount", F.col("Discount").cast("decimal(18,2)"))
        return df

    with pytest.raises(GateError) as error:
        load_sources(spark, changed)
    assert [v.gate for v in error.value.violations] == ["G8", "G23"]


def test_brand_column_is_found_or_left_blank(spark):
    store = minimal_store()
    for name in ("BrandName", "Brand", "VName", "Name"):
        store.schemas["tbl_LSBrand"] = f"Code int, {name} string"
        assert store.sources(spark).warnings == ()
    store.schemas["tbl_LSBrand"] = "Code int, Title string"
    assert store.sources(spark).warnings == ("BRAND_NAME_COLUMN_MISSING",)
    del store.schemas["tbl_LSBrand"]
    sources = store.sources(spark)
    assert sources.warnings == ("BRAND_TABLE_MISSING",) and sources.brand.isEmpty()


def test_store_identity(spark):
    store = minimal_store()
    store.rows["tbl_SYSConfiguration"].append((8,))
    assert stopped(spark, store)[0] == "G5"
    store = minimal_store()
    store.rows["tbl_LSStore"] = [(9, "Elsewhere")]
    assert stopped(spark, store) == ["G6"]
    store = minimal_store()
    store.rows["tbl_LSStore"].append((7, "Second name"))
    assert stopped(spark, store) == ["K3"]


def test_duplicate_product_code(spark):
    store = minimal_store()
    store.product(1, "other")
    assert stopped(spark, store) == ["K1"]


def test_duplicate_headers_on_request(spark):
    store = minimal_store()
    store.rows["tbl_SALPoSMaster"] *= 2
    params = ExportParams(run_date=RUN.run_date, reconcile_scans=True)
    assert stopped(spark, store, params) == ["K4a"]


def test_no_candidate(spark):
    store = minimal_store()
    store.rows["tbl_LSProduct"] = []
    assert stopped(spark, store)[0] == "G11"


def test_orphans_of_candidates(spark):
    store = minimal_store()
    store.line(1, LAST, 1, header=False)
    assert stopped(spark, store) == ["G12"]
    store = minimal_store()
    store.line(1, None, 1)
    assert stopped(spark, store) == ["G12"]
    store = minimal_store()
    store.document(1, LAST, 1, 3, 1, header=False)
    assert stopped(spark, store) == ["G13"]


def test_no_source_date(spark):
    assert "G14" in stopped(spark, minimal_store(date(2025, 1, 1)))


def test_unknown_quantity_in_window(spark):
    store = minimal_store()
    store.line(1, LAST - timedelta(5), None)
    assert stopped(spark, store) == ["G15"]


def test_days_of_unknown_quantity_are_counted_from_their_own_rows(spark, monkeypatch):
    """Two lines of unknown quantity on one day and one on another are two days; rows of known quantity are not grouped for it."""
    store = minimal_store()
    for days, qty in ((5, None), (5, None), (5, 3), (7, None), (9, 2)):
        store.line(1, LAST - timedelta(days), qty)
    run, sound, grouped = DailyExport(spark, store.sources(spark), RUN), gates.ledgers.pos_daily, []

    def spy(ledger):
        grouped.append(ledger)
        return sound(ledger)

    monkeypatch.setattr(gates.ledgers, "pos_daily", spy)
    assert {r.gate: r.violations for r in gates.population_gates(run).collect()} == {"G15": 2}
    assert any({r.has_null_qty for r in ledger.select("has_null_qty").collect()} == {True} for ledger in grouped)


def test_cutoff_position(spark):
    late = ExportParams(run_date=RUN.run_date, sales_data_cutoff_date=date(2024, 3, 1))
    assert "G16" in stopped(spark, minimal_store(), late)
    long = ExportParams(run_date=RUN.run_date, sales_data_cutoff_date=LAST, inactivity_window_months=61)
    assert "G17" in stopped(spark, minimal_store(), long)


def test_everything_inactive(spark):
    store = minimal_store(date(2020, 1, 1))
    store.document(1, date(2020, 1, 1), 3, 3, 1)
    store.document(None, LAST, 3, 3, 1)
    store.document(2, LAST, 3, 3, 1)
    params = ExportParams(run_date=RUN.run_date, sales_data_cutoff_date=LAST)
    assert stopped(spark, store, params) == ["G18"]


def test_ambiguous_discount_only_if_used(spark):
    store = minimal_store()
    store.rows["tbl_POLBundle"] += [(61, 1), (61, 2)]
    prepare_export(spark, store.sources(spark), RUN)
    store.line(1, LAST, 1, 10, discount=61)
    assert stopped(spark, store) == ["G24"]


def test_duplicate_promotion(spark):
    store = minimal_store()
    store.promotion(61, 1, 2, date(2024, 1, 1), LAST)
    store.rows["tbl_POLPromotion"] *= 2
    store.line(1, LAST, 1, 10, discount=61)
    assert stopped(spark, store) == ["K2"]


def test_scan_reconciliation_sees_a_lost_line(sound):
    run = sound
    assert gates.failures(gates.scan_reconciliation(run.ledger_in_scope, run.pos_lines)) == []
    lost = gates.scan_reconciliation(run.ledger_in_scope, run.pos_lines.where("false"))
    assert [v.gate for v in gates.failures(lost)] == ["G22"]


class Tampered:
    """A run whose dense result has been changed."""

    def __init__(self, run, **changes):
        self._run, self._changes = run, changes

    def __getattr__(self, name):
        return self._changes.get(name, getattr(self._run, name))


def test_result_invariants(spark):
    store = minimal_store()
    store.promotion(61, 1, 2, date(2024, 1, 1), LAST)
    store.line(1, LAST - timedelta(3), 2, 20, discount=61)
    run = prepare_export(spark, store.sources(spark), RUN).run
    assert gates.failures(gates.result_gates(run)) == []

    def broken(grid) -> set[str]:
        return {v.gate for v in gates.failures(gates.result_gates(Tampered(run, grid=grid)))}

    grid = run.grid
    closed = ~F.col("has_sales_record")
    one = F.lit(1).cast("decimal(38,6)")
    assert broken(grid.withColumn("sales_qty", F.coalesce("sales_qty", one))) == {"I-1", "I-2", "I-8"}
    assert broken(grid.withColumn("is_promo", closed)) == {"I-3"}
    assert broken(grid.withColumn("promo_qty", F.col("promo_qty") * 2)) == {"I-2b", "I-9"}
    assert broken(grid.where(f"business_date <> '{LAST}'")) == {"I-2", "I-4", "I-8"}
    swapped = F.when(F.col("sales_qty") == 1, 2 * one).when(F.col("sales_qty") == 2, one).otherwise(F.col("sales_qty"))
    assert broken(grid.withColumn("sales_qty", swapped.cast("decimal(38,6)"))) >= {"I-2"}
    no_barcode = F.col("attributes").withField("barcode", F.lit("H9"))
    assert broken(grid.withColumn("attributes", no_barcode)) == {"I-6"}
    runs = run.runs

    def broken_runs(df) -> list[str]:
        return [v.gate for v in gates.failures(gates.run_gates(df))]

    assert broken_runs(runs) == []
    assert broken_runs(runs.withColumn("close_if_clean", F.col("close_if_clean") + F.day("day"))) == ["G26"]
    assert "I-5" in broken_runs(runs.union(runs))
    assert broken_runs(runs.withColumn("run_days", F.col("run_days") + 1)) == ["I-5"]


def test_calendar_gate(sound):
    run = sound
    assert gates.failures(gates.calendar_gate(run)) == []
    short = Tampered(run, calendar=run.calendar.where(f"business_date <> '{LAST}'"))
    assert [v.gate for v in gates.failures(gates.calendar_gate(short))] == ["G25"]


def test_merge_refuses_shared_keys(spark, sound):
    one = sound.daily
    other = prepare_export(spark, minimal_store(code=8, name="Harbour").sources(spark), RUN).daily
    assert merge_stores([one, other]).count() == 2 * one.count()
    with pytest.raises(GateError):
        merge_stores([one, one])


def changed_column(spark, table, column, change):
    read = minimal_store().reader(spark)

    def changed(name):
        df = read(name)
        return df.withColumn(column, change(F.col(column))) if name == table else df

    return changed


@pytest.mark.parametrize(
    ("table", "column", "change"),
    [
        ("tbl_SALPoSDetails", "Qty", lambda c: F.array(c)),
        ("tbl_SALPoSMaster", "TransactionDate", lambda c: F.lit(20240229)),
        ("tbl_POLPromotion", "StartDate", lambda c: F.lit(True)),
        ("tbl_LSProduct", "VName", lambda c: F.struct(c)),
        ("tbl_LSProduct", "Code", lambda c: F.lit(date(2024, 1, 1))),
    ],
)
def test_types_that_cannot_be_read(spark, table, column, change):
    with pytest.raises(GateError) as error:
        load_sources(spark, changed_column(spark, table, column, change))
    assert [v.gate for v in error.value.violations] == ["S5t"] and column in str(error.value)


@pytest.mark.parametrize(
    ("column", "value", "count"),
    [("Qty", "many", 1), ("Qty", "1", 0), ("Amount", "1e40", 1), ("PoSMaster", "1.5", 1), ("PoSMaster", "1", 0), ("Product", "99999999999", 1)],
)
def test_values_that_do_not_fit_are_counted(spark, column, value, count):
    sources = load_sources(spark, changed_column(spark, "tbl_SALPoSDetails", column, lambda c: F.lit(value)))
    found = gates.failures(gates.value_gates(sources.refused))
    assert [(v.gate, v.count) for v in found] == ([("S5v", count)] if count else [])
    if count:
        with pytest.raises(GateError) as error:
            prepare_export(spark, sources, RUN)
        assert [v.gate for v in error.value.violations] == ["S5v"]


def test_sound_types_are_not_read_for_it(spark):
    assert minimal_store().sources(spark).refused is None


def test_empty_sample(spark):
    params = ExportParams(run_date=RUN.run_date, test_mode_max_barcodes=1)
    run = prepare_export(spark, minimal_store().sources(spark), params).run
    assert gates.failures(gates.population_gates(run)) == []
    emptied = Tampered(run, targets=run.targets.where("false"))
    assert [v.gate for v in gates.failures(gates.population_gates(emptied))] == ["G19"]


def test_exported_product_that_never_sold(sound):
    other = sound.targets.withColumn("product", F.lit(99))
    tampered = Tampered(sound, targets=sound.targets.unionByName(other))
    assert [v.gate for v in gates.failures(gates.line_gates(tampered))] == ["I-7"]
