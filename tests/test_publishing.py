"""A failed run leaves nothing behind; what a store's name, its configuration and its headers can break."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfledger import (
    ExportParams,
    GateError,
    combine_sites,
    load_sources,
    merge_published,
    parquet_tables,
    read_export,
    run_export,
    write_export,
)
from shelfledger.operators import population
from shelfledger.plans import daily_export, gates
from shelfledger.plans.daily_export import DailyExport, prepare_export
from shelfledger.schemas import DAILY_COLUMNS
from shelfledger.sources.staging import staging_root
from tests.store import LAST, minimal_store

RUN = ExportParams(run_date=date(2024, 3, 10))


def staged(spark) -> set[str]:
    root = staging_root(spark).removeprefix("file:")
    return {name for name in os.listdir(root) if name.startswith("shelfledger-")} if os.path.isdir(root) else set()


def codes(error) -> list[str]:
    return [v.gate for v in error.value.violations]


def changed(column: str, value):
    """The daily result with one column of its last sale day replaced."""

    def spoil(df):
        return df.withColumn(column, F.when(F.col("Date") == F.lit(LAST), F.lit(value)).otherwise(F.col(column)).cast(df.schema[column].dataType))

    return spoil


@pytest.mark.parametrize(
    ("spoil", "gate"),
    [
        (changed("SalesQty", 7), "I-2"),
        (changed("SalesQty", None), "I-1"),
        (changed("PromoSalesQty", 5), "I-2b"),
        (lambda df: df.where(F.col("Date") != F.lit(LAST)), "I-4"),
        (lambda df: df.withColumn("IsPromo", F.lit(True)), "I-3"),
        (changed("Barcode", "H1"), "I-6"),
    ],
)
def test_failed_write_leaves_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch, spoil, gate):
    before, sound = staged(spark), daily_export.DailyExport.daily
    monkeypatch.setattr(DailyExport, "daily", property(lambda run: spoil(sound.func(run))))
    with pytest.raises(GateError) as error:
        write_export(spark, minimal_store().sources(spark), RUN, str(tmp_path))
    assert gate in codes(error)
    assert os.listdir(tmp_path) == [] and staged(spark) == before
    monkeypatch.undo()
    write_export(spark, minimal_store().sources(spark), RUN, str(tmp_path))
    assert staged(spark) == before and read_export(spark, str(tmp_path)).daily.count() == 1827


def test_failed_gates_leave_no_staged_table(spark):
    before, store = staged(spark), minimal_store()
    store.rows["tbl_LSProduct"].append(store.rows["tbl_LSProduct"][0])
    with pytest.raises(GateError):
        prepare_export(spark, store.sources(spark), RUN)
    assert staged(spark) == before


def test_nothing_is_overwritten(spark, tmp_path):
    write_export(spark, minimal_store().sources(spark), RUN, str(tmp_path))
    before = sorted(os.listdir(tmp_path))
    with pytest.raises(FileExistsError):
        write_export(spark, minimal_store().sources(spark), RUN, str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == before


@pytest.mark.parametrize("step", ["metadata", "publish"])
def test_a_failure_after_the_rows_are_written_leaves_nothing_readable(spark, tmp_path, monkeypatch, step):
    def fail(*_):
        raise OSError("the store is gone")

    before = staged(spark)
    if step == "publish":
        monkeypatch.setattr(daily_export, "publish", fail)
    else:
        monkeypatch.setattr(gates, "written_gates", lambda *_: fail())
    with pytest.raises(OSError):
        write_export(spark, minimal_store().sources(spark), RUN, str(tmp_path))
    assert os.listdir(tmp_path) == [] and staged(spark) == before
    with pytest.raises(FileNotFoundError):
        read_export(spark, str(tmp_path))


def test_a_run_that_comes_second_leaves_the_first_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(daily_export, "is_published", lambda *_: False)
    write_export(spark, minimal_store().sources(spark), RUN, str(tmp_path))
    first = read_export(spark, str(tmp_path))
    with pytest.raises(Exception):  # the file is there
        write_export(spark, minimal_store(code=8, name="Harbour").sources(spark), RUN, str(tmp_path))
    again = read_export(spark, str(tmp_path))
    assert again.locations == first.locations == ("Main street",) and again.daily.count() == 1827


def test_published_stores_merge_by_their_manifests(spark, tmp_path):
    for name, store in (("a", minimal_store()), ("b", minimal_store(code=8, name="Harbour")), ("c", minimal_store())):
        write_export(spark, store.sources(spark), RUN, f"{tmp_path}/{name}")
    merged = merge_published(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert merged.columns == list(DAILY_COLUMNS) and merged.groupBy("LocationName").count().count() == 2
    assert merged.count() == 2 * 1827
    with pytest.raises(GateError) as error:
        merge_published(spark, [f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/c"])
    assert codes(error) == ["I-5"]
    os.remove(f"{tmp_path}/b/.published.json.crc")
    with open(f"{tmp_path}/b/published.json", "w") as file:
        file.write('{"daily": ')  # as another reader may see it while it is written
    with pytest.raises(FileNotFoundError):
        read_export(spark, f"{tmp_path}/b")


def test_empty_configuration(spark):
    store = minimal_store()
    store.rows["tbl_SYSConfiguration"].clear()
    with pytest.raises(GateError) as error:
        run_export(spark, store.sources(spark), RUN)
    assert codes(error) == ["G5"]


@pytest.mark.parametrize("quantity", [1, 4])
def test_two_stores_of_one_name(spark, tmp_path, quantity):
    other = minimal_store()
    other.line(1, LAST, quantity, 10)
    sources = combine_sites([minimal_store().sources(spark, 1), other.sources(spark, 2)])
    for run in (lambda: run_export(spark, sources, RUN), lambda: write_export(spark, sources, RUN, str(tmp_path))):
        with pytest.raises(GateError) as error:
            run()
        assert codes(error) == ["I-5"]
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize(("table", "gate"), [("tbl_SALPoSMaster", "K4a"), ("tbl_OPSImExMaster", "K4b")])
def test_repeated_header_stops_a_default_run(spark, table, gate):
    store = minimal_store()
    store.document(1, LAST, 1, 3, 5)
    store.rows[table].append(store.rows[table][0])
    with pytest.raises(GateError) as error:
        run_export(spark, store.sources(spark), RUN)
    assert codes(error) == [gate]


def test_one_plan_without_broadcasts(spark):
    """With no broadcast at all, nothing moves or sorts rows above the window that orders the result."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = prepare_export(spark, minimal_store().sources(spark), RUN)
        plan = result.daily._jdf.queryExecution().sparkPlan().toString()
        top = plan[: plan.index("Window")]
        assert "Join" not in top and "Exchange" not in top and "Sort" not in top
        rows = [(r.ProductCode, r.Date) for r in result.daily.collect()]
        assert rows == sorted(rows)
        result.cleanup()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_sample_is_ranked_in_parts(spark):
    products = spark.range(20_000).select(F.lit(0).alias("site"), F.col("id").cast("int").alias("product"), F.concat(F.lit("b"), F.col("id") % 15_000).alias("barcode"))
    kept = population.sample_barcodes(products, 5000)
    assert kept.select("barcode").distinct().count() == 5000
    assert "hashpartitioning(part#" in kept._jdf.queryExecution().executedPlan().toString()
    plain = products.select("barcode").distinct().orderBy(F.xxhash64("barcode"), "barcode").limit(5000)
    assert kept.join(plain, "barcode", "left_anti").isEmpty()
    assert kept.count() == products.join(plain, "barcode", "left_semi").count()


def test_window_of_lines_reaches_the_scan(spark, tmp_path):
    store = minimal_store()
    read = store.reader(spark)
    for table in store.schemas:
        read(table).write.parquet(f"{tmp_path}/{table}")
    run = DailyExport(spark, load_sources(spark, parquet_tables(spark, str(tmp_path))), RUN)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = run.pos_lines._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(TransactionDate,2019-03-01T00:00" in plan
    assert "LessThan(TransactionDate,2024-03-01T00:00" in plan


def test_report_tells_silent_gates_from_sound_ones(spark):
    report = {r.gate: r for r in prepare_export(spark, minimal_store().sources(spark), RUN).run.gate_report().collect()}
    assert set(report) == set(gates.GATES)
    assert report["G1"].violations is None and not report["G19"].evaluated
    assert report["G22"].violations == report["K4a"].violations == report["K4b"].violations == 0
    assert report["G12"].violations == 0 and report["I-8"].evaluated

