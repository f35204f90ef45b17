from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from shelfledger import ExportParams, catalog_tables, combine_sites, load_sources
from shelfledger.functions.expressions import in_window, round_to_second
from shelfledger.operators import catalog, ledgers
from shelfledger.plans.daily_export import prepare_export
from shelfledger.sources.staging import Staging
from tests.store import LAST, minimal_store
from tests.test_export import build

RUN = ExportParams(run_date=date(2024, 3, 10))


def groups(spark, *pairs):
    rows = [(0, str(c), None if p is None else str(p), f"G{c}", f"group {c}") for c, p in pairs]
    return spark.createDataFrame(rows, "site int, group_code string, parent_code string, group_id string, group_name string")


def path(spark, code, *pairs):
    row = catalog.group_path(groups(spark, *pairs)).where(f"assigned_group = '{code}'").first()
    return [row[f"group_id{s}"] for s in ("", "2", "3", "4", "5")]


def test_group_paths(spark):
    deep = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6)]
    assert path(spark, 3, *deep) == ["G1", "G2", "G3", None, None]
    assert path(spark, 7, *deep) == ["G3", "G4", "G5", "G6", "G7"]  # four hops up, then cut
    assert path(spark, 1, (1, 2), (2, 1)) == ["G2", "G1", None, None, None]
    assert path(spark, 1, (1, 1)) == ["G1", None, None, None, None]
    assert path(spark, 2, (2, 9)) == ["G2", None, None, None, None]


def test_round_to_second(spark):
    values = [datetime(2024, 2, 10, 8, 30, 0, 499_999), datetime(2024, 2, 10, 8, 30, 0, 500_000), datetime(2024, 12, 31, 23, 59, 59, 700_000)]
    # Inside a daylight-saving gap of the session zone.
    values.append(datetime(2024, 3, 10, 2, 30, 0, 600_000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ts timestamp_ntz")
    got = [r[0] for r in df.orderBy("i").select(round_to_second(F.col("ts"))).collect()]
    assert got == [datetime(2024, 2, 10, 8, 30), datetime(2024, 2, 10, 8, 30, 1), datetime(2025, 1, 1), datetime(2024, 3, 10, 2, 30, 1)]


def test_window_filter_reaches_the_scan(spark, tmp_path):
    spark.range(3).select(F.lit("2024-02-10").cast("timestamp_ntz").alias("ts")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").where(in_window(F.col("ts"), date(2024, 1, 1), LAST))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert df.count() == 3


def test_many_sites_equal_independent_runs(spark):
    first, second = build(), minimal_store(date(2023, 6, 30), code=8, name="Harbour")
    second.line(second.product(10, "other"), date(2023, 6, 1), 3, 9)
    singles = [prepare_export(spark, s.sources(spark), RUN) for s in (first, second)]
    both = prepare_export(spark, combine_sites([first.sources(spark, 1), second.sources(spark, 2)]), RUN)
    expected = singles[0].daily.unionAll(singles[1].daily)
    assert both.daily.exceptAll(expected).isEmpty() and expected.exceptAll(both.daily).isEmpty()
    meta = {r["site"]: r for r in both.run.site_metadata.collect()}
    for site, single in ((1, singles[0]), (2, singles[1])):
        assert meta[site][1:] == single.metadata.first()
    both.run.check_result()

    def shared_tables(table):
        frames = [s.reader(spark)(table).withColumn("branch", F.lit(i)) for i, s in ((1, first), (2, second))]
        return frames[0].unionByName(frames[1])

    lake = prepare_export(spark, load_sources(spark, shared_tables, site_column="branch"), RUN)
    assert lake.daily.exceptAll(expected).isEmpty() and lake.daily.count() == expected.count()


def test_hot_header_is_split(spark):
    """A third of all lines on one header code, and another third on none."""
    n = 60_000
    lines = spark.range(n).select(
        F.lit(0).alias("site"),
        (F.col("id") % 50).cast("int").alias("product"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).cast("bigint").alias("pos_master"),
        F.lit(1).cast("decimal(38,6)").alias("qty"),
        F.lit(2).cast("decimal(38,6)").alias("amount"),
        F.lit(None).cast("bigint").alias("re_pos_details"),
        F.lit(None).cast("int").alias("discount"),
    ).repartition(16)
    masters = spark.range(n).select(
        F.lit(0).alias("site"), F.col("id").alias("code"), F.lit("2024-02-10").cast("timestamp_ntz").alias("transaction_ts")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        ledger = ledgers.pos_ledger(lines, masters)
        totals = {r["business_date"]: r["n"] for r in ledger.groupBy("business_date").agg(F.sum("line_count").alias("n")).collect()}
        assert totals == {date(2024, 2, 10): n * 2 // 3, None: n // 3}
        ledger.collect()
        assert "skew=true" in ledger._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_product_reaches_the_shuffle_as_few_rows(spark):
    """The ledger sums lines before its shuffle."""
    plan = ledgers.pos_ledger(
        build().sources(spark).pos_detail, build().sources(spark).pos_master
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_dense_grid_moves_no_row(spark):
    """Nothing shuffles, sorts or joins by shuffle after the runs are expanded."""
    run = prepare_export(spark, minimal_store().sources(spark), RUN).run
    plan = run.daily._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Window")]
    assert "Generate" in above and "Exchange rangepartitioning" not in above and "SortMergeJoin" not in above
    assert "Sort [" not in above


def test_partitions_follow_the_projection(spark):
    params = ExportParams(run_date=RUN.run_date, rows_per_partition=100)
    run = prepare_export(spark, minimal_store().sources(spark), params).run
    assert run.projection == {"sites": 1, "rows": 1827, "days": 1827}
    slots = spark.sparkContext.defaultParallelism
    assert run.partitions == -(-19 // slots) * slots  # 19 are needed; the last wave is filled
    assert run.daily.count() == 1827


def test_staging_uses_the_configured_folder_and_cleans_up(spark, tmp_path):
    staging = Staging(spark)
    assert staging.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    df = staging.write("numbers", spark.range(3))
    assert df.count() == 3
    staging.cleanup()
    assert not Path(staging.path).exists()


def test_tables_stored_by_header_key_join_without_a_shuffle(spark, tmp_path):
    store = build()
    read = store.reader(spark)
    spark.sql("create database if not exists erp")
    keys = {"tbl_SALPoSDetails": "PoSMaster", "tbl_SALPoSMaster": "Code"}
    for table in store.schemas:
        writer = read(table).write.mode("overwrite").option("path", f"{tmp_path}/{table}")
        if table in keys:
            writer = writer.bucketBy(4, keys[table])
        writer.saveAsTable(f"erp.{table}")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sources = load_sources(spark, catalog_tables(spark, "erp"))
        ledger = ledgers.pos_ledger(sources.pos_detail, sources.pos_master)
        plan = ledger._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # the grouping's own
        straight = store.sources(spark)
        assert ledger.exceptAll(ledgers.pos_ledger(straight.pos_detail, straight.pos_master)).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("drop database erp cascade")
