"""The eleven ERP tables expressed over a sales star schema (orders, lines, parts, suppliers, nations, regions).

Gives the operators real files to run on. Every source row is used: what a product or document is follows from column
values, never from leaving rows out. Part sizes stand for the special kinds of product below.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfledger.functions.joins import sorted_side
from shelfledger.sources.readers import TableReader

# The files' own column types; declaring them spares a look at every file's footer before planning.
STAR_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}

#: Parts that lines may meet in a broadcast; the driver holds about 64 bytes of each, more than once.
BROADCAST_PARTS = 1_500_000

# Part sizes that stand for special kinds of product.
NEVER_SOLD = 13  # stocked, but its lines never reach POS
DISCONTINUED = 17  # only zero quantities, no stock
NOT_IN_CATALOG = 23
BUNDLE_BARCODE = 29  # 'H' barcode; also carries lines without a header and without a quantity
BLANK_BARCODE = 31
NULL_BARCODE = 37
SHARED_BARCODE = (41, 43)  # one barcode for all such parts of a brand
# Part sizes of retail products that carry faults where faults are asked for.
UNKNOWN_QUANTITY = 3
WITHOUT_POS_HEADER = 7
WITHOUT_IMEX_HEADER = 11
TEXT_FOR_QUANTITY = 19


def star_schema_tables(spark: SparkSession, path: str, faulty: bool = False) -> TableReader:
    """The tables. ``faulty`` ones break gates: retail products have lines without a header or a quantity or with a text in
    its place, some headers and all promotions repeat, and a discount code stands for two promotions."""

    def if_faulty(size: int) -> list[int]:
        return [size] if faulty else []

    def with_repeats(headers: DataFrame, remainder: int) -> DataFrame:
        return headers.unionByName(headers.where(F.col("Code") % 64 == remainder)) if faulty else headers

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.schema(STAR_SCHEMA[name]).parquet(f"{path}/{name}.parquet")

    @cache
    def parts() -> DataFrame:
        found = table("part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
        return sorted_side(found) if table("part").count() > BROADCAST_PARTS else found

    def lines() -> DataFrame:
        return table("lineitem").join(parts(), "l_partkey", "left")

    size = F.col("p_size")

    def pos_details() -> DataFrame:
        bundle = size == BUNDLE_BARCODE
        percent = F.round(F.col("l_discount") * 100).cast("int")
        return lines().select(
            F.when(size == NEVER_SOLD, None).otherwise(F.col("l_partkey")).alias("Product"),
            F.when(size.isin(BUNDLE_BARCODE, *if_faulty(WITHOUT_POS_HEADER)) & (F.col("l_linenumber") == 7), None)
            .when(bundle & (F.col("l_linenumber") == 6), -1)
            .otherwise(F.col("l_orderkey"))
            .alias("PoSMaster"),
            F.when(size == DISCONTINUED, 0.0)
            .when(size.isin(BUNDLE_BARCODE, *if_faulty(UNKNOWN_QUANTITY)) & (F.col("l_linenumber") == 1), None)
            .otherwise(F.col("l_quantity"))
            .alias("Qty"),
            F.col("l_extendedprice").alias("Amount"),
            F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("RePosDetails"),
            F.when(percent > 5, percent).alias("Discount"),
        )

    def pos_masters() -> DataFrame:
        headers = table("orders").select(
            F.col("o_orderkey").alias("Code"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("o_custkey").cast("int") % 1440)).alias(
                "TransactionDate"
            ),
        )
        return with_repeats(headers, 1)

    def imex_details() -> DataFrame:
        unknown = (F.col("l_tax") == 0.08) & (F.col("l_quantity") == 13)
        received = F.when(unknown, None).otherwise(F.col("l_quantity") * 3)
        if faulty:
            text = (size == TEXT_FOR_QUANTITY) & (F.col("l_linenumber") == 5)
            received = F.when(text, "n/a").otherwise(received.cast("string"))
        return lines().select(
            F.when(size == DISCONTINUED, None).otherwise(F.col("l_partkey")).alias("Product"),
            F.when(size.isin(BUNDLE_BARCODE, *if_faulty(WITHOUT_IMEX_HEADER)) & (F.col("l_linenumber") == 7), None)
            .otherwise(F.col("l_orderkey"))
            .alias("DocumentNo"),
            (F.col("l_quantity") + 1).alias("Quantity"),
            received.alias("QtyReceived"),
        )

    def imex_masters() -> DataFrame:
        priority, state = F.col("o_orderpriority"), F.col("o_orderstatus")
        kind = (
            F.when(priority == "1-URGENT", 1)
            .when(priority == "2-HIGH", 21)
            .when(priority == "4-NOT SPECIFIED", 2)
            .when(priority == "5-LOW", 10)
            .otherwise(F.when(state == "P", 99).otherwise(5))
        )
        inbound = kind.isin(1, 2, 21)
        open_status = F.when(inbound, 2).otherwise(5)
        done_status = F.when(inbound, 3).otherwise(6)
        customer = F.col("o_custkey").cast("int")
        eff = F.col("o_orderdate") + F.make_dt_interval(customer % 30)
        headers = table("orders").select(
            F.col("o_orderkey").alias("Code"),
            eff.alias("EffDate"),
            kind.alias("DocumentType"),
            F.when(state == "O", open_status).otherwise(done_status).alias("DocumentStatus"),
            F.when(customer % 31 == 0, None)
            .when(customer % 37 == 0, eff + F.expr("interval 1 day"))
            .when(customer % 41 == 0, eff + F.expr("interval '23:59:59.7' hour to second"))
            .otherwise(eff + F.make_dt_interval(F.lit(0), customer % 24))
            .alias("ReceiptDate"),
        )
        return with_repeats(headers, 2)

    def products() -> DataFrame:
        key = F.col("p_partkey").cast("string")
        brand = F.regexp_extract("p_brand", "([0-9]+)", 1)
        barcode = (
            F.when(size == BUNDLE_BARCODE, F.concat(F.lit("H"), key))
            .when(size == BLANK_BARCODE, F.lit("  "))
            .when(size == NULL_BARCODE, None)
            .when(size.isin(*SHARED_BARCODE), F.concat(F.lit("B"), brand))
            .otherwise(F.concat(F.lit("893"), key))
        )
        return table("part").select(
            F.when(size == NOT_IN_CATALOG, None).otherwise(F.col("p_partkey")).alias("Code"),
            (1000 + 4 * size).alias("GroupID"),
            barcode.alias("Barcode"),
            F.col("p_name").alias("VName"),
            brand.alias("Brand"),
            size.alias("Quantitative"),
            F.col("p_type").alias("PackingSize"),
        )

    def groups() -> DataFrame:
        def level(df: DataFrame, code, parent, name: str) -> DataFrame:
            return df.select(
                code.cast("bigint").alias("Code"),
                parent.cast("bigint").alias("ParentID"),
                F.concat(F.lit("G"), code.cast("string")).alias("GroupID"),
                F.col(name).alias("GroupName"),
            )

        top = level(table("region"), F.col("r_regionkey") + 1, F.lit(None), "r_name")
        middle = level(table("nation"), F.col("n_nationkey") + 100, F.col("n_regionkey") + 1, "n_name")
        low = level(table("supplier"), F.col("s_suppkey") + 1000, F.col("s_nationkey") + 100, "s_name")
        return top.unionByName(middle).unionByName(low)

    def brands() -> DataFrame:
        number = F.regexp_extract("p_brand", "([0-9]+)", 1)
        return table("part").select(
            F.when(F.col("p_brand") != "Brand#25", number).alias("Code"), F.col("p_brand").alias("Name")
        )

    def bundles() -> DataFrame:
        code, promotion = F.col("n_nationkey"), F.col("n_regionkey") + 1
        found = table("nation").select(F.when(code != 10, code).alias("Code"), promotion.alias("Promotion"))
        second = found.where("Code = 7").select("Code", (F.col("Promotion") % 5 + 1).alias("Promotion"))
        return found.unionByName(second) if faulty else found

    def promotions() -> DataFrame:
        region = F.col("r_regionkey")
        found = table("region").select(
            F.when(region != 4, region + 1).alias("Code"),
            F.when(region == 2, F.lit("1997-01-01")).otherwise(F.lit("1995-01-01")).cast("date").alias("StartDate"),
            F.when(region == 2, F.lit("1999-12-31")).otherwise(F.lit("2001-12-31")).cast("date").alias("EndDate"),
            F.when(region == 1, 2).when(region == 2, 7).when(region == 3, 1).alias("Type"),
        )
        return found.unionByName(found) if faulty else found

    tables = {
        "tbl_SYSConfiguration": lambda: table("region").select(
            F.when(F.col("r_regionkey") == 0, 1).alias("Store")
        ),
        "tbl_LSStore": lambda: table("nation").select(F.col("n_nationkey").alias("Code"), F.col("n_name").alias("Store")),
        "tbl_LSProduct": products,
        "tbl_LSGroup": groups,
        "tbl_LSBrand": brands,
        "tbl_SALPoSDetails": pos_details,
        "tbl_SALPoSMaster": pos_masters,
        "tbl_OPSImExDetails": imex_details,
        "tbl_OPSImExMaster": imex_masters,
        "tbl_POLBundle": bundles,
        "tbl_POLPromotion": promotions,
    }
    return lambda name: tables[name]() if name in tables else None
