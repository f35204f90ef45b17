"""Where the source tables come from: each reader gives a function from table name to DataFrame, or None if absent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

TableReader = Callable[[str], DataFrame | None]


def parquet_tables(spark: SparkSession, path: str) -> TableReader:
    """One Parquet folder or file per table: ``<path>/<table>`` or ``<path>/<table>.parquet``."""

    def read(table: str) -> DataFrame | None:
        for location in (f"{path}/{table}", f"{path}/{table}.parquet"):
            try:
                return spark.read.parquet(location)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
        return None

    return read


def catalog_tables(spark: SparkSession, database: str) -> TableReader:
    """Tables of a Spark catalog database, such as a lakehouse copy of the ERP."""

    def read(table: str) -> DataFrame | None:
        name = f"{database}.{table}"
        return spark.table(name) if spark.catalog.tableExists(name) else None

    return read


def jdbc_tables(
    spark: SparkSession, options: dict[str, str], splits: dict[str, dict[str, str]] | None = None
) -> TableReader:
    """Tables of the ERP database itself.

    ``splits`` gives per table the JDBC partitioning options (partitionColumn, lowerBound, upperBound, numPartitions),
    without which a table is read by a single task.
    """

    def read(table: str) -> DataFrame | None:
        extra = (splits or {}).get(table, {})
        return spark.read.format("jdbc").options(**options, **extra, dbtable=f"dbo.{table}").load()

    return read
