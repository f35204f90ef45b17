"""Tables written between the steps of a run.

The ledgers feed several later steps. They are written once, as Parquet under the cluster's checkpoint folder, so that
later steps read columns instead of repeating scans and joins, and a lost executor costs no recomputation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Row groups of clustered tables.
ROW_GROUP_BYTES = 4 << 20


def staging_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a folder in the warehouse, if driver and tasks are one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"


class Staging:
    """One run's folder of staged tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{staging_root(spark).rstrip('/')}/shelfledger-{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def write(self, name: str, df: DataFrame) -> DataFrame:
        location = f"{self.path}/{name}"
        df.write.parquet(location)
        return self.spark.read.schema(df.schema).parquet(location)

    def write_clustered(self, name: str, df: DataFrame, column: str) -> DataFrame:
        """Sorted by a column inside each file, in small row groups: a filter on it reads only those that it concerns."""
        location = f"{self.path}/{name}"
        df.sortWithinPartitions(column).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(location)
        return self.spark.read.schema(df.schema).parquet(location)

    def write_bucketed(self, name: str, df: DataFrame, buckets: int, column: str, order: tuple[str, ...]) -> DataFrame:
        """A table that Spark knows to be dealt by a column: what groups or orders by it needs no shuffle to read it.

        It is listed in the session's current database until ``cleanup``. With
        ``spark.sql.legacy.bucketedTableScan.outputOrdering`` it is not sorted again either: a bucket is one file.
        """
        table = f"staged_{uuid.uuid4().hex}"
        writer = df.write.option("path", f"{self.path}/{name}").bucketBy(buckets, column).sortBy(*order)
        writer.saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def cleanup(self) -> None:
        """Remove this run's folder and tables, once its results are written elsewhere."""
        for table in self.tables:
            self.spark.sql(f"drop table if exists {table}")
        remove(self.spark, self.path)


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, files = _located(spark, path)
    return files.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    location, files = _located(spark, path)
    files.delete(location, True)


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one piece; fails if the path is taken. Object stores show it once it is closed."""
    location, files = _located(spark, path)
    stream = files.create(location, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return "".join(row[0] for row in spark.read.text(path, wholetext=True).collect())


class WithoutStaging:
    """Keeps every step lazy, as part of the plan that uses it."""

    def write(self, name: str, df: DataFrame) -> DataFrame:
        return df

    def write_clustered(self, name: str, df: DataFrame, column: str) -> DataFrame:
        return df

    def write_bucketed(self, name: str, df: DataFrame, buckets: int, column: str, order: tuple[str, ...]) -> DataFrame:
        return df
