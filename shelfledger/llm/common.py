"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfledger.sources.staging import Staging, remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stage:
    """Tables that a job writes and reads again, in a folder of its own under ``spark.checkpoint.dir``.

    A written table cuts lineage: a lost executor costs its own tasks and no recomputation of what came before.
    """

    def __init__(self, spark: SparkSession):
        self.staging = Staging(spark)
        self.count = 0
        self.written: dict[int, tuple[DataFrame, str]] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        name = f"{self.count:03d}"
        found = self.staging.write(name, df)
        self.written[id(found)] = found, name
        return found

    def forget(self, df: DataFrame) -> None:
        """Remove a table that this stage wrote, once all that is read from it is written too."""
        _, name = self.written.pop(id(df))
        remove(self.staging.spark, self.folder(name))

    def folder(self, name: str) -> str:
        return f"{self.staging.path}/{name}"


def whole_row(columns: list[str], name: str) -> Column:
    """Columns of a user in one struct, where no name of theirs meets one of an operator's own."""
    fields = [F.col(f"`{column}`") for column in columns] or [F.lit(True).alias("none")]
    return F.struct(*fields).alias(name)


def fields_of(name: str, columns: list[str], prefix: str = "") -> list[Column]:
    """The columns that ``whole_row`` put away."""
    return [F.col(f"{prefix}{name}").getField(column).alias(column) for column in columns]
