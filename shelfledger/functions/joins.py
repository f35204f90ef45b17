"""How joins are planned where Spark's guess of sizes would mislead it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sorted_side(rows: DataFrame) -> DataFrame:
    """A side of a join with a row for each product or group: it is dealt and sorted, and never gathered at the driver to be broadcast.

    Spark guesses its size from compressed files and the share of their columns that is read. A few columns of millions of
    products pass for less than 10 MB, but take the driver hundreds.
    """
    return rows.hint("merge")
