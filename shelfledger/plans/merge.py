"""Union of independent store exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfledger.schemas import DAILY_COLUMNS
from shelfledger.violations import GateError, Violation

CANONICAL_KEY = ("ProductCode", "Barcode", "LocationCode", "Date")


def merge_stores(exports: list[DataFrame], check_keys: bool = True) -> DataFrame:
    """Stack exports of different stores. A key that two exports both carry stops the merge.

    An export is unique in itself, so only a location found in two exports can repeat a key; rows of other locations are
    not compared.
    """
    merged = reduce(lambda a, b: a.unionByName(b), [e.select(*DAILY_COLUMNS) for e in exports])
    if check_keys and len(exports) > 1:
        locations = reduce(
            lambda a, b: a.unionByName(b), [e.select("LocationCode").distinct() for e in exports]
        )
        shared = locations.groupBy("LocationCode").count().where("count > 1").select("LocationCode")
        repeated = (
            merged.join(shared, "LocationCode", "left_semi").groupBy(*CANONICAL_KEY).agg(F.count(F.lit(1)).alias("n"))
        ).where("n > 1")
        count = repeated.count()
        if count:
            raise GateError([Violation("I-5", "stores share canonical keys", count)])
    return merged
