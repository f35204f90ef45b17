"""Published exports: one small file, written last, names the tables of a finished run.

Tables are written once, to a folder of the run that readers of the place pass over by its name. Nothing is moved, so the
same holds on object stores, where a move is a copy: an export is there as soon as its manifest is, and not before.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shelfledger.schemas import DAILY_COLUMNS
from shelfledger.sources.staging import exists, read_text, write_new_text
from shelfledger.violations import GateError, Violation

MANIFEST = "published.json"


@dataclass(frozen=True)
class PublishedExport:
    daily: DataFrame
    metadata: DataFrame
    locations: tuple[str, ...]


def is_published(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MANIFEST}")


def publish(spark: SparkSession, path: str, run: str, locations: list[str]) -> None:
    """Name the tables in the folder ``run`` of a place as its export. Fails if another run was there first."""
    content = {"daily": f"{run}/daily", "metadata": f"{run}/metadata", "locations": sorted(locations)}
    write_new_text(spark, f"{path}/{MANIFEST}", json.dumps(content))


def _manifest(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(read_text(spark, f"{path.rstrip('/')}/{MANIFEST}"))
    except json.JSONDecodeError as error:
        raise FileNotFoundError(f"{path} is not published yet") from error


def read_export(spark: SparkSession, path: str) -> PublishedExport:
    """The export that is published at a place."""
    content = _manifest(spark, path)
    tables = [spark.read.parquet(f"{path.rstrip('/')}/{content[name]}") for name in ("daily", "metadata")]
    return PublishedExport(*tables, tuple(content["locations"]))


def merge_published(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Published exports of different stores as one table of daily rows.

    An export is unique in itself, so a location that two of them name is the only way to a repeated key; the manifests
    tell, and no row is read for it.
    """
    exports = [read_export(spark, path) for path in paths]
    named = [location for export in exports for location in export.locations]
    if shared := sorted({location for location in named if named.count(location) > 1}):
        raise GateError([Violation("I-5", f"exports share the locations {', '.join(shared)}", len(shared))])
    return reduce(DataFrame.unionByName, [export.daily.select(*DAILY_COLUMNS) for export in exports])
