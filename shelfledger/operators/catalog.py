"""Store identity, product group paths and brand names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfledger.functions.joins import sorted_side
from shelfledger.schemas import GROUP_LEVELS


def store_identity(config: DataFrame, store: DataFrame) -> DataFrame:
    """One row per site: the name of its configured store. Both location columns of the result carry that name."""
    configured = config.where("store_code is not null").distinct()
    return (
        configured.join(store, ["site", "store_code"])
        .groupBy("site")
        .agg(F.min("store_name").alias("location_code"))
        .withColumn("location_name", F.col("location_code"))
    )


def group_path(groups: DataFrame, max_levels: int = GROUP_LEVELS) -> DataFrame:
    """Path of each group from its farthest ancestor (at most ``max_levels - 1`` hops up) down to itself.

    A parent already on the path ends the climb, so a cycle cannot loop. Shallow trees leave the deep levels NULL.
    """
    groups = groups.where("group_code is not null")
    climb = groups.select(
        "site",
        F.col("group_code").alias("assigned_group"),
        F.col("parent_code").alias("next_code"),
        F.array(F.struct("group_code", "group_id", "group_name")).alias("path"),
    )
    parents = groups.select(
        F.col("site").alias("p_site"),
        F.col("group_code").alias("p_code"),
        F.col("parent_code").alias("p_parent"),
        F.struct("group_code", "group_id", "group_name").alias("p_node"),
    )
    for _ in range(max_levels - 1):
        on_path = F.exists("path", lambda node: node["group_code"] == F.col("p_code"))
        climb = climb.join(
            sorted_side(parents),
            (F.col("site") == F.col("p_site")) & (F.col("next_code") == F.col("p_code")) & ~on_path,
            "left",
        ).select(
            "site",
            "assigned_group",
            F.col("p_parent").alias("next_code"),
            F.when(F.col("p_code").isNull(), F.col("path"))
            .otherwise(F.concat(F.array("p_node"), F.col("path")))
            .alias("path"),
        )
    levels = []
    for level in range(1, max_levels + 1):
        suffix = "" if level == 1 else str(level)
        node = F.get("path", F.lit(level - 1))
        levels += [
            F.max(node["group_id"]).alias(f"group_id{suffix}"),
            F.max(node["group_name"]).alias(f"group_name{suffix}"),
        ]
    # One row per group even if the source repeats a code.
    return climb.groupBy("site", "assigned_group").agg(*levels)


def group_columns(max_levels: int = GROUP_LEVELS) -> list[str]:
    suffixes = ["" if level == 1 else str(level) for level in range(1, max_levels + 1)]
    return reduce(lambda cols, s: [*cols, f"group_id{s}", f"group_name{s}"], suffixes, [])


def brand_names(brands: DataFrame) -> DataFrame:
    """One name per brand code; a repeated code keeps its greatest name."""
    return (
        brands.where("brand_code is not null").groupBy("site", "brand_code").agg(F.max("brand_name").alias("brand_name"))
    )
