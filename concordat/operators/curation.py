"""Curation overrides and system-tool lookups keyed by `name@version`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.components import component_key


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("_ck", component_key(F.col("name"), F.col("version")))


def with_curation(df: DataFrame, curation: DataFrame) -> DataFrame:
    """Left join; adds `curated` and `rationale`. `curation(key, rationale)` has unique keys."""
    side = curation.select(F.col("key").alias("_ck"), F.lit(True).alias("curated"), "rationale")
    return (
        _keyed(df)
        .join(side, "_ck", "left")
        .drop("_ck")
        .withColumn("curated", F.coalesce("curated", F.lit(False)))
    )


def without_curated(df: DataFrame, curation: DataFrame) -> DataFrame:
    side = curation.select(F.col("key").alias("_ck"))
    return _keyed(df).join(side, "_ck", "left_anti").drop("_ck")


def with_tool(df: DataFrame, tools: DataFrame) -> DataFrame:
    """Left join to the system-tool map; adds struct `tool`, null when there is no entry."""
    side = tools.select(F.col("key").alias("_ck"), "tool")
    return _keyed(df).join(side, "_ck", "left").drop("_ck")
