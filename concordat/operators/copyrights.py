"""Copyright harvest and source-header evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions import evidence
from concordat.functions import text as T


def harvest(blobs: DataFrame, seeds: DataFrame | None = None, extra_patterns: tuple[str, ...] = ()) -> DataFrame:
    """(component_id, line_key, line): distinct statements ignoring case, redacted.

    `blobs(component_id, blob_ord, text)` give lines in order and the first spelling stays;
    `seeds(component_id, seed_ord, line)` come before them and their last spelling stays.
    """
    lines = blobs.select(
        "component_id", "blob_ord", F.posexplode(evidence.copyright_lines(F.col("text"))).alias("at", "line")
    ).select(
        "component_id", F.lower("line").alias("line_key"), "line",
        F.lit(1).alias("src"), F.col("blob_ord").cast("bigint").alias("a"), F.col("at").cast("bigint").alias("b"),
    )
    if seeds is not None:
        line = T.strip(F.col("line"))
        lines = lines.unionByName(
            seeds.select(
                "component_id", F.lower(line).alias("line_key"), line.alias("line"),
                F.lit(0).alias("src"), (-F.col("seed_ord")).cast("bigint").alias("a"),
                F.lit(0).cast("bigint").alias("b"),
            )
        )
    return (
        lines.groupBy("component_id", "line_key")
        .agg(F.min_by("line", F.struct("src", "a", "b")).alias("line"))
        .withColumn("line", T.redact_paths(F.col("line"), extra_patterns))
    )


def joined(harvested: DataFrame) -> DataFrame:
    """One newline-joined value per component, sorted ignoring case; the inventory format holds it as one value."""
    return (
        harvested.groupBy("component_id")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line") + 1).alias("n_chars"),
             F.array_sort(F.collect_list(F.struct("line_key", "line"))).alias("rows"))
        .select("component_id", "n_lines", "n_chars", F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("copyright"))
    )


def header_evidence(headers: DataFrame) -> DataFrame:
    """(component_id, spdx_id, n_files): files whose header names each SPDX id."""
    return (
        headers.select(
            "component_id",
            F.explode(F.array_distinct(
                F.transform(evidence.spdx_marker(F.col("header")), F.lower))).alias("spdx_id"),
        )
        .groupBy("component_id", "spdx_id")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def header_totals(headers: DataFrame) -> DataFrame:
    """Files with a marker and distinct ids per component, without collecting the ids."""
    marked = headers.where(F.size(evidence.spdx_marker(F.col("header"))) > 0)
    files = marked.groupBy("component_id").agg(F.count(F.lit(1)).alias("n_files"))
    ids = header_evidence(marked).groupBy("component_id").agg(F.count(F.lit(1)).alias("n_ids"))
    return files.join(ids, "component_id")
