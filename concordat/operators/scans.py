"""Aggregations over file-level licence scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import paths, spdx
from concordat.functions.text import or_default
from concordat.operators.ordering import packed


def is_file() -> Column:
    return F.col("type") == "file"


def top_score(detections: Column) -> Column:
    """Best match score over nested detections, 0 when there is none."""
    matches = F.flatten(
        F.transform(
            F.filter(detections, lambda d: d["matches"].isNotNull()),
            lambda d: d["matches"],
        )
    )
    scores = F.transform(matches, lambda m: F.coalesce(m["score"], F.lit(0.0)))
    return F.coalesce(F.array_max(scores), F.lit(0.0))


def directory_keys(files: DataFrame) -> list[str]:
    """What a directory is known by: its scan and inventory, where the rows name them, then bucket and name."""
    return [*[c for c in ("scan_id", "sbom_id") if c in files.columns], "bucket", "top"]


def expression_groups(files: DataFrame) -> DataFrame:
    """One row per (scan, bucket, top, raw expression): counts and first / last-root ordinals.

    The first, large shuffle already carries combined rows; the rest works on those.
    """
    keys = directory_keys(files.select("*", F.lit("").alias("top")) if "top" not in files.columns else files)
    raw = or_default(F.col("expr"), "")
    root = is_file() & paths.is_root_licence(F.col("path"))
    return (
        files.where(F.coalesce(F.col("path"), F.lit("")) != "")
        .withColumn("top", paths.top_dir(F.col("path")))
        .withColumn("raw", F.when(is_file(), raw))
        .groupBy(*keys, "raw")
        .agg(
            F.count_if(is_file()).alias("n"),
            F.min("ord").alias("first_ord"),
            F.max(F.when(root, F.col("ord"))).alias("root_any"),
        )
        .withColumn("detected", F.when(F.col("raw") != "", spdx.filter_false_positives(F.col("raw"))))
        .withColumn("root_ord", F.when(F.col("raw") != "", F.col("root_any")))
    )


def aggregate_dirs(files: DataFrame) -> DataFrame:
    """Dominant licence and file counts per scanned top-level directory.

    The last root licence file with a detection wins unless filtering empties it;
    then the commonest filtered expression, ties to the one seen first.
    """
    groups = expression_groups(files)
    keys = directory_keys(groups)
    by_expr = (
        groups
        .repartition(*keys)
        .groupBy(*keys, "detected")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_ord").alias("first_ord"),
            F.max("root_ord").alias("root_ord"),
            F.max("root_any").alias("root_any"),
        )
    )
    # Places of the winners first, in numbers; their expressions are fetched by them. All of it stays where by_expr is.
    has = F.col("detected").isNotNull()
    rank = packed(F.col("n"), -F.col("first_ord"))
    totals = by_expr.groupBy(*keys).agg(
        F.sum("n").alias("n_files"),
        F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).alias("n_with_license"),
        F.max("root_any").isNotNull().alias("license_file_seen"),
        F.min("first_ord").alias("first_ord"),
        F.max(F.when(has, F.col("root_ord"))).alias("_root"),
        F.max(F.when(has, rank)).alias("_mode"),
    )
    roots = by_expr.where(has & F.col("root_ord").isNotNull()).select(*keys, F.col("root_ord").alias("_root"), F.col("detected").alias("license_file_detected"))
    modes = by_expr.where(has).select(*keys, rank.alias("_mode"), F.col("detected").alias("_commonest"))
    return (
        totals.join(roots, [*keys, "_root"], "left").join(modes, [*keys, "_mode"], "left")
        .withColumn("dominant", F.coalesce(F.nullif("license_file_detected", F.lit("")), "_commonest", F.lit("")))
        .select(*keys, "n_files", "n_with_license", "license_file_seen", "first_ord", "license_file_detected", "dominant")
    )


def expression_histogram(files: DataFrame, filtered: bool = True) -> DataFrame:
    """Files per detected expression and directory, one row each."""
    col = "detected" if filtered else "raw"
    groups = expression_groups(files)
    return (
        groups
        .where(F.col("raw") != "")
        .groupBy(*directory_keys(groups), F.col(col).alias("expr"))
        .agg(F.sum("n").alias("n_files"))
    )


def histogram_map(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Report form: expression -> count as one map per directory. The long form stays the one to compute with."""
    return histogram.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_expressions"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("expr", "n_files")))).alias("expressions"),
    )


def file_conflicts(files: DataFrame, declared: str = "declared") -> DataFrame:
    """Files whose detection differs from the declared licence, where one is declared."""
    return files.where(
        is_file()
        & (F.coalesce(F.col("expr"), F.lit("")) != "")
        & (F.coalesce(F.col(declared), F.lit("")) != "")
        & (spdx.normalise_loose(F.col("expr")) != spdx.normalise_loose(F.col(declared)))
    )


def scan_summary(files: DataFrame, keys: list[str], declared: str = "declared") -> DataFrame:
    """Files, conflicts and files without a licence per package."""
    has = F.coalesce(F.col("expr"), F.lit("")) != ""
    conflict = (
        has
        & (F.coalesce(F.col(declared), F.lit("")) != "")
        & (spdx.normalise_loose(F.col("expr")) != spdx.normalise_loose(F.col(declared)))
    )
    return files.where(is_file()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(conflict).alias("n_conflicts"),
        F.count_if(~has).alias("n_no_license"),
    )


def scan_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_files", "n_conflicts", "n_no_license")]
    )


def dirs_per_bucket(dirs: DataFrame) -> DataFrame:
    """Top-level directories per bucket with a grand total, over all scans."""
    return dirs.rollup("bucket").agg(F.count(F.lit(1)).alias("n_dirs")).select(
        F.coalesce("bucket", F.lit("Total")).alias("bucket"), "n_dirs"
    )


def native_inventory(files: DataFrame, suffix: str = ".pyd") -> DataFrame:
    """Native files per package directory; files at the root count under '(loose)'."""
    keys = directory_keys(files.select("*", F.lit("").alias("top")) if "top" not in files.columns else files)
    return (
        files.where(is_file() & F.endswith(F.lower("path"), F.lit(suffix)))
        .withColumn("top", F.when(F.contains("path", F.lit("/")), paths.top_dir(F.col("path")))
                    .otherwise(F.lit("(loose)")))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_native"))
    )
