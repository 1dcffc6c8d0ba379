"""Release facts: hashes, component deltas, antivirus verdicts and errata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.operators.ordering import carry_forward, previous_row


def verify_hashes(local: DataFrame, published: DataFrame) -> DataFrame:
    """Match / mismatch / unpublished per local file; hex case does not matter."""
    side = published.select("tag", "filename", F.lower("sha256").alias("_published"))
    mine = F.lower("sha256")
    return local.join(side, ["tag", "filename"], "left").withColumn(
        "outcome",
        F.when(F.col("_published").isNull(), "unpublished").when(mine == F.col("_published"), "match")
        .otherwise("mismatch"),
    ).drop("_published")


def checksum_differences(hashes: DataFrame, sums: DataFrame) -> DataFrame:
    """Rows on which the two published renderings of the same hashes disagree."""
    a = hashes.select("tag", "filename", F.lower("sha256").alias("json_sha256"))
    b = sums.select("tag", "filename", F.lower("sha256").alias("list_sha256"))
    return a.join(b, ["tag", "filename"], "full_outer").where(
        ~F.col("json_sha256").eqNullSafe(F.col("list_sha256"))
    )


def component_delta(
    releases: DataFrame, order: Sequence[str], small_groups: bool = False
) -> DataFrame:
    """Change in component count against the release before, in build order (never tag text)."""
    prev = previous_row(releases, [], order, ["tag", "components"], small_groups)
    return prev.withColumn("delta", F.col("components") - F.col("prev_components")).withColumn(
        "unchanged", F.coalesce(F.col("delta") == 0, F.lit(False))
    )


def verdict_pivot(verdicts: DataFrame, keys: Sequence[str], categories: Sequence[str] = C.AV_CATEGORIES) -> DataFrame:
    """One column per category, zero-filled, in a single aggregate."""
    return verdicts.groupBy(*keys).agg(
        *[F.count_if(F.col("category") == c).alias(c.replace("-", "_")) for c in categories]
    )


def verdict_reconcile(verdicts: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Category counts next to the stored counters; `agrees` is false on any difference.

    `stats(keys..., category, stored)` in long form; zero counters may be absent on either side.
    """
    counted = verdicts.groupBy(*keys, "category").agg(F.count(F.lit(1)).alias("counted"))
    return (
        counted.join(stats, [*keys, "category"], "full_outer")
        .select(*keys, "category",
                F.coalesce("counted", F.lit(0)).alias("counted"),
                F.coalesce("stored", F.lit(0)).alias("stored"))
        .withColumn("agrees", F.col("counted") == F.col("stored"))
    )


def retro_flags(
    verdicts: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flagged: Sequence[str] = C.AV_FLAGGED,
    small_groups: bool = False,
) -> DataFrame:
    """Scans on which an engine turns from clean to flagged for the same binary."""
    seen = previous_row(verdicts, keys, order, ["category"], small_groups)
    return seen.where(
        F.col("category").isin(*flagged)
        & F.col("prev_category").isNotNull()
        & ~F.col("prev_category").isin(*flagged)
    )


def apply_errata(published: DataFrame, errata: DataFrame) -> DataFrame:
    """Corrected licences overlaid on published ones inside each erratum's release range.

    `errata(name, corrected, lo_seq, hi_seq)`, at most one row per name and release: ranges of one name do not overlap, and empty ones
    hold nothing. Starts of ranges and releases are put in one order, and each release takes the last range opened before it, if that has
    not ended. No name's releases meet all of its ranges, and a name with any number of either spreads over many tasks.
    """
    ranges = errata.where("lo_seq <= hi_seq").select(
        "name", F.col("lo_seq").alias("_at"), F.lit(0).alias("_kind"), F.struct("corrected", F.col("hi_seq").alias("until")).alias("_range_open"),
        F.lit(None).cast(published.schema).alias("_row"))
    known = F.col("name").isNotNull() & F.col("release_seq").isNotNull()
    rows = published.where(known).select(
        "name", F.col("release_seq").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(ranges.schema["_range_open"].dataType).alias("_range_open"),
        F.struct(*[F.col(f"`{c}`") for c in published.columns]).alias("_row"))
    swept = carry_forward(ranges.where(F.col("name").isNotNull() & F.col("_at").isNotNull()).unionByName(rows), ["name"], ["_at", "_kind"], "_range_open")
    covered = (F.col("_range_open.until") >= F.col("_at")) & F.col("_range_open.corrected").isNotNull()
    found = swept.where("_kind = 1").select("_row.*", F.when(covered, F.col("_range_open.corrected")).alias("_corrected"))
    return found.unionByName(published.where(~known).withColumn("_corrected", F.lit(None).cast("string"))).select(
        *published.columns, F.coalesce("_corrected", "license").alias("effective_license"), F.col("_corrected").isNotNull().alias("corrected"))


def daily_flags(verdicts: DataFrame, flagged: Sequence[str] = C.AV_FLAGGED, key: str = "filename") -> DataFrame:
    return verdicts.groupBy(F.window("fetched_at", "1 day").alias("w"), key).agg(
        F.count_if(F.col("category").isin(*flagged)).alias("n_flagged"),
        F.count(F.lit(1)).alias("n_verdicts"),
    ).select(F.col("w.start").alias("day"), key, "n_flagged", "n_verdicts")
