"""Verdict, status and gate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_FAILED = ("enriched", "skipped")


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def skip_math(results: DataFrame, total: int | None = None) -> DataFrame:
    done = F.count(F.lit(1))
    return results.agg(
        (done if total is None else F.lit(total).cast("bigint")).alias("total_in_sbom"),
        done.alias("processed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "enriched").alias("enriched"),
        F.count_if(~F.col("status").isin(*NOT_FAILED)).alias("failed"),
    )


def source_tag_counts(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == "enriched").groupBy("source_tag").agg(F.count(F.lit(1)).alias("n"))


def verdict_counts(rows: DataFrame, verdicts: Sequence[str], column: str = "verdict") -> DataFrame:
    """One row per verdict of the fixed list, zero-filled."""
    counted = rows.agg(*[F.count_if(F.col(column) == v).alias(f"n_{i}") for i, v in enumerate(verdicts)])
    pairs = F.array(*[
        F.struct(F.lit(v).alias("verdict"), F.col(f"n_{i}").alias("n")) for i, v in enumerate(verdicts)
    ])
    return counted.select(F.inline(pairs))


def drift_gate(drift: DataFrame) -> DataFrame:
    """Drift entries by class and the publish gate; entries without a class block."""
    cls = F.coalesce(F.col("classification"), F.lit("blocking"))
    return drift.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(cls == "blocking").alias("blocking"),
        F.count_if(cls == "multi-license-expected").alias("multi_license_expected"),
    ).withColumn("may_publish", F.col("blocking") == 0)
