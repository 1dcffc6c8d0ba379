"""Readers for release hashes, checksum lists, antivirus verdicts and release notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import schemas as S

CHECKSUM_LINE = r"^([0-9a-fA-F]{64})\s+\*?(.+)$"
TABLE_ROW = r"^\|\s*([^|]+?)\s*\|\s*([^|]+?)\s*\|"
BULLET_ROW = r"^- \*\*([^*]+?):\*\*\s*(.+)$"


def folder_name(path: Column) -> Column:
    return F.get(F.reverse(F.split(path, "/")), F.lit(1))


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    """One row per released file with its release's fields."""
    return (
        spark.read.schema(S.RELEASE_HASHES).option("multiLine", True).json(path)
        .select("*", F.explode("files").alias("f"))
        .select(
            "tag", "app_id", "depot_id", F.try_to_number("raw_buildid", F.lit("9999999999999999")).cast("bigint")
            .alias("build"),
            F.try_to_timestamp("generated_at").alias("generated_at"), "generator",
            "composite_buildid", "live_branch", F.try_to_timestamp("set_live_at").alias("set_live_at"),
            "depot_manifests", "f.filename", "f.sha256", "f.size",
        )
    )


def parse_checksums(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds sha256 and filename; lines that are no checksum entry are left out."""
    return (
        lines.withColumn("sha256", F.regexp_extract(column, CHECKSUM_LINE, 1))
        .withColumn("filename", F.regexp_extract(column, CHECKSUM_LINE, 2))
        .where(F.col("sha256") != "")
    )


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(folder_name(F.col("_metadata.file_path")).alias("tag"), "value")
    return parse_checksums(lines).drop("value")


def explode_verdicts(documents: DataFrame) -> DataFrame:
    """One row per scanned binary and engine."""
    return documents.select(
        "tag", "filename", "sha256", "fetched_at", F.explode("last_analysis_results").alias("engine", "r")
    ).select(
        "tag", "filename", "sha256",
        F.try_to_timestamp("fetched_at").alias("fetched_at"),
        "engine", "r.method", "r.engine_version",
        F.try_to_date("r.engine_update", "yyyyMMdd").alias("engine_update"),
        "r.category", "r.result",
    )


def read_verdict_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.AV_DOCUMENT).option("multiLine", True).json(path)


def stored_stats(documents: DataFrame) -> DataFrame:
    return documents.select("tag", "filename", F.explode("last_analysis_stats").alias("category", "stored"))


def parse_note_fields(lines: DataFrame, column: str = "value") -> DataFrame:
    """(.., field, value) from two-column table rows or `- **Field:** value` bullets."""
    first = F.regexp_extract(column, TABLE_ROW, 1)
    table = F.struct(first.alias("field"), F.regexp_extract(column, TABLE_ROW, 2).alias("value"))
    bullet = F.struct(
        F.regexp_extract(column, BULLET_ROW, 1).alias("field"),
        F.regexp_extract(column, BULLET_ROW, 2).alias("value"),
    )
    is_rule = F.rlike(first, F.lit(r"^:?-+:?$"))
    pair = F.when((first != "") & ~is_rule & (first != "Field"), table).when(bullet["field"] != "", bullet)
    return lines.withColumn("_pair", pair).where(F.col("_pair").isNotNull()).select(
        *[c for c in lines.columns if c != column],
        F.trim("_pair.field").alias("field"), F.trim("_pair.value").alias("value"),
    )


def pivot_notes(fields: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per release with the named fields as columns."""
    def slug(n: str) -> str:
        return "".join(ch if ch.isalnum() else "_" for ch in n.lower()).strip("_")

    return fields.groupBy(*keys).agg(
        *[F.max(F.when(F.col("field") == n, F.col("value"))).alias(slug(n)) for n in names]
    )


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """(tag, field, value) over every release-notes file."""
    lines = spark.read.text(path).select(folder_name(F.col("_metadata.file_path")).alias("tag"), "value")
    return parse_note_fields(lines)


def component_count(value: Column) -> Column:
    """Leading number of a components field such as `1011 (unchanged from ...)`."""
    digits = F.regexp_replace(F.regexp_extract(value, r"^([\d,]+)", 1), ",", "")
    return F.nullif(digits, F.lit("")).cast("bigint")
