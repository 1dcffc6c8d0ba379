"""Notices blocks: rendering, parsing and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions import text as T


def render_block(
    name: Column, version: Column, label: Column, homepage: Column, purl: Column,
    copyright_text: Column, body: Column,
) -> Column:
    blank = F.lit("")
    rows = [
        F.concat(F.lit("COMPONENT:    "), F.coalesce(name, F.lit("?")), F.lit(" "),
                 F.coalesce(version, F.lit("?"))),
        F.concat(F.lit("LICENSE:      "), T.or_default(label, "Unknown")),
        F.concat(F.lit("HOMEPAGE:     "), F.coalesce(homepage, blank)),
        F.concat(F.lit("PURL:         "), F.coalesce(purl, blank)),
        blank,
        F.lit("COPYRIGHT"),
        F.lit("─" * 9),
        T.or_default(copyright_text, "(none recorded)"),
        blank,
        F.lit("LICENSE TEXT"),
        F.lit("─" * 12),
        T.or_default(body, C.NO_LICENCE_TEXT),
        blank,
        F.lit(C.BLOCK_RULE),
    ]
    return F.concat_ws("\n", *rows)


def parse_header(block: Column) -> tuple[Column, Column, Column]:
    """(header, name, version) of a block's first COMPONENT line; version follows the last blank."""
    header = T.strip(F.regexp_extract(block, r"(?m)^COMPONENT:([^\r\n]*)", 1))
    version = F.substring_index(header, " ", -1)
    name = T.strip(F.left(header, F.length(header) - F.length(version)))
    has_both = F.contains(header, F.lit(" "))
    return header, F.when(has_both, name), F.when(has_both, T.strip(version))


def parse_blocks(blocks: DataFrame, column: str = "value") -> DataFrame:
    header, name, version = parse_header(F.col(column))
    return blocks.select(
        "*", header.alias("header"), name.alias("name"), version.alias("version")
    ).where(F.col("name").isNotNull())


def select_blocks(blocks: DataFrame, selected: DataFrame) -> DataFrame:
    """Blocks of the selected (name, version) pairs; every copy of a block is kept."""
    return blocks.join(selected.select("name", "version").distinct(), ["name", "version"], "left_semi")


def selection_counts(blocks: DataFrame, selected: DataFrame) -> DataFrame:
    """selected blocks, expected pairs and their difference."""
    found = select_blocks(blocks, selected).agg(F.count(F.lit(1)).alias("n_selected"))
    wanted = selected.select("name", "version").distinct().agg(F.count(F.lit(1)).alias("n_expected"))
    return (
        found.select("n_selected", F.lit(0).cast("bigint").alias("n_expected"))
        .unionByName(wanted.select(F.lit(0).cast("bigint").alias("n_selected"), "n_expected"))
        .agg(F.sum("n_selected").alias("n_selected"), F.sum("n_expected").alias("n_expected"))
        .withColumn("diff", F.col("n_expected") - F.col("n_selected"))
    )
