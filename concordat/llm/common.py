"""Expressions and helpers that the operators of this subpackage share."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.session import pin

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def n_words(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE))).cast("long")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, _doc, so that no column of the input can clash with one of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")


_FILE_ROWS = 40  # bits of a row's place within its file


def _in_files(docs: DataFrame) -> DataFrame | None:
    """_file, _index and _doc of a table that is plain Parquet files, else None."""
    if not docs._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        return None
    try:
        at = docs.metadataColumn("_metadata")
        file = F.regexp_replace(at["file_path"], r"^(\w+):/+", "$1:/")
        return docs.select(file.alias("_file"), at["row_index"].alias("_index"), packed(docs))
    except AnalysisException:
        return None


def steady(docs: DataFrame) -> DataFrame:
    """docs as plain Parquet files, written once if they are anything else; for operators that number them more than once."""
    return docs if _in_files(docs) is not None else pin(docs)


def numbered(docs: DataFrame) -> DataFrame:
    """_row, the row's file and place in it, and _doc; every read of the result gives a row the same number.

    The number is that of the Parquet reader and not of the task, so it does not depend on how files are split, which
    Spark decides anew for each job. Tables that are not plain Parquet files are written once and numbered there.
    """
    docs = steady(docs)
    place = _in_files(docs)
    # One file URI may be spelled file:/x and file:///x.
    files = sorted({re.sub(r"^(\w+):/+", r"\1:/", f) for f in docs.inputFiles()})
    if len(files) <= 1:
        return place.select(F.col("_index").alias("_row"), "_doc")
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), "_no long, _file string")
    # A file without a number would be an error in here, and must not lose its rows quietly.
    number = F.coalesce("_no", F.raise_error(F.concat(F.lit("no number for "), F.col("_file"))).cast("long"))
    return place.join(F.broadcast(numbers), "_file", "left").select(
        F.shiftleft(number, _FILE_ROWS).bitwiseOR(F.col("_index")).alias("_row"), "_doc")


# Rows of a narrow written table that may be broadcast: a few dozen MB.
MAX_BROADCAST = 1_000_000


def counted(df: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """A written table as the small side of a join: broadcast if its rows, counted, are few, else merged."""
    return F.broadcast(df) if df.count() <= most else df.hint("merge")


def running(df: DataFrame, key: str, chunk: str, order: list[str], value: str | None, into: str, row: str) -> DataFrame:
    """Exclusive running sum of a value (a count if None) within each key, in the given order.

    chunk is a column that follows the order and cuts each key into pieces. Sums of pieces are added up first,
    and then each piece is summed by a task of its own, so that no key is ever in one task. row numbers the rows
    of a piece from 1. key and chunk must not be null.
    """
    one = F.lit(1).cast("long") if value is None else F.col(value)
    pieces = df.groupBy(key, chunk).agg(F.sum(one).alias("_piece"))
    before = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.select(key, chunk, F.coalesce(F.sum("_piece").over(before), F.lit(0)).cast("long").alias("_base"))
    inside = Window.partitionBy(key, chunk).orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(bases.hint("merge"), [key, chunk])  # df may be cut out of arrays, and then Spark sizes it far too low
        .withColumn(row, F.row_number().over(inside))
        .withColumn(into, F.col("_base") + F.coalesce(F.sum(one).over(earlier), F.lit(0)))
        .drop("_base")
    )
