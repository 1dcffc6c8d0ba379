"""Readers for component inventories, curation maps, tool maps and licence scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat import constants as C
from concordat import schemas as S
from concordat.functions import components as P
from concordat.functions import paths
from concordat.session import pin
from concordat.settings import DEFAULT_PROFILE, Profile
from concordat.sources import json_ranges


def _heads(entries: DataFrame) -> DataFrame:
    """(sbom_id, value): each document without its entries."""
    ends = entries.where(F.col("ord").isin(json_ranges.HEAD, json_ranges.TAIL))
    return ends.groupBy(F.col("file").alias("sbom_id")).agg(F.array_sort(F.collect_list(F.struct("ord", "value"))).alias("_e")).select(
        "sbom_id", F.array_join(F.transform("_e", lambda e: e["value"]), "").alias("value"))


def read_inventory(spark: SparkSession, path: str, size: int = json_ranges.RANGE) -> tuple[DataFrame, DataFrame]:
    """Components and documents of all inventories under a path, which is read once; see read_components and read_documents."""
    entries = pin(json_ranges.read_array(spark, path, "components", size))
    typed = F.from_json("value", S.COMPONENT)
    components = entries.where(~F.col("ord").isin(json_ranges.HEAD, json_ranges.TAIL)).select(
        F.col("file").alias("sbom_id"), "ord", typed.alias("component"), F.col("value").alias("raw"))
    whole = _heads(entries).withColumn("_d", F.from_json("value", S.HEAD))
    rest = F.map_filter(F.from_json("value", "map<string,variant>"), lambda k, v: k != "components")
    return components, whole.select("_d.*", "sbom_id", F.to_json(rest).alias("raw"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per inventory document: the typed fields but components, and the raw text of all fields but components (`raw`),
    so that nothing the types do not know is lost on writing.
    """
    return read_inventory(spark, path)[1]


def read_components(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """(sbom_id, ord, component, raw) with document order in ord; `limit` keeps the first n per document.

    Documents are read in byte ranges, so a large one spreads over many tasks.
    """
    rows = read_inventory(spark, path)[0]
    return rows.where(F.col("ord") < limit) if limit > 0 else rows


def flatten(components: DataFrame, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """The scalar columns most operators need, next to the nested record."""
    c = F.col("component")
    return components.select(
        "sbom_id", "ord", "component", *[x for x in ("raw",) if x in components.columns],
        c["name"].alias("name"),
        c["version"].alias("version"),
        c["purl"].alias("purl"),
        P.purl_prefix(c["purl"]).alias("prefix"),
        F.coalesce(P.first_property(c["properties"], profile.category_property), F.lit("")).alias("category"),
        P.first_property(c["properties"], profile.depot_property).alias("depot"),
        P.first_reference(c["externalReferences"], "website").alias("homepage"),
        P.first_reference(c["externalReferences"], "vcs").alias("vcs"),
        P.declared_label(c["licenses"]).alias("declared"),
        P.audit_label(c["licenses"]).alias("recorded"),
        P.first_label(c["licenses"]).alias("first_license"),
        P.scan_label(c["licenses"]).alias("scan_license"),
        P.licence_info(c["licenses"]).alias("info"),
    )


def _keyed_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """A JSON object with dynamic keys as (key, value) rows; `_` keys are comments.

    A missing or unreadable file reads as empty.
    """
    whole = (
        spark.read.format("binaryFile").option("ignoreMissingFiles", True).load(path)
        if path_exists(spark, path)
        else spark.createDataFrame([], "content binary")
    )
    # Values are parsed one by one: a comment that is plain text must not spoil the object.
    entries = whole.select(
        F.explode(F.from_json(F.col("content").cast("string"), "map<string,string>")).alias("key", "json"))
    return entries.where(~F.startswith("key", F.lit("_"))).select("key", F.from_json("json", value).alias("value"))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def read_curation(spark: SparkSession, path: str) -> DataFrame:
    """(key, rationale, classification)"""
    return _keyed_map(spark, path, S.CURATION_VALUE).select("key", "value.rationale", "value.classification")


def read_tools(spark: SparkSession, path: str) -> DataFrame:
    """(key, tool)"""
    return _keyed_map(spark, path, S.TOOL_VALUE).select("key", F.col("value").alias("tool"))


_FILE_ORDER = 40  # bits of a file's own places in ord
_SCAN_PATH = rf"([^/]*)/({'|'.join(C.SCAN_BUCKETS)})(?:[-.]([^/]*))?\.json$"


def read_scans(spark: SparkSession, folder: str, size: int = json_ranges.RANGE) -> DataFrame:
    """(scan_id, sbom_id, bucket, ord, path, top, type, expr, detections) of all scan files under a folder.

    A file is named after its bucket, with anything after a dash or dot where a bucket has several files (npm.json, npm-2.json). Files of
    one scan stand in a folder of its name, which is also that of the inventory it was made of; files directly in `folder` belong to
    the unnamed scan ''. ord follows the order of files and of entries within each. Other files are not read.
    """
    empty = (
        "scan_id string, sbom_id string, bucket string, ord bigint, path string, top string, type string, expr string, "
        "detections array<struct<matches:array<struct<license_expression_spdx:string,score:double>>>>"
    )
    if not path_exists(spark, folder):
        return spark.createDataFrame([], empty)
    # The folder itself, as it is spelled in the names of its files.
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    name = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).getName()
    part = lambda i: F.regexp_extract("file", _SCAN_PATH, i)
    # Files of a bucket are few beside their entries; their places come from the listing and go with their ranges.
    order = Window.partitionBy("scan_id", "bucket").orderBy(F.length("file"), "file")
    files = json_ranges.listed(spark, folder).where(F.rlike("file", F.lit(_SCAN_PATH))).select(
        "*", F.when(F.url_decode(part(1)) != name, F.url_decode(part(1))).otherwise("").alias("scan_id"), part(2).alias("bucket"))
    placed = files.withColumn("place", (F.row_number().over(order) - 1).cast("long"))
    entries = json_ranges.read_files(placed, ["scan_id", "bucket", "place"], "files", size)
    # Out of a generator, so that no rule moves the parsing into the filter as well.
    read = entries.where(~F.col("ord").isin(json_ranges.HEAD, json_ranges.TAIL)).select(
        "scan_id", "bucket", "place", "ord", F.explode(F.array(F.from_json("value", S.SCAN_FILE))).alias("f"))
    return read.where(F.coalesce(F.col("f.path"), F.lit("")) != "").select(
        "scan_id", F.col("scan_id").alias("sbom_id"), "bucket", F.shiftleft("place", _FILE_ORDER).bitwiseOR(F.col("ord")).alias("ord"), "f.path",
        paths.top_dir(F.col("f.path")).alias("top"), "f.type",
        F.col("f.detected_license_expression_spdx").alias("expr"), F.col("f.license_detections").alias("detections"))


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    """(block_ord, value): blocks of notices files, split at the rule line while reading.

    Blocks are numbered through all files in order of their names. A block's number is its place within the byte range it was read
    from plus the blocks of all ranges before, so it is the same however the files are split.
    """
    read = spark.read.option("lineSep", C.BLOCK_RULE).text(path)
    rows = pin(read.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), "value"))
    ranges = rows.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranges.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return rows.join(offsets, ["_file", "_start"]).select((F.col("_offset") + F.col("_at") - F.col("_first")).alias("block_ord"), "value")
