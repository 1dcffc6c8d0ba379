"""Sinks: enriched inventories, notices, reports.

Everything is written by Spark's committed writers; text files are sorted by a global range
sort, so no single task holds a whole report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions import components as P
from concordat.functions import text as T
from concordat.functions.documents import merge as documents_merge
from concordat.functions.documents import redact_document, redact_json, without_tools
from concordat.functions.spdx import normalise_loose
from concordat.operators import counts, notices
from concordat.settings import DEFAULT_PROFILE, Profile
from concordat.sources.replace import replacing


def write_sorted_lines(lines: DataFrame, order: list[str], path: str, column: str = "line") -> None:
    lines.orderBy(*order).select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def redact_components(components: DataFrame, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    dtype = components.schema["component"].dataType
    clean = components.withColumn(
        "component", redact_document(F.col("component"), dtype, profile.extra_path_patterns)
    )
    if "raw" in components.columns:
        clean = clean.withColumn("raw", redact_json(F.col("raw"), profile.extra_path_patterns))
    return clean


def write_components(components: DataFrame, path: str) -> None:
    """Default sink: one row per component."""
    components.write.mode("overwrite").parquet(path)


def document_lines(components: DataFrame, documents: DataFrame, tools: Column | None = None) -> DataFrame:
    """(sbom_id, ord, value): each document as lines: its head, one line per component, its end.

    Together, in order, they are one JSON document; no row holds more than a component. Fields that the typed
    record lacks come from the raw text of documents and components where the reader has kept it.
    """
    last = components.groupBy("sbom_id").agg(F.max("ord").alias("_last"))
    raw = F.col("raw") if "raw" in components.columns else F.lit(None).cast("string")
    rows = components.join(last, "sbom_id").select(
        "sbom_id", "ord",
        F.concat(documents_merge(raw, F.col("component"), components.schema["component"].dataType), F.when(F.col("ord") < F.col("_last"), ",").otherwise("")).alias("value"),
    )
    meta = F.col("metadata") if tools is None else F.struct(tools.alias("tools"))
    typed = documents.select("sbom_id", *[c for c in ("raw",) if c in documents.columns], F.struct("bomFormat", "specVersion", meta.alias("metadata")).alias("_t"))
    head = F.to_json("_t")
    if "raw" in documents.columns:
        head = documents_merge(F.col("raw") if tools is None else without_tools(F.col("raw")), F.col("_t"), typed.schema["_t"].dataType)
    heads = typed.withColumn("_head", head).select("sbom_id", F.lit(-1).cast("bigint").alias("ord"), F.concat(
        F.regexp_replace("_head", r"\}$", ""), F.when(F.col("_head") != "{}", ",").otherwise(""), F.lit('"components":[')).alias("value"))
    ends = documents.select("sbom_id", F.lit((1 << 63) - 1).cast("bigint").alias("ord"), F.lit("]}").alias("value"))
    return heads.unionByName(rows).unionByName(ends)


def rebuild_documents(components: DataFrame, documents: DataFrame, tools: Column | None = None) -> DataFrame:
    """(sbom_id, value): documents as one value each, for those who need them so; see document_lines."""
    lines = document_lines(components, documents, tools)
    return lines.groupBy("sbom_id").agg(F.array_sort(F.collect_list(F.struct("ord", "value"))).alias("_l")).select(
        "sbom_id", F.array_join(F.transform("_l", lambda x: x["value"]), "").alias("value"))


def write_documents(lines: DataFrame, path: str) -> None:
    """Writes document_lines as text, one folder per document, lines in order."""
    (
        lines.withColumn("document", T.partition_safe(F.col("sbom_id")))
        .repartitionByRange("document", "ord").sortWithinPartitions("document", "ord")
        .select("document", "value").write.mode("overwrite").partitionBy("document").text(path)
    )


def replace_documents(lines: DataFrame, path: str) -> None:
    """As write_documents, but into a new version that replaces the one under the path at once; read it at replace.current()."""
    with replacing(lines.sparkSession, path) as target:
        write_documents(lines, target)


def notices_blocks(flat: DataFrame, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """(sbom_id, ord, block) per component."""
    c = F.col("component")
    return flat.select(
        "sbom_id", "ord",
        notices.render_block(
            F.col("name"), F.col("version"), F.col("info.value"), F.col("homepage"), F.col("purl"),
            c["copyright"], P.embedded_text(c, profile),
        ).alias("block"),
    )


def write_notices(flat: DataFrame, path: str, profile: Profile = DEFAULT_PROFILE) -> None:
    head = flat.sparkSession.range(1).select(
        F.lit("").alias("sbom_id"), F.lit(-1).cast("bigint").alias("ord"),
        F.lit(f"{profile.notices_title}\n\n{C.BLOCK_RULE}").alias("block"),
    )
    write_sorted_lines(head.unionByName(notices_blocks(flat, profile)), ["sbom_id", "ord"], path, "block")


def subset_notices_lines(selected: DataFrame, title: str) -> DataFrame:
    """(part, at, pos, line): contents listing sorted ignoring case, then the blocks.

    `selected(block_ord, header, value)`; sort by the first three columns when writing.
    """
    total = selected.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("part"), F.lit("").alias("at"), F.lit(0).cast("bigint").alias("pos"),
        F.concat(F.lit(f"{title}\n\n{C.BLOCK_RULE}\nTABLE OF CONTENTS\n{'─' * 75}\nTotal components: "),
                 F.col("n").cast("string"), F.lit(". Alphabetical by name.\n")).alias("line"),
    )
    listing = selected.select(
        F.lit(1).alias("part"), F.lower("header").alias("at"), F.col("block_ord").alias("pos"),
        F.concat(F.lit("  "), F.col("header")).alias("line"),
    )
    blocks = selected.select(
        F.lit(2).alias("part"), F.lit("").alias("at"), F.col("block_ord").alias("pos"),
        F.concat(F.lit(C.BLOCK_RULE), F.col("value")).alias("line"),
    )
    return total.unionByName(listing).unionByName(blocks)


def write_subset_notices(selected: DataFrame, path: str, title: str) -> None:
    write_sorted_lines(subset_notices_lines(selected, title), ["part", "at", "pos"], path)


def enrichment_report(results: DataFrame) -> DataFrame:
    """(section, at, line) of the processing summary."""
    def rows(n: int, df: DataFrame, at: Column, line: Column) -> DataFrame:
        return df.select(F.lit(n).alias("section"), at.cast("string").alias("at"), line.alias("line"))

    status = counts.status_counts(results)
    math = counts.skip_math(results)
    names = ("total_in_sbom", "processed", "skipped", "enriched", "failed")
    pairs = math.select(F.posexplode(F.array(*[
        F.struct(F.lit(n).alias("k"), F.col(n).alias("v")) for n in names
    ])).alias("pos", "p"))
    bad = results.where(~F.col("status").isin(*counts.NOT_FAILED))
    tags = counts.source_tag_counts(results)
    count_line = lambda k, v: F.concat(F.lit("  "), k, F.lit(": "), v.cast("string"))
    bad_line = F.concat(
        F.lit("  ["), F.col("status"), F.lit("] "), F.col("name"), F.lit(" "), F.col("version"), F.lit(" ("),
        F.col("category"), F.lit("): "), F.col("reason"),
    )
    return (
        rows(1, status, F.col("status"), count_line(F.col("status"), F.col("n")))
        .unionByName(rows(2, pairs, F.col("pos"), count_line(F.col("p.k"), F.col("p.v"))))
        .unionByName(rows(3, bad, F.concat_ws("|", "sbom_id", F.lpad(F.col("ord").cast("string"), 19, "0")), bad_line))
        .unionByName(rows(4, tags, F.col("source_tag"), count_line(F.col("source_tag"), F.col("n"))))
    )


def drift_lines(results: DataFrame) -> DataFrame:
    """(sbom_id, ord, line): one block per drifting component with the first ten evidence lines."""
    shown = F.transform(T.head_lines(F.col("drift.evidence"), 10), lambda x: F.concat(F.lit("      | "), x))
    return results.where(F.col("drift").isNotNull()).select(
        "sbom_id", "ord",
        F.concat_ws(
            "\n",
            F.concat(F.lit("  "), F.col("name"), F.lit(" "), F.col("version")),
            F.concat(F.lit("    purl:     "), F.col("purl")),
            F.concat(F.lit("    declared: "), F.col("drift.declared")),
            F.concat(F.lit("    detected: "), F.col("drift.detected")),
            F.lit("    evidence (first 500 chars):"),
            F.array_join(shown, "\n"),
            F.lit(""),
        ).alias("line"),
    )


def component_scan_report(files: DataFrame, histogram: DataFrame, conflicts: DataFrame, summary: DataFrame) -> DataFrame:
    """(component, section, n, at, line) of per-component scan reports.

    `summary(component, declared, n_files, n_no_license)`, `histogram(component, declared, expr, n_files)`,
    `conflicts(component, path, expr, top_score)`.
    """
    tick = lambda c: F.concat(F.lit("`"), c, F.lit("`"))
    zero = F.lit(0.0)
    head = summary.select(
        "component", F.lit(1).alias("section"), zero.alias("n"), F.lit("").alias("at"),
        F.concat(F.lit("- Declared SPDX: "), tick(T.or_default(F.col("declared"), "(none)")),
                 F.lit("\n- Files scanned: "), F.col("n_files").cast("string"),
                 F.lit("\n- Files with no license detected: "), F.col("n_no_license").cast("string")).alias("line"),
    )
    mark = F.when(normalise_loose(F.col("expr")) == normalise_loose(F.col("declared")), " ← matches declared").otherwise("")
    found = histogram.select(
        "component", F.lit(2).alias("section"), (-F.col("n_files")).cast("double").alias("n"), F.col("expr").alias("at"),
        F.concat(F.lit("  - "), tick(F.col("expr")), F.lit(": "), F.col("n_files").cast("string"), F.lit(" file(s)"), mark)
        .alias("line"),
    )
    bad = conflicts.select(
        "component", F.lit(3).alias("section"), (-F.col("top_score")).alias("n"), F.col("path").alias("at"),
        F.concat(F.lit("| "), tick(F.col("path")), F.lit(" | "), tick(F.col("expr")), F.lit(" | "),
                 F.format_string("%.0f", "top_score"), F.lit(" |")).alias("line"),
    )
    return head.unionByName(found).unionByName(bad)


def write_component_reports(report: DataFrame, path: str) -> None:
    """One folder per component, lines sorted; a large component spreads over several files."""
    (
        report.withColumn("report", T.partition_safe(F.col("component")))
        .repartitionByRange("report", "section", "n", "at")
        .sortWithinPartitions("report", "section", "n", "at")
        .select("report", F.col("line").alias("value"))
        .write.mode("overwrite").partitionBy("report").text(path)
    )


def audit_lines(audited: DataFrame) -> DataFrame:
    """(at, line): one block per audited component, sorted by lower-case name."""
    return audited.select(
        F.lower("name").alias("at"),
        F.concat_ws(
            "\n",
            F.lit("─" * 75),
            F.concat(F.lit("COMPONENT:   "), F.col("name")),
            F.concat(F.lit("PIN:         "), F.col("version")),
            F.concat(F.lit("RECORDED:    "), F.col("recorded")),
            F.concat(F.lit("HOMEPAGE:    "), F.coalesce("homepage", F.lit(""))),
            F.concat(F.lit("DOC_UPSTREAM:"), F.col("upstream_repo")),
            F.concat(F.lit("VERDICT:     "), F.col("verdict")),
            F.concat(F.lit("DETAIL:      "), F.col("detail")),
        ).alias("line"),
    )


