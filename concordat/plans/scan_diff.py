"""Scan-versus-declaration report: which components' detected licence disagrees with the declared one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.functions import paths, spdx
from concordat.functions.text import or_default, shorten
from concordat.operators.counts import verdict_counts
from concordat.operators.curation import with_curation
from concordat.operators.matching import match_dirs
from concordat.operators.scans import aggregate_dirs
from concordat.session import pin


def classify(files: DataFrame, components: DataFrame, curation: DataFrame) -> DataFrame:
    """One row per scanned directory with `outcome`; of several scans, one row per scan and directory.

    `files(bucket, ord, path, type, expr)`, `components(prefix, ord, name, version, declared)`,
    `curation(key, rationale)`; files and components of several inventories have a sbom_id as well. Outcomes are disjoint and cover every directory:
    UNACCOUNTED, CURATED, ACK, MISMATCH, NO-DETECTION. `first_ord` is where the scan first names the directory.
    """
    matched = match_dirs(aggregate_dirs(files), components)
    return label(with_curation(matched, curation))


def label(matched: DataFrame) -> DataFrame:
    pair = spdx.verdict(F.col("declared"), F.col("dominant"))
    open_row = F.col("matched") & ~F.col("curated")
    return matched.withColumn("_v", pair).select(
        *[c for c in ("scan_id", "sbom_id") if c in matched.columns], "bucket", "top", "first_ord", "name", "version", "declared", F.col("dominant").alias("detected"),
        "n_files", "n_with_license", "license_file_seen", "rationale",
        F.when(~F.col("matched"), "UNACCOUNTED").when(F.col("curated"), "CURATED")
        .otherwise(F.col("_v.verdict")).alias("outcome"),
        F.when(open_row, F.col("_v.detail")).alias("detail"),
    )


def summary(classified: DataFrame) -> DataFrame:
    """Counts for the fixed verdict list plus CURATED and UNACCOUNTED."""
    return verdict_counts(classified, (*C.SCAN_VERDICTS, "CURATED", "UNACCOUNTED"), "outcome")


def gate(classified: DataFrame) -> DataFrame:
    """One row: may the release go out (no MISMATCH)."""
    return classified.agg(F.count_if(F.col("outcome") == "MISMATCH").alias("n_mismatch")).withColumn(
        "passes", F.col("n_mismatch") == 0
    )


def _tick(s: str):
    return F.concat(F.lit("`"), F.coalesce(F.col(s), F.lit("")), F.lit("`"))


def mismatch_rows(classified: DataFrame) -> DataFrame:
    """(bucket, name, line) of the mismatch table; sort by the first two when writing."""
    seen = F.when(F.col("license_file_seen"), "✓").otherwise("—")
    line = F.concat(
        F.lit("| "), F.col("bucket"), F.lit(" | "), _tick("name"), F.lit(" | "), _tick("version"), F.lit(" | "),
        _tick("declared"), F.lit(" | "), _tick("detected"), F.lit(" | "), seen, F.lit(" | "),
        F.col("n_files").cast("string"), F.lit(" |"),
    )
    return classified.where(F.col("outcome") == "MISMATCH").select("bucket", "name", "top", line.alias("line"))


def _in_scan_order(rows: DataFrame, line: Column, n: int, rest: bool = True) -> DataFrame:
    """(k, line): the first n rows by bucket list and document order, numbered, and how many more there are."""
    place = F.array_position(F.array(*[F.lit(b) for b in C.SCAN_BUCKETS]), F.col("bucket"))
    order = [F.when(place > 0, place).otherwise(len(C.SCAN_BUCKETS) + 1), F.col("bucket"), F.col("first_ord"), F.col("top")]
    first = rows.select("*", *[o.alias(f"_o{i}") for i, o in enumerate(order)]).orderBy("_o0", "_o1", "_o2", "_o3").limit(n)
    number = F.row_number().over(Window.orderBy("_o0", "_o1", "_o2", "_o3"))  # of n rows at most
    shown = first.select(F.lpad(number.cast("string"), 4, "0").alias("k"), line.alias("line"))
    if not rest:
        return shown
    more = rows.agg((F.count(F.lit(1)) - n).alias("more")).where("more > 0")
    return shown.unionByName(more.select(F.lit("9999").alias("k"), F.format_string("- ... and %d more", "more").alias("line")))


def _total(rows: DataFrame, form: str, k: str = "0000") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit(k).alias("k"), F.format_string(form, "n").alias("line"))


def report(classified: DataFrame) -> DataFrame:
    """(section, at, line): the report as sorted rows, unique by (section, at) within its samples.

    All sections read the same classified directories, which are written once: they are far fewer than the files they sum up.
    """
    classified = pin(classified)

    def section(n: int, lines: DataFrame, order: list[str]) -> DataFrame:
        return lines.select(
            F.lit(n).alias("section"), F.concat_ws("\x1f", *order).alias("at"), "line"
        )

    counts = summary(classified).select(
        "verdict", F.concat(F.lit("- "), F.col("verdict"), F.lit(": "), F.col("n").cast("string")).alias("line")
    )
    curated = classified.where(F.col("outcome") == "CURATED").select(
        "name", "top",
        F.concat(F.lit("- "), _tick("name"), F.lit(" "), _tick("version"), F.lit(": declared "), _tick("declared"),
                 F.lit(", detected "), _tick("detected"), F.lit("\n  - "),
                 shorten(F.coalesce("rationale", F.lit("(no rationale recorded)")))).alias("line"),
    )
    silent = classified.where(F.col("outcome") == "NO-DETECTION")
    silent_line = F.concat(
        F.lit("- "), _tick("name"), F.lit(" "), _tick("version"), F.lit(" (declared "), _tick("declared"),
        F.lit(", "), F.col("n_files").cast("string"), F.lit(" files, "), F.col("bucket"), F.lit(")"),
    )
    unaccounted = classified.where(F.col("outcome") == "UNACCOUNTED")
    loose = unaccounted.where(~paths.is_noise_dir(F.col("top")))
    loose_line = F.concat(
        F.lit("- "), _tick("top"), F.lit(" ("), F.col("bucket"), F.lit(", "), F.col("n_files").cast("string"),
        F.lit(" files, detected `"), or_default(F.col("detected"), "none"), F.lit("`)"),
    )
    acks = classified.where(F.col("outcome") == "ACK")
    ack_line = F.concat(F.lit("- "), _tick("name"), F.lit(" "), _tick("version"), F.lit(": declared "),
                        _tick("declared"), F.lit(" ✓"))
    parts = [
        section(1, counts, ["verdict"]),
        section(2, curated, ["name", "top"]),
        section(3, mismatch_rows(classified), ["bucket", "name", "top"]),
        section(4, _total(silent, "## NO-DETECTION (%d)").unionByName(_in_scan_order(silent, silent_line, 30)), ["k"]),
        section(5, _total(unaccounted, "- Total: %d").unionByName(_total(loose, "- After noise-stripping: %d", "0000+"))
                .unionByName(_in_scan_order(loose, loose_line, 30)), ["k"]),
        section(6, _in_scan_order(acks, ack_line, 25, rest=False), ["k"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
