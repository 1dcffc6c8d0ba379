"""Queries over scanned files: dominant licences, matching, verdicts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat import constants as C
from concordat.bindings import inputs as I
from concordat.bindings.expressions import flat, verdict_sql
from concordat.bindings.registry import query
from concordat.functions import paths, spdx
from concordat.operators import counts, matching, ordering, scans
from concordat.plans import scan_diff
from concordat.session import pin


def parts(spark, d):
    return flat(spark, d).select("prefix", "ord", "name", "version", "declared")


@query("dominant_license", f"""WITH {I.scan_cte()}, {I.dirs_cte()}
SELECT bucket, top, n_files, n_with_license, license_file_seen, license_file_detected, dominant FROM dirs""")
def dominant_license(spark, d):
    return scans.aggregate_dirs(I.scan_files(spark, d)).drop("first_ord")


@query("expression_histogram", f"""WITH {I.scan_cte()}
SELECT bucket, top, filtered AS expr, count(*) AS n_files FROM scan WHERE type = 'file' AND raw IS NOT NULL GROUP BY ALL""")
def expression_histogram(spark, d):
    return scans.expression_histogram(I.scan_files(spark, d))


@query("expression_map", f"""WITH {I.scan_cte()},
h AS (SELECT bucket, top, raw AS expr, count(*) AS n FROM scan WHERE type = 'file' AND raw IS NOT NULL GROUP BY ALL)
SELECT bucket, top, string_agg(expr || '=' || n, ';' ORDER BY expr) AS entries FROM h GROUP BY ALL""")
def expression_map(spark, d):
    maps = scans.histogram_map(scans.expression_histogram(I.scan_files(spark, d), filtered=False), ["bucket", "top"])
    entries = F.transform(F.array_sort(F.map_entries("expressions")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("bucket", "top", F.array_join(entries, ";").alias("entries"))


@query("top_score", f"WITH {I.scan_cte()} SELECT ord, path, CAST(score AS DOUBLE) AS top_score FROM scan")
def top_score(spark, d):
    return I.scan_files(spark, d).select("ord", "path", scans.top_score(F.col("detections")).alias("top_score"))


DECLARED = "CASE WHEN contains(path, 'ring') THEN NULL WHEN contains(path, 'bolt') THEN 'mit' ELSE 'Apache-2.0 AND ISC' END"


def declared_files(spark, d):
    p = F.col("path")
    return I.scan_files(spark, d).withColumn(
        "declared",
        F.when(F.contains(p, F.lit("ring")), F.lit(None).cast("string")).when(F.contains(p, F.lit("bolt")), F.lit("mit"))
        .otherwise(F.lit("Apache-2.0 AND ISC")),
    ).withColumn("top", paths.top_dir(p))


_DECL = f"s AS (SELECT *, {DECLARED} AS declared FROM scan)"
_CONF = f"raw IS NOT NULL AND declared IS NOT NULL AND {I.loose_sql('raw')} <> {I.loose_sql('declared')}"


@query("file_conflicts", f"""WITH {I.scan_cte()}, {_DECL}
SELECT bucket, ord, path, raw AS expr, declared FROM s WHERE type = 'file' AND {_CONF}""")
def file_conflicts(spark, d):
    return scans.file_conflicts(declared_files(spark, d)).select("bucket", "ord", "path", "expr", "declared")


@query("conflict_topk", f"""WITH {I.scan_cte()}, {_DECL}
SELECT path, ord, raw AS expr, CAST(score AS DOUBLE) AS top_score FROM s WHERE type = 'file' AND {_CONF} ORDER BY score DESC, path, ord LIMIT 100""")
def conflict_topk(spark, d):
    rows = scans.file_conflicts(declared_files(spark, d)).select(
        "path", "ord", "expr", scans.top_score(F.col("detections")).alias("top_score"))
    return rows.orderBy(F.desc("top_score"), "path", "ord").limit(100)


@query("conflicts", f"""WITH {I.scan_cte()}, {_DECL}
SELECT path, ord, raw AS expr, CAST(score AS DOUBLE) AS top_score FROM s WHERE type = 'file' AND {_CONF}""")
def conflicts(spark, d):
    """Every conflict in report order; conflict_topk is the view of the first hundred."""
    rows = scans.file_conflicts(declared_files(spark, d)).select(
        "path", "ord", "expr", scans.top_score(F.col("detections")).alias("top_score"))
    return rows.orderBy(F.desc("top_score"), "path", "ord")


@query("conflict_sample", f"""WITH {I.scan_cte()}, {_DECL}, c AS (SELECT path, ord, raw FROM s WHERE type = 'file' AND {_CONF}),
k AS (SELECT path || ': ' || raw AS line FROM c ORDER BY path, ord LIMIT 30)
SELECT line FROM k UNION ALL SELECT '... and ' || (count(*) - 30) || ' more' FROM c HAVING count(*) > 30""")
def conflict_sample(spark, d):
    rows = scans.file_conflicts(declared_files(spark, d)).select("path", "ord", "expr")
    return ordering.sample_with_rest(rows, ["path", "ord"], F.concat("path", F.lit(": "), "expr"), 30)


@query("scan_summary", f"""WITH {I.scan_cte()}, {_DECL}
SELECT bucket, top, count(*) AS n_files, count(*) FILTER ({_CONF}) AS n_conflicts, count(*) FILTER (raw IS NULL) AS n_no_license
FROM s WHERE type = 'file' GROUP BY ALL""")
def scan_summary(spark, d):
    return scans.scan_summary(declared_files(spark, d), ["bucket", "top"])


@query("scan_totals", f"""WITH {I.scan_cte()}, {_DECL}
SELECT count(*) AS n_files, count(*) FILTER ({_CONF}) AS n_conflicts, count(*) FILTER (raw IS NULL) AS n_no_license FROM s WHERE type = 'file'""")
def scan_totals(spark, d):
    return scans.scan_totals(scans.scan_summary(declared_files(spark, d), ["bucket", "top"]))


@query("bucket_rollup", f"""WITH {I.scan_cte()}, t AS (SELECT DISTINCT bucket, top FROM scan)
SELECT coalesce(bucket, 'Total') AS bucket, count(*) AS n_dirs FROM t GROUP BY ROLLUP (bucket)""")
def bucket_rollup(spark, d):
    dirs = I.scan_files(spark, d).select("bucket", paths.top_dir(F.col("path")).alias("top")).distinct()
    return scans.dirs_per_bucket(dirs)


@query("native_inventory", f"""WITH {I.scan_cte()},
n AS (SELECT bucket, CASE WHEN tail = 'README.md' THEN '(loose)' ELSE top END AS top FROM scan WHERE type = 'file' AND (lower(path) LIKE '%.rs' OR tail = 'README.md'))
SELECT bucket, top, count(*) AS n_native FROM n GROUP BY ALL""")
def native_inventory(spark, d):
    p = F.col("path")
    loose = F.endswith(p, F.lit("README.md"))
    files = I.scan_files(spark, d).withColumn("path", F.when(loose, F.concat(F.translate(p, "/", "-"), F.lit(".rs"))).otherwise(p))
    return scans.native_inventory(files, ".rs")


_MATCH = f"{I.scan_cte()}, {I.dirs_cte()}, {I.components_cte()}, {I.matched_cte()}"


def matched(spark, d):
    return matching.match_dirs(scans.aggregate_dirs(I.scan_files(spark, d)), parts(spark, d))


@query("bucket_scoped_match", f"WITH {_MATCH} SELECT bucket, top, is_matched AS matched, name, version, declared FROM matched")
def bucket_scoped_match(spark, d):
    return matched(spark, d).select("bucket", "top", "matched", "name", "version", "declared")


@query("unaccounted_anti", f"WITH {_MATCH} SELECT bucket, top, n_files, dominant FROM matched WHERE NOT is_matched")
def unaccounted_anti(spark, d):
    return matching.unaccounted(matched(spark, d)).select("bucket", "top", "n_files", "dominant")


@query("native_match", f"""WITH {I.scan_cte()}, {I.components_cte()},
dirs AS (SELECT 'python' AS bucket, top, count(*) AS n_native FROM scan WHERE type = 'file' AND lower(path) LIKE '%.rs' AND bucket = 'python' GROUP BY top), {I.matched_cte()}
SELECT top, n_native, name, version, declared FROM matched""")
def native_match(spark, d):
    """Native files per package directory next to their Python component, unmatched ones kept."""
    files = I.scan_files(spark, d).where(F.col("bucket") == "python")
    return matching.match_dirs(scans.native_inventory(files, ".rs"), parts(spark, d)).select(
        "top", "n_native", "name", "version", "declared")


_V, _T = verdict_sql("m.declared", "m.dominant")
_CLASSED = f"""{_MATCH}, {I.curation_cte()},
cl AS (SELECT m.bucket, m.top, m.name, m.version, m.declared, m.dominant AS detected, m.n_files, m.n_with_license, m.license_file_seen, cur.rationale,
  CASE WHEN NOT is_matched THEN 'UNACCOUNTED' WHEN cur.key IS NOT NULL THEN 'CURATED' ELSE {_V} END AS outcome,
  CASE WHEN is_matched AND cur.key IS NULL THEN {_T} END AS detail
  FROM matched m LEFT JOIN cur ON cur.key = m.name || '@' || m.version)"""


def classified(spark, d):
    return scan_diff.classify(I.scan_files(spark, d), parts(spark, d), I.curation(spark, d))


@query("scan_diff", f"WITH {_CLASSED} SELECT * FROM cl")
def scan_diff_query(spark, d):
    return classified(spark, d).drop("first_ord")


@query("verdict_counts", f"""WITH {_CLASSED},
v(verdict) AS (VALUES ('ACK'), ('MISMATCH'), ('NO-DETECTION'), ('CURATED'), ('UNACCOUNTED'))
SELECT verdict, count(outcome) AS n FROM v LEFT JOIN cl ON outcome = verdict GROUP BY verdict""")
def verdict_counts(spark, d):
    return scan_diff.summary(classified(spark, d))


@query("verdict_union", f"""WITH {_CLASSED}
SELECT (SELECT count(*) FROM dirs) AS n_dirs, count(*) FILTER (outcome NOT IN ('CURATED', 'UNACCOUNTED')) AS n_results,
  count(*) FILTER (outcome = 'CURATED') AS n_curated, count(*) FILTER (outcome = 'UNACCOUNTED') AS n_unaccounted FROM cl""")
def verdict_union(spark, d):
    """Every directory falls into exactly one of results, curated and unaccounted."""
    c = F.col("outcome")
    return classified(spark, d).agg(
        F.count(F.lit(1)).alias("n_dirs"), F.count_if(~c.isin("CURATED", "UNACCOUNTED")).alias("n_results"),
        F.count_if(c == "CURATED").alias("n_curated"), F.count_if(c == "UNACCOUNTED").alias("n_unaccounted"))


@query("scan_gate", f"WITH {_CLASSED} SELECT count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch, count(*) FILTER (outcome = 'MISMATCH') = 0 AS passes FROM cl")
def scan_gate(spark, d):
    return scan_diff.gate(classified(spark, d))


@query("mismatch_table", f"""WITH {_CLASSED}
SELECT bucket, name, top, '| ' || bucket || ' | `' || name || '` | `' || version || '` | `' || declared || '` | `' || detected || '` | ' ||
  CASE WHEN license_file_seen THEN '✓' ELSE '—' END || ' | ' || n_files || ' |' AS line FROM cl WHERE outcome = 'MISMATCH'""")
def mismatch_table(spark, d):
    return scan_diff.mismatch_rows(classified(spark, d)).orderBy("bucket", "name", "top")


@query("noise_listing", f"""WITH {_CLASSED},
u AS (SELECT bucket, top, n_files FROM cl WHERE outcome = 'UNACCOUNTED' AND NOT (top LIKE '%.dist-info' OR top LIKE '~%')),
k AS (SELECT '- `' || top || '` (' || bucket || ', ' || n_files || ' files)' AS line FROM u ORDER BY bucket, top LIMIT 30)
SELECT line FROM k UNION ALL SELECT '... and ' || (count(*) - 30) || ' more' FROM u HAVING count(*) > 30""")
def noise_listing(spark, d):
    """First 30 substantive unaccounted directories and a count of the rest."""
    rows = classified(spark, d).where((F.col("outcome") == "UNACCOUNTED") & ~paths.is_noise_dir(F.col("top")))
    rows = pin(rows.select("bucket", "top", "n_files"))  # the sample and the rest both read them
    line = F.concat(F.lit("- `"), F.col("top"), F.lit("` ("), F.col("bucket"), F.lit(", "), F.col("n_files").cast("string"), F.lit(" files)"))
    return ordering.sample_with_rest(rows, ["bucket", "top"], line, 30)


@query("report_sort", f"""WITH {I.components_cte()}
SELECT ord, row_number() OVER (ORDER BY lower(name), ord) AS place FROM comp WHERE category = 'AI Models'""")
def report_sort(spark, d):
    """Report order by lower-case name; places are counted per range, not in one task."""
    rows = flat(spark, d).where(F.col("category") == C.CAT_MODELS).select("ord", F.lower("name").alias("k"))
    return ordering.global_rank(rows, ["k", "ord"], "place").select("ord", "place")


@query("status_counts", f"""WITH {_CLASSED}, s AS (SELECT CASE outcome WHEN 'UNACCOUNTED' THEN 'unresolvable-source' WHEN 'CURATED' THEN 'skipped' WHEN 'NO-DETECTION' THEN 'unresolvable-license' ELSE 'enriched' END AS status FROM cl)
SELECT status, count(*) AS n FROM s GROUP BY status""")
def status_counts(spark, d):
    return counts.status_counts(statuses(spark, d))


def statuses(spark, d):
    o = F.col("outcome")
    return classified(spark, d).select(
        F.when(o == "UNACCOUNTED", "unresolvable-source").when(o == "CURATED", "skipped")
        .when(o == "NO-DETECTION", "unresolvable-license").otherwise("enriched").alias("status"),
        F.when(o == "ACK", "matched").otherwise("longest-file").alias("source_tag"),
    )


@query("skip_math", f"""WITH {_CLASSED}
SELECT count(*) AS total_in_sbom, count(*) AS processed, count(*) FILTER (outcome = 'CURATED') AS skipped,
  count(*) FILTER (outcome IN ('ACK', 'MISMATCH')) AS enriched, count(*) FILTER (outcome IN ('UNACCOUNTED', 'NO-DETECTION')) AS failed FROM cl""")
def skip_math(spark, d):
    return counts.skip_math(statuses(spark, d))


@query("source_tag_counts", f"""WITH {_CLASSED}
SELECT CASE outcome WHEN 'ACK' THEN 'matched' ELSE 'longest-file' END AS source_tag, count(*) AS n FROM cl WHERE outcome IN ('ACK', 'MISMATCH') GROUP BY 1""")
def source_tag_counts(spark, d):
    return counts.source_tag_counts(statuses(spark, d))


@query("drift_gate", f"""WITH {_CLASSED}
SELECT count(*) AS total, count(*) FILTER (NOT contains(detected, 'AND')) AS blocking,
  count(*) FILTER (contains(detected, 'AND')) AS multi_license_expected, count(*) FILTER (NOT contains(detected, 'AND')) = 0 AS may_publish
FROM cl WHERE outcome = 'MISMATCH'""")
def drift_gate(spark, d):
    rows = classified(spark, d).where(F.col("outcome") == "MISMATCH")
    return counts.drift_gate(rows.withColumn(
        "classification", F.when(F.contains("detected", F.lit("AND")), "multi-license-expected")))


@query("normalised_pairs", f"""WITH {_CLASSED}
SELECT bucket, top, {I.loose_sql('declared')} AS loose, {I.spdx_sql('declared')} AS canonical, {I.family_sql('detected')} AS family FROM cl WHERE declared IS NOT NULL""")
def normalised_pairs(spark, d):
    rows = classified(spark, d).where(F.col("declared").isNotNull())
    return rows.select(
        "bucket", "top", spdx.normalise_loose(F.col("declared")).alias("loose"),
        spdx.normalise_spdx(F.col("declared")).alias("canonical"), spdx.normalise_family(F.col("detected")).alias("family"))
