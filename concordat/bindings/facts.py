"""Queries over releases: hashes, notes, deltas, verdict history and errata."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat import constants as C
from concordat.bindings import inputs as I
from concordat.bindings.registry import query, table
from concordat.operators import releases as R
from concordat.sources import releases as S

HEX = "sha256(o_orderkey || '|')"


def _sha(*parts):
    return F.sha2(F.concat_ws("|", *parts, F.lit("")), 256)


def published(spark, d):
    """(tag, filename, sha256): one released file per order above a price."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").where("o_totalprice > 20000").select(
        F.concat(F.lit("t"), (k % 7).cast("string")).alias("tag"), F.concat(F.lit("f"), k.cast("string")).alias("filename"),
        F.when(F.col("o_orderstatus") == "F", _sha(F.col("o_custkey").cast("string"))).otherwise(_sha(k.cast("string"))).alias("sha256"))


_PUB = """pub AS (SELECT 't' || (o_orderkey % 7) AS tag, 'f' || o_orderkey AS filename,
  CASE WHEN o_orderstatus = 'F' THEN sha256(o_custkey || '|') ELSE sha256(o_orderkey || '|') END AS sha256 FROM orders WHERE o_totalprice > 20000)"""


@query("hash_verify", f"""WITH {_PUB},
loc AS (SELECT l_linenumber, l_partkey, 't' || (l_orderkey % 7) AS tag, 'f' || l_orderkey AS filename, upper(sha256(l_orderkey || '|')) AS sha256 FROM lineitem)
SELECT loc.filename, loc.l_linenumber, loc.l_partkey, CASE WHEN pub.sha256 IS NULL THEN 'unpublished' WHEN lower(loc.sha256) = pub.sha256 THEN 'match' ELSE 'mismatch' END AS outcome
FROM loc LEFT JOIN pub ON loc.tag = pub.tag AND loc.filename = pub.filename""")
def hash_verify(spark, d):
    k = F.col("l_orderkey")
    local = table(spark, d, "lineitem").select(
        "l_linenumber", "l_partkey", F.concat(F.lit("t"), (k % 7).cast("string")).alias("tag"),
        F.concat(F.lit("f"), k.cast("string")).alias("filename"), F.upper(_sha(k.cast("string"))).alias("sha256"))
    return R.verify_hashes(local, published(spark, d)).select("filename", "l_linenumber", "l_partkey", "outcome")


def checksum_lines(spark, d):
    """Orders as lines of checksum lists, some of them malformed."""
    k = F.col("o_orderkey")
    entry = F.concat(_sha(k.cast("string")), F.lit(" *f"), k.cast("string"))
    line = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("# "), entry)).otherwise(entry)
    return table(spark, d, "orders").select(F.concat(F.lit("t"), (k % 7).cast("string")).alias("tag"), line.alias("value"))


_SUMS = f"sums AS (SELECT 't' || (o_orderkey % 7) AS tag, 'f' || o_orderkey AS filename, {HEX} AS sha256 FROM orders WHERE o_orderpriority <> '5-LOW')"


@query("checksum_lines", f"WITH {_SUMS} SELECT * FROM sums")
def checksum_lines_query(spark, d):
    return S.parse_checksums(checksum_lines(spark, d)).select("tag", "filename", "sha256")


@query("checksum_consistency", f"""WITH {_PUB}, {_SUMS}
SELECT coalesce(pub.tag, sums.tag) AS tag, coalesce(pub.filename, sums.filename) AS filename, pub.sha256 AS json_sha256, sums.sha256 AS list_sha256
FROM pub FULL JOIN sums ON pub.tag = sums.tag AND pub.filename = sums.filename WHERE pub.sha256 IS DISTINCT FROM sums.sha256""")
def checksum_consistency(spark, d):
    sums = S.parse_checksums(checksum_lines(spark, d))
    return R.checksum_differences(published(spark, d), sums)


NOTE_FIELDS = ("Tag date", "Depot", "Components")


@query("release_notes", """
SELECT 'r' || o_orderkey AS tag, strftime(o_orderdate, '%Y-%m-%d') AS tag_date, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS depot,
  o_custkey * 1000 AS n_components FROM orders""")
def release_notes(spark, d):
    """Notes built line by line from orders, in table or bullet form, parsed and pivoted back."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = F.when(k % 2 == 0, F.array(
        F.lit("| Field | Value |"), F.lit("|-------|-------|"), F.concat(F.lit("| Tag date   | "), day, F.lit(" |")),
        F.concat(F.lit("| Depot | "), cust.cast("string"), F.lit(" |")),
        F.concat(F.lit("| Components | "), cust.cast("string"), F.lit(",000 (unchanged from x) |")), F.lit("plain text"),
    )).otherwise(F.array(
        F.concat(F.lit("- **Tag date:** "), day), F.concat(F.lit("- **Components:** "), cust.cast("string"), F.lit(",000 (1.x)")),
        F.lit("- plain bullet"),
    ))
    lines = table(spark, d, "orders").select(F.concat(F.lit("r"), k.cast("string")).alias("tag"), F.explode(rows).alias("value"))
    wide = S.pivot_notes(S.parse_note_fields(lines), ["tag"], NOTE_FIELDS)
    return wide.select("tag", "tag_date", "depot", S.component_count(F.col("components")).alias("n_components"))


@query("release_delta", """
WITH r AS (SELECT o_orderkey, 'r' || o_orderkey AS tag, o_custkey % 9 AS components,
  lag('r' || o_orderkey) OVER w AS prev_tag, o_custkey % 9 - lag(o_custkey % 9) OVER w AS delta FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey))
SELECT tag, prev_tag, delta, coalesce(delta = 0, false) AS unchanged FROM r""")
def release_delta(spark, d):
    return releases_in_order(spark, d)


def releases_in_order(spark, d, small_groups=True):
    o = table(spark, d, "orders").select(
        "o_orderdate", "o_orderkey", F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("tag"),
        (F.col("o_custkey") % 9).alias("components"))
    return R.component_delta(o, ["o_orderdate", "o_orderkey"], small_groups).select("tag", "prev_tag", "delta", "unchanged")


@query("release_delta_ranged", """
WITH r AS (SELECT 'r' || o_orderkey AS tag, lag('r' || o_orderkey) OVER w AS prev_tag,
  o_custkey % 9 - lag(o_custkey % 9) OVER w AS delta FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey))
SELECT tag, prev_tag, delta, coalesce(delta = 0, false) AS unchanged FROM r""")
def release_delta_ranged(spark, d):
    """The same history forced through the range-cut path used for histories too long for one task."""
    return releases_in_order(spark, d, small_groups=False)


_CATS = ", ".join(f"count(*) FILTER (category = '{c}') AS {c.replace('-', '_')}" for c in C.AV_CATEGORIES)


@query("verdict_pivot", f"WITH {I.verdicts_cte()} SELECT filename, engine, {_CATS} FROM v GROUP BY filename, engine")
def verdict_pivot(spark, d):
    return R.verdict_pivot(I.verdicts(spark, d), ["filename", "engine"])


@query("verdict_reconcile", f"""WITH {I.verdicts_cte()},
c AS (SELECT filename, category, count(*) AS counted FROM v GROUP BY ALL),
s AS (SELECT filename, category, count(*) FILTER (engine <> 'engine3') + count(*) FILTER (category = 'malicious') * 0 AS stored FROM v GROUP BY ALL)
SELECT filename, category, counted, stored, counted = stored AS agrees FROM c JOIN s USING (filename, category)""")
def verdict_reconcile(spark, d):
    """Stored counters that leave out one engine disagree exactly for that engine's files."""
    v = I.verdicts(spark, d)
    stats = v.groupBy("filename", "category").agg(F.count_if(F.col("engine") != "engine3").alias("stored"))
    return R.verdict_reconcile(v, stats, ["filename"])


_RETRO = f"""WITH {I.verdicts_cte()},
l AS (SELECT *, lag(category) OVER (PARTITION BY sha256, engine ORDER BY fetched_at, event_id) AS prev_category FROM v)
SELECT event_id, sha256, engine, category, prev_category FROM l WHERE category = 'malicious' AND prev_category <> 'malicious'"""


@query("retro_flag", _RETRO)
def retro_flag(spark, d):
    return R.retro_flags(I.verdicts(spark, d), ["sha256", "engine"], ["fetched_at", "event_id"]).select(
        "event_id", "sha256", "engine", "category", "prev_category")


@query("retro_flag_ranged", _RETRO)
def retro_flag_ranged(spark, d):
    """Retro flags through the range-cut path used when one binary holds a large share of rows."""
    return R.retro_flags(
        I.verdicts(spark, d), ["sha256", "engine"], ["fetched_at", "event_id"], small_groups=False,
    ).select("event_id", "sha256", "engine", "category", "prev_category")


@query("daily_flags", f"""WITH {I.verdicts_cte()}
SELECT strftime(date_trunc('day', fetched_at), '%Y-%m-%d') AS day, filename, count(*) FILTER (category = 'malicious') AS n_flagged, count(*) AS n_verdicts
FROM v GROUP BY 1, 2""")
def daily_flags(spark, d):
    return R.daily_flags(I.verdicts(spark, d)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("errata_overlay", """
WITH p AS (SELECT 'p' || l_partkey AS name, l_orderkey AS release_seq, l_linenumber, l_suppkey, l_returnflag AS license FROM lineitem),
e AS (SELECT 'p' || p_partkey AS name, 'fixed-' || p_brand AS corrected, p_size * 100 AS lo_seq, p_size * 300 AS hi_seq FROM part WHERE p_size > 10)
SELECT p.name, p.release_seq, p.l_linenumber, p.l_suppkey, p.license, coalesce(e.corrected, p.license) AS effective_license, e.corrected IS NOT NULL AS corrected
FROM p LEFT JOIN e ON p.name = e.name AND p.release_seq BETWEEN e.lo_seq AND e.hi_seq""")
def errata_overlay(spark, d):
    pub = table(spark, d, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("name"), F.col("l_orderkey").alias("release_seq"),
        "l_linenumber", "l_suppkey", F.col("l_returnflag").alias("license"))
    errata = table(spark, d, "part").where("p_size > 10").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("name"), F.concat(F.lit("fixed-"), "p_brand").alias("corrected"),
        (F.col("p_size") * 100).alias("lo_seq"), (F.col("p_size") * 300).alias("hi_seq"))
    return R.apply_errata(pub, errata)


@query("verdict_documents", f"""WITH {I.verdicts_cte()}
SELECT filename, category || '#' || event_id AS engine, strftime(date_trunc('day', fetched_at), '%Y-%m-%d') AS day, engine AS result, strftime(fetched_at, '%Y%m%d') AS engine_update FROM v""")
def verdict_documents(spark, d):
    """Every event packed into verdict documents (engine-keyed maps) and exploded again.

    An entry's key holds the number of its event, so none replaces another; a document takes 64 numbers at most, however hot its file.
    """
    v = I.verdicts(spark, d).withColumn("day", F.date_format("fetched_at", "yyyy-MM-dd")).withColumn(
        "key", F.concat("category", F.lit("#"), F.col("event_id").cast("string")))
    entry = F.struct(
        F.lit("blacklist").alias("method"), F.col("category").alias("engine_name"), F.lit(None).cast("string").alias("engine_version"),
        F.date_format("fetched_at", "yyyyMMdd").alias("engine_update"), F.lit("undetected").alias("category"), F.col("engine").alias("result"))
    docs = v.groupBy("filename", "day", F.floor(F.col("event_id") / 64).alias("part")).agg(
        F.map_from_entries(F.collect_list(F.struct("key", entry.alias("e")))).alias("last_analysis_results")
    ).select(F.lit("t").alias("tag"), "filename", F.lit("x").alias("sha256"),
             F.concat("day", F.lit("T00:00:00Z")).alias("fetched_at"), "last_analysis_results")
    out = S.explode_verdicts(docs)
    return out.select("filename", "engine", F.date_format("fetched_at", "yyyy-MM-dd").alias("day"), "result",
                      F.date_format("engine_update", "yyyyMMdd").alias("engine_update"))
