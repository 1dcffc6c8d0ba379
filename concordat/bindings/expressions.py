"""Queries over licence expressions, components and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat import constants as C
from concordat.bindings import inputs as I
from concordat.bindings.registry import query, table
from concordat.functions import components as P
from concordat.functions import paths, spdx, urls
from concordat.functions import text as T
from concordat.operators import curation as cur
from concordat.operators import matching, upstream
from concordat.operators.counts import verdict_counts
from concordat.operators.ordering import first_wins
from concordat.sources import archives
from concordat.sources.inventory import flatten
from concordat.sources.sinks import audit_lines

EXPR = I.expression_sql("o_orderkey")


def expressions(spark, d):
    """(key, cust, raw): a licence expression per order."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust"))
    return I.with_expression(o, F.col("key"), "raw")


@query("spdx_split", f"""
SELECT key, CAST(pos - 1 AS INTEGER) AS pos, ids[pos] AS spdx_id FROM (
  SELECT key, ids, unnest(range(1, len(ids) + 1)) AS pos FROM (
    SELECT o_orderkey AS key,
      list_filter(list_transform(regexp_split_to_array(translate({EXPR}, '()', '  '), '(?i)\\s+(?:AND|OR)\\s+'),
        lambda t: trim(t)), lambda t: t <> '') AS ids
    FROM orders))""")
def spdx_split(spark, d):
    o = expressions(spark, d)
    return o.select("key", F.posexplode(spdx.split_expression(F.col("raw"))).alias("pos", "spdx_id"))


@query("spdx_normalize", f"""
WITH e AS (SELECT o_orderkey AS key, ' ' || replace({EXPR}, '-', CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '_' END) AS x FROM orders)
SELECT key, {I.loose_sql('x')} AS loose, {I.spdx_sql('x')} AS canonical, {I.family_sql('x')} AS family FROM e""")
def spdx_normalize(spark, d):
    dash = F.when(F.col("key") % 2 == 0, "-").otherwise("_")
    x = F.concat(F.lit(" "), F.replace("raw", F.lit("-"), dash))
    return expressions(spark, d).select("key", x.alias("x")).select(
        "key", spdx.normalise_loose(F.col("x")).alias("loose"), spdx.normalise_spdx(F.col("x")).alias("canonical"),
        spdx.normalise_family(F.col("x")).alias("family"),
    )


@query("fp_filter", f"WITH {I.fp_cte('orders', 'o_orderkey', EXPR)} SELECT key, filtered FROM fp")
def fp_filter(spark, d):
    return expressions(spark, d).select("key", spdx.filter_false_positives(F.col("raw")).alias("filtered"))


def verdict_sql(declared: str, detected: str) -> tuple[str, str]:
    want = I.spdx_sql(detected)

    def agrees(sep: str) -> str:
        inner = I.spdx_sql("trim(trim(t), '()')")
        return f"(contains({declared}, '{sep}') AND list_contains(list_transform(string_split({declared}, '{sep}'), lambda t: {inner}), {want}))"

    q = lambda e: f"'''' || {e} || ''''"
    tests = [f"{detected} = ''", f"{I.spdx_sql(declared)} = {want}", agrees(" OR "), agrees(" AND ")]
    v = (f"CASE WHEN {tests[0]} THEN 'NO-DETECTION' WHEN {tests[1]} OR {tests[2]} OR {tests[3]} THEN 'ACK' "
         f"ELSE 'MISMATCH' END")
    t = f"""CASE WHEN {tests[0]} THEN 'no detectable license in source'
      WHEN {tests[1]} THEN 'declared=' || {q(declared)} || ' matches detected=' || {q(detected)}
      WHEN {tests[2]} THEN 'detected ' || {q(detected)} || ' is one of the declared alternatives in ' || {q(declared)}
      WHEN {tests[3]} THEN 'detected ' || {q(detected)} || ' is one component of declared composite ' || {q(declared)}
      ELSE 'declared=' || {q(declared)} || ' vs detected=' || {q(detected)} END"""
    return v, t


_V, _T = verdict_sql("f.raw", "g.filtered")


@query("classify_verdict", f"""
WITH {I.fp_cte('orders', 'o_orderkey', I.expression_sql('o_orderkey + o_custkey % 3'))},
{I.fp_cte('orders', 'o_orderkey', EXPR, 'fp2')}
SELECT f.key, {_V} AS verdict, {_T} AS detail FROM fp2 f JOIN fp g ON f.key = g.key""")
def classify_verdict(spark, d):
    other = I.with_expression(expressions(spark, d), F.col("key") + F.col("cust") % 3, "other")
    v = other.select(
        "key", F.col("raw").alias("declared"), spdx.filter_false_positives(F.col("other")).alias("detected"))
    return v.withColumn("v", spdx.verdict(F.col("declared"), F.col("detected"))).select("key", "v.verdict", "v.detail")


# --- components --------------------------------------------------------------
def flat(spark, d):
    return flatten(I.components(spark, d))


@query("component_fields", f"""WITH {I.components_cte()}
SELECT ord, name, version, purl, prefix, category, depot, homepage, vcs, kind, value, declared, recorded, first_license FROM comp""")
def component_fields(spark, d):
    return flat(spark, d).select(
        "ord", "name", "version", "purl", "prefix", "category", "depot", "homepage", "vcs",
        F.col("info.kind").alias("kind"), F.col("info.value").alias("value"), "declared", "recorded", "first_license",
    )


def _enc(e: str) -> str:
    return f"replace(url_encode({e}), '%2F', '/')"


TOOLS_SQL = """tools AS (SELECT DISTINCT name || '@' || version AS key FROM comp WHERE category = 'System Tools' AND depot = 'app')"""


def tool_map(spark, d):
    """(key, tool): system-tool parts of the app depot have a curated archive."""
    rows = flat(spark, d).where((F.col("category") == C.CAT_SYSTEM) & (F.col("depot") == "app"))
    return rows.select(
        P.component_key(F.col("name"), F.col("version")).alias("key"),
        F.struct(
            F.concat(F.lit("https://src.example.org/"), F.translate("name", " ", "-"), F.lit(".tar.gz")).alias("source_tarball"),
            F.concat("name", F.lit("/")).alias("tarball_root_prefix"),
        ).alias("tool"),
    ).distinct()


@query("source_plan", f"""WITH {I.components_cte()}, {TOOLS_SQL},
c AS (SELECT comp.*, tools.key IS NOT NULL AS has_tool, {_enc('name')} AS qn, {_enc('version')} AS qv,
  regexp_extract(homepage, '^https?://huggingface\\.co/([^/]+)/([^/?#]+)', 1) AS ho, regexp_extract(homepage, '^https?://huggingface\\.co/([^/]+)/([^/?#]+)', 2) AS hr,
  regexp_extract(homepage, '^https?://github\\.com/([^/]+)/([^/?#]+)', 1) AS go, regexp_extract(homepage, '^https?://github\\.com/([^/]+)/([^/?#]+)', 2) AS gr,
  coalesce(nullif(regexp_extract(homepage, '/tree/([^/?#]+)', 1), ''), version) AS gv
  FROM comp LEFT JOIN tools ON tools.key = name || '@' || version)
SELECT ord,
  CASE category WHEN 'Rust Crates' THEN 'tarball' WHEN 'NPM Packages' THEN 'npm-via-metadata' WHEN 'Python Packages' THEN 'pypi-via-metadata'
    WHEN 'AI Models' THEN CASE WHEN ho <> '' THEN 'hf-probe' ELSE 'none' END
    WHEN 'ComfyUI Nodes' THEN CASE WHEN go <> '' THEN 'gh-raw-probe' ELSE 'none' END
    WHEN 'System Tools' THEN CASE WHEN has_tool THEN 'system-curated' ELSE 'none' END ELSE 'none' END AS kind,
  CASE category WHEN 'Rust Crates' THEN 'https://crates.io/api/v1/crates/' || qn || '/' || qv || '/download'
    WHEN 'System Tools' THEN CASE WHEN has_tool THEN 'https://src.example.org/' || replace(name, ' ', '-') || '.tar.gz' END END AS url,
  CASE category WHEN 'NPM Packages' THEN 'https://registry.npmjs.org/' || CASE WHEN name LIKE '@%' THEN replace(name, '/', '%2F') ELSE name END || '/' || qv
    WHEN 'Python Packages' THEN 'https://pypi.org/pypi/' || qn || '/' || qv || '/json' END AS metadata_url,
  CASE category WHEN 'Rust Crates' THEN name || '-' || version || '/' WHEN 'NPM Packages' THEN 'package/'
    WHEN 'System Tools' THEN CASE WHEN has_tool THEN name || '/' END END AS path_prefix,
  CASE WHEN category = 'AI Models' AND ho <> '' THEN 'https://huggingface.co/' || ho || '/' || hr || '/resolve/' || version
    WHEN category = 'ComfyUI Nodes' AND go <> '' THEN 'https://raw.githubusercontent.com/' || go || '/' || gr || '/' || gv END AS base_url,
  CASE WHEN category = 'AI Models' AND ho = '' THEN 'HF URL not parseable: ' || homepage
    WHEN category = 'ComfyUI Nodes' AND go = '' THEN 'GitHub URL not parseable: ' || homepage
    WHEN category = 'System Tools' AND NOT has_tool THEN 'No curation entry for ' || name || '@' || version
    WHEN category = 'Mystery' THEN 'Unknown category: Mystery' END AS reason
FROM c""")
def source_plan(spark, d):
    from concordat.plans.enrichment import plan_sources

    planned = plan_sources(flat(spark, d), tool_map(spark, d))
    return planned.select("ord", *[f"plan.{f}" for f in ("kind", "url", "metadata_url", "path_prefix", "base_url", "reason")])


@query("system_tool_lookup", f"""WITH {I.components_cte()}, {TOOLS_SQL}
SELECT ord, tools.key IS NOT NULL AS has_tool FROM comp LEFT JOIN tools ON tools.key = name || '@' || version""")
def system_tool_lookup(spark, d):
    return cur.with_tool(flat(spark, d), tool_map(spark, d)).select("ord", F.col("tool").isNotNull().alias("has_tool"))


@query("category_filter", f"""WITH {I.components_cte()}
SELECT depot, count(*) AS n, count(DISTINCT (name, version)) AS n_pairs FROM comp
WHERE category = 'AI Models' AND name <> '' AND version <> '' GROUP BY depot""")
def category_filter(spark, d):
    rows = flat(spark, d).where((F.col("category") == C.CAT_MODELS) & (F.col("name") != "") & (F.col("version") != ""))
    return rows.groupBy("depot").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("name", "version").alias("n_pairs"))


@query("proprietary_skip", f"""WITH {I.components_cte()}
SELECT ord, kind = 'name' AND contains(value, 'LicenseRef-') AS skipped FROM comp""")
def proprietary_skip(spark, d):
    return flat(spark, d).select("ord", P.is_proprietary(F.col("info")).alias("skipped"))


@query("first_wins", f"""WITH {I.components_cte()}
SELECT name, ord, version, declared FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord) AS rn FROM comp) WHERE rn = 1""")
def first_wins_query(spark, d):
    return first_wins(flat(spark, d).select("name", "ord", "version", "declared"), ["name"], ["ord"])


@query("declared_by_name", f"""WITH {I.components_cte()},
f AS (SELECT name, CASE declared WHEN 'Custom AND Zlib' THEN 'Zlib' WHEN 'LicenseRef-Proprietary' THEN NULL ELSE first_license END AS declared
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord) AS rn FROM comp) WHERE rn = 1)
SELECT comp.ord, f.declared FROM comp JOIN f ON comp.name = f.name""")
def declared_by_name(spark, d):
    c = flat(spark, d).select("name", "ord", F.col("scan_license").alias("declared"))
    return c.select("name", "ord").join(matching.declared_by_name(c), "name").select("ord", "declared")


@query("curation_override", f"""WITH {I.components_cte()}, {I.curation_cte()}
SELECT ord, cur.key IS NOT NULL AS curated, rationale FROM comp LEFT JOIN cur ON cur.key = name || '@' || version""")
def curation_override(spark, d):
    c = flat(spark, d).select("ord", "name", "version")
    return cur.with_curation(c, I.curation(spark, d)).select("ord", "curated", "rationale")


@query("curation_anti", f"""WITH {I.components_cte()}, {I.curation_cte()}
SELECT ord, name, version FROM comp WHERE name || '@' || version NOT IN (SELECT key FROM cur)""")
def curation_anti(spark, d):
    c = flat(spark, d).select("ord", "name", "version")
    return cur.without_curated(c, I.curation(spark, d)).select("ord", "name", "version")


# --- urls and keys -----------------------------------------------------------
_URL = """CASE WHEN page_id % 4 = 0 THEN url
  WHEN page_id % 4 = 1 THEN regexp_replace(url, '^https?://[^/]+/', 'https://github.com/')
  WHEN page_id % 4 = 2 THEN regexp_replace(url, '^https?://[^/]+/[^/]+', 'https://huggingface.co')
  ELSE regexp_replace(url, '^https?://[^/]+/', 'https://huggingface.co/') END"""


def _repo_sql(host: str) -> str:
    tail = f"rtrim(regexp_extract(u, '{host}/([^?#]*)', 1), '/')"
    parts = f"string_split({tail}, '/')"
    return f"CASE WHEN contains(u, '{host}/') AND len({parts}) >= 2 THEN {parts}[1] || '/' || {parts}[2] END"


@query("url_repo_id", f"""WITH p AS (SELECT page_id, {_URL} AS u FROM pages)
SELECT page_id, {_repo_sql('huggingface.co')} AS hub_repo, {_repo_sql('github.com')} AS git_repo,
  nullif(regexp_extract(u, '^https?://github\\.com/([^/]+)/([^/?#]+)', 2), '') AS git_name FROM p""")
def url_repo_id(spark, d):
    k, u = F.col("page_id") % 4, F.col("url")
    url = (
        F.when(k == 0, u)
        .when(k == 1, F.regexp_replace(u, "^https?://[^/]+/", "https://github.com/"))
        .when(k == 2, F.regexp_replace(u, "^https?://[^/]+/[^/]+", "https://huggingface.co"))
        .otherwise(F.regexp_replace(u, "^https?://[^/]+/", "https://huggingface.co/"))
    )
    return table(spark, d, "pages").select("page_id", url.alias("u")).select(
        "page_id", urls.hub_repo_id(F.col("u")).alias("hub_repo"), urls.git_repo_id(F.col("u")).alias("git_repo"),
        urls.git_parts(F.col("u"))[1].alias("git_name"),
    )


@query("content_key", "SELECT page_id, sha256(url || '|' || page_id || '|' || html) AS key FROM pages")
def content_key(spark, d):
    return table(spark, d, "pages").select(
        "page_id", T.content_key(F.col("url"), F.col("page_id").cast("string"), F.col("html")).alias("key")
    )


@query("registry_archive_url", """
WITH r AS (SELECT o_orderkey, 'https://files.example.org/' || o_custkey || '/' || o_orderkey AS base FROM orders),
u AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN base || '-b.tar.gz' WHEN o_orderkey % 2 = 0 THEN base || '-a.tar.gz'
    WHEN o_orderkey % 3 = 0 THEN base || '-a.whl' WHEN o_orderkey % 7 = 0 THEN base || '-b.whl' END AS url FROM r)
SELECT o_orderkey, url, CASE WHEN url LIKE '%.whl' THEN 'zip' WHEN url IS NOT NULL THEN 'tar.gz' END AS format FROM u""")
def registry_archive_url(spark, d):
    """Each order as one registry record listing up to five uploads."""
    k = F.col("o_orderkey")
    base = F.concat(F.lit("https://files.example.org/"), F.col("o_custkey").cast("string"), F.lit("/"), k.cast("string"))

    def upload(test, kind, tail):
        return F.when(test, F.struct(F.lit(kind).alias("packagetype"), F.concat(base, F.lit(tail)).alias("url")))

    uploads = F.filter(F.array(
        upload(k % 3 == 0, "bdist_wheel", "-a.whl"), upload(k % 2 == 0, "sdist", "-a.tar.gz"),
        upload(k % 4 == 1, "bdist_egg", ".egg"), upload(k % 7 == 0, "bdist_wheel", "-b.whl"),
        upload(k % 5 == 0, "sdist", "-b.tar.gz"),
    ), lambda u: u.isNotNull())
    meta = table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct(uploads.alias("urls"))).alias("meta"))
    url = archives.pypi_archive_url(F.col("meta"))
    return meta.select("o_orderkey", url.alias("url")).withColumn(
        "format", F.when(F.col("url").isNotNull(), archives.archive_format(F.col("url")))
    )


@query("path_predicates", f"""
WITH {I.scan_cte()},
p AS (SELECT top, CASE WHEN ord % 5 = 0 THEN path || '.d/COPYING-x' WHEN ord % 5 = 1 THEN replace(path, 'README.md', 'NOTICE_2') ELSE path END AS path FROM scan)
SELECT top, top LIKE '%.dist-info' AS noise, count(*) AS n,
  count(*) FILTER (regexp_matches(path, '(?i)(^|/)(LICEN[SC]E|COPYING|NOTICE|COPYRIGHT)([._-]\\S*)?$')) AS n_license_like,
  count(*) FILTER (list_contains({I._sql_list(C.ROOT_LICENCE_NAMES)}, lower(string_split(path, '/')[-1])) AND len(string_split(path, '/')) <= 3) AS n_root,
  count(*) FILTER (regexp_matches(path, '(?i)\\.({'|'.join(C.SOURCE_EXTENSIONS)})$')) AS n_source
FROM p GROUP BY top""")
def path_predicates(spark, d):
    k, path = F.col("ord") % 5, F.col("path")
    p = F.when(k == 0, F.concat(path, F.lit(".d/COPYING-x"))).when(
        k == 1, F.replace(path, F.lit("README.md"), F.lit("NOTICE_2"))).otherwise(path)
    rows = I.scan_files(spark, d).select(paths.top_dir(path).alias("top"), p.alias("path"))
    return rows.groupBy("top").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(paths.is_licence_file(F.col("path"))).alias("n_license_like"),
        F.count_if(paths.is_root_licence(F.col("path"))).alias("n_root"),
        F.count_if(paths.is_source_file(F.col("path"))).alias("n_source"),
    ).withColumn("noise", paths.is_noise_dir(F.col("top")))


@query("partition_safe_name", f"""WITH {I.components_cte()}
SELECT replace(replace(name, '/', '_'), ' ', '_') AS safe, count(*) AS n FROM comp GROUP BY 1""")
def partition_safe_name(spark, d):
    return flat(spark, d).groupBy(T.partition_safe(F.col("name")).alias("safe")).agg(F.count(F.lit(1)).alias("n"))


# --- upstream ----------------------------------------------------------------
_CARDS = """CASE key % 5 WHEN 0 THEN 'apache-2.0' WHEN 1 THEN 'mit | isc' WHEN 2 THEN NULL WHEN 3 THEN 'MIT' ELSE NULL END"""


def landed_lookups(spark, d):
    """readmes, hub cards and git licences with one row per repository, keyed off customers."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_acctbal")
    slug = F.concat(F.lit("repo"), F.col("key").cast("string"))
    k = F.col("key") % 5
    readmes = c.select(
        F.concat(F.lit("mirror/"), slug).alias("repo_id"),
        F.when(F.col("key") % 4 == 0, F.concat(F.lit("intro\n# Mirror of  up/"), slug, F.lit("\n")))
        .when(F.col("key") % 4 == 2, F.concat(F.lit("| Upstream | [up/"), slug, F.lit("](https://x) |")))
        .otherwise(F.concat(F.lit("Upstream up/"), slug)).alias("text"),
    )
    cards = c.select(
        F.concat(F.lit("up/"), slug).alias("repo_id"),
        F.when(k == 0, '{"cardData":{"license":"apache-2.0"}}')
        .when(k == 1, '{"cardData":{"license":["mit","isc"]}}')
        .when(k == 2, '{"cardData":{"license":[]}}')
        .when(k == 3, '{"cardData":{"license":"MIT"}}')
        .otherwise(F.lit(None).cast("string")).alias("card_json"),
        F.when(k == 4, "HTTP 404").alias("error"),
    )
    git = c.where(F.col("c_acctbal") > 0).select(
        F.concat(F.lit("org/"), slug).alias("repo_id"),
        F.when(F.col("key") % 7 > 1, "Apache-2.0").when(F.col("key") % 7 == 1, "").alias("spdx_id"),
        F.when(F.col("key") % 7 == 0, "HTTP 403").alias("error"),
    )
    return readmes, cards, git


@query("readme_upstream", """
SELECT 'mirror/repo' || c_custkey AS repo_id, CASE WHEN c_custkey % 2 = 0 THEN 'up/repo' || c_custkey END AS upstream FROM customer""")
def readme_upstream(spark, d):
    from concordat.functions.evidence import upstream_from_readme

    readmes, _, _ = landed_lookups(spark, d)
    return readmes.select("repo_id", upstream_from_readme(F.col("text")).alias("upstream"))


@query("card_licence", f"""
WITH c AS (SELECT c_custkey AS key FROM customer) SELECT 'up/repo' || key AS repo_id, {_CARDS} AS license FROM c""")
def card_licence(spark, d):
    from concordat.functions.evidence import card_licence as fn

    _, cards, _ = landed_lookups(spark, d)
    return cards.select("repo_id", fn(F.col("card_json")).alias("license"))


@query("hub_licence", f"""
WITH {I.components_cte()}
SELECT ord, first_license AS recorded, CASE first_license WHEN 'MIT' THEN 'mit' WHEN 'GPL-3.0' THEN 'gpl-3.0' WHEN 'Apache-2.0' THEN 'apache-2.0' END AS hub
FROM comp WHERE first_license IS NOT NULL""")
def hub_licence(spark, d):
    c = flat(spark, d).where(F.col("first_license").isNotNull())
    return c.select("ord", F.col("first_license").alias("recorded"), spdx.hub_licence(F.col("first_license")).alias("hub"))


_LADDER = f"""
WITH a AS (SELECT o_orderkey AS ord, o_custkey AS key, (['Apache-2.0', 'mit', 'MIT | ISC', '(none)'])[CAST(o_orderkey % 4 AS INTEGER) + 1] AS recorded,
  o_orderkey % 3 AS m, o_orderpriority = '1-URGENT' AS curated, coalesce(c_acctbal > 0, false) AS git_known FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
b AS (SELECT *, {_CARDS} AS card0,
  CASE WHEN m = 0 AND key % 2 = 0 THEN 1 WHEN m = 1 THEN 1 ELSE 0 END AS has_up,
  m <> 1 AS has_git FROM a),
c AS (SELECT *, CASE WHEN has_up = 1 THEN card0 END AS card FROM b),
v AS (SELECT ord, CASE WHEN curated OR has_up = 0 THEN NULL ELSE 'up/repo' || key END AS upstream_repo,
  CASE WHEN curated THEN 'CURATED'
    WHEN card IS NOT NULL THEN CASE WHEN {I.loose_sql('recorded')} = {I.loose_sql('card')} THEN 'ACK' ELSE 'MISMATCH' END
    WHEN has_git THEN CASE WHEN NOT git_known OR key % 7 <= 1 THEN 'UNKNOWN' WHEN recorded = 'Apache-2.0' THEN 'ACK' ELSE 'MISMATCH' END
    ELSE 'UNKNOWN' END AS verdict,
  CASE WHEN curated THEN 'sbom_drift_curation.json: order ' || ord
    WHEN card IS NOT NULL THEN CASE WHEN {I.loose_sql('recorded')} = {I.loose_sql('card')} THEN 'upstream HF publisher declares ''' || card || ''''
      ELSE 'recorded=''' || recorded || ''' vs upstream declares ''' || card || '''' END
    WHEN has_git THEN CASE WHEN NOT git_known THEN 'github license API: not landed' WHEN key % 7 = 0 THEN 'github license API: HTTP 403'
      WHEN key % 7 = 1 THEN 'github license API returned no SPDX id'
      WHEN recorded = 'Apache-2.0' THEN 'github canonical LICENSE = ''Apache-2.0''' ELSE 'recorded=''' || recorded || ''' vs github LICENSE = ''Apache-2.0''' END
    ELSE 'no documented upstream and no usable fallback' END AS detail, recorded, key, m FROM c)"""


@query("upstream_ladder", _LADDER + " SELECT ord, upstream_repo, verdict, detail FROM v")
def upstream_ladder(spark, d):
    return audited(spark, d).select("ord", "upstream_repo", "verdict", "detail")


@query("audit_report", _LADDER + f""" SELECT ord, '{'─' * 75}' || chr(10) || 'COMPONENT:   model' || ord || chr(10) || 'PIN:         1' || chr(10) || 'RECORDED:    ' || recorded || chr(10)
  || 'HOMEPAGE:    ' || CASE WHEN m = 0 THEN 'https://huggingface.co/mirror/repo' || key ELSE '' END || chr(10)
  || CASE WHEN upstream_repo IS NOT NULL THEN 'DOC_UPSTREAM:' || upstream_repo || chr(10) ELSE '' END
  || 'VERDICT:     ' || verdict || chr(10) || 'DETAIL:      ' || detail AS line FROM v""")
def audit_report(spark, d):
    return audit_lines(audited(spark, d)).select(
        F.regexp_extract("at", r"(\d+)$", 1).cast("bigint").alias("ord"), "line")


@query("audit_counts", _LADDER + """, k(verdict) AS (VALUES ('ACK'), ('MISMATCH'), ('UNKNOWN'), ('CURATED'))
SELECT k.verdict, count(v.verdict) AS n FROM k LEFT JOIN v ON v.verdict = k.verdict GROUP BY 1""")
def audit_counts(spark, d):
    return verdict_counts(audited(spark, d), C.AUDIT_VERDICTS)


def audited(spark, d):
    """Orders as audited components: mirrored with a readme, with a hub vcs, or with git only."""
    readmes, cards, git = landed_lookups(spark, d)
    k, m = F.col("o_orderkey"), F.col("o_orderkey") % 3
    slug = F.concat(F.lit("repo"), F.col("o_custkey").cast("string"))
    comps = table(spark, d, "orders").select(
        k.alias("ord"), F.concat(F.lit("model"), k.cast("string")).alias("name"), F.lit("1").alias("version"),
        I.pick(("Apache-2.0", "mit", "MIT | ISC", "(none)"), k).alias("recorded"),
        F.when(m == 0, F.concat(F.lit("https://huggingface.co/mirror/"), slug)).alias("homepage"),
        F.when(m == 1, F.concat(F.lit("https://huggingface.co/up/"), slug, F.lit("/")))
        .otherwise(F.concat(F.lit("https://github.com/org/"), slug, F.lit("?tab=1"))).alias("vcs"),
    )
    curation = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("model"), k.cast("string"), F.lit("@1")).alias("key"),
        F.concat(F.lit("order "), k.cast("string")).alias("rationale"),
    )
    return upstream.audit(comps, curation, readmes, cards, git)


_CLAIMS = f"""{I.components_cte()},
cl AS (SELECT ord, name, {_repo_sql('huggingface.co').replace('u,', 'homepage,')} AS repo_id, first_license AS recorded,
  CASE first_license WHEN 'MIT' THEN 'mit' WHEN 'GPL-3.0' THEN 'gpl-3.0' WHEN 'Apache-2.0' THEN 'apache-2.0' END AS hub FROM comp WHERE category = 'AI Models'),
ok AS (SELECT * FROM cl WHERE repo_id IS NOT NULL AND hub IS NOT NULL),
f AS (SELECT repo_id, arg_min(hub, ord) AS license, arg_min(recorded, ord) AS spdx, count(DISTINCT hub) > 1 AS conflict FROM ok GROUP BY 1)"""


def claims(spark, d):
    from concordat.plans.model_audit import mirror_claims

    return mirror_claims(flat(spark, d))


@query("repo_conflicts", f"""WITH {_CLAIMS}
SELECT f.repo_id, f.license, f.spdx, f.conflict, count(*) AS n_components FROM f JOIN ok ON ok.repo_id = f.repo_id AND ok.hub = f.license GROUP BY ALL""")
def repo_conflicts(spark, d):
    return upstream.repo_plan(claims(spark, d))


@query("repo_components", f"""WITH {_CLAIMS}
SELECT ok.repo_id, ok.ord, ok.name, f.conflict FROM f JOIN ok ON ok.repo_id = f.repo_id AND ok.hub = f.license""")
def repo_components(spark, d):
    c = claims(spark, d)
    return upstream.repo_components(c, upstream.repo_plan(c))


@query("unmapped_licences", f"""WITH {_CLAIMS}
SELECT ord, repo_id, recorded FROM cl WHERE repo_id IS NOT NULL AND recorded IS NOT NULL AND hub IS NULL""")
def unmapped_licences(spark, d):
    return upstream.unmapped_licences(claims(spark, d)).select("ord", "repo_id", "recorded")
