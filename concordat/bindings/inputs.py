"""Role inputs derived from the shared tables, in Spark and in SQL.

The tables hold no inventories or scans, so each role is computed from a table's own rows:
parts act as components, line items as scanned files, documents as licence files, events as
verdicts, orders as releases and as a source of licence expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import constants as C
from concordat.bindings.registry import table
from concordat.session import spread

# Terms and phrases that exercise every rule.
TERMS = (
    "MIT", "Apache-2.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later",
    "BSD-3-Clause", "LicenseRef-scancode-commercial-license", "LicenseRef-scancode-unknown",
    "Apache-2.0 WITH LLVM-exception", "ISC", "gpl-3.0",
)
PHRASES = tuple(p for _, p in C.FINGERPRINTS) + ("",)


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''").replace("\n", "'||chr(10)||'") + "'" for v in values) + "]"


def pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


def pick_sql(values, index: str) -> str:
    return f"({_sql_list(values)})[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


# --- licence expressions -----------------------------------------------------
def expression(key: Column) -> Column:
    a, b = pick(TERMS, key), pick(TERMS, F.floor(key / 12))
    shape = F.floor(key / 144) % 7
    ref = F.lit(C.COMMERCIAL_REF)
    return (
        F.when(shape == 0, a)
        .when(shape == 1, F.concat(a, F.lit(" AND "), b))
        .when(shape == 2, F.concat(a, F.lit(" OR "), b))
        .when(shape == 3, F.concat(F.lit("("), a, F.lit(" OR "), ref, F.lit(") AND "), b))
        .when(shape == 4, F.concat(F.lit("("), a, F.lit(" and "), b, F.lit(") OR MIT")))
        .when(shape == 5, F.concat(a, F.lit(" AND "), b, F.lit(" OR "), ref))
        .otherwise(F.concat(a, F.lit(" AND "), F.lower(a), F.lit(" AND "), a))
    )


N_EXPRESSIONS = 12 * 12 * 7


def with_expression(df: DataFrame, key: Column, name: str = "expr") -> DataFrame:
    """Adds `expression(key)`; it repeats every N_EXPRESSIONS keys, so the distinct ones are joined in."""
    spark = df.sparkSession
    known = spark.range(N_EXPRESSIONS).select(
        F.col("id").alias(f"_k_{name}"), expression(F.col("id")).alias(name))
    return df.withColumn(f"_k_{name}", key % N_EXPRESSIONS).join(F.broadcast(known), f"_k_{name}").drop(f"_k_{name}")


def expression_sql(key: str) -> str:
    a, b = pick_sql(TERMS, key), pick_sql(TERMS, f"({key}) // 12")
    ref = f"'{C.COMMERCIAL_REF}'"
    return f"""CASE (({key}) // 144) % 7
      WHEN 0 THEN {a} WHEN 1 THEN {a} || ' AND ' || {b} WHEN 2 THEN {a} || ' OR ' || {b}
      WHEN 3 THEN '(' || {a} || ' OR ' || {ref} || ') AND ' || {b}
      WHEN 4 THEN '(' || {a} || ' and ' || {b} || ') OR MIT'
      WHEN 5 THEN {a} || ' AND ' || {b} || ' OR ' || {ref}
      ELSE {a} || ' AND ' || lower({a}) || ' AND ' || {a} END"""


def filtered_sql(expr: str) -> str:
    """The false-positive chain over a SQL text expression."""
    ref = C.COMMERCIAL_REF
    strip = (
        f"replace(replace(regexp_replace({expr}, '\\((\\S+) OR {ref}\\)', '\\1', 'g'), "
        f"'{ref} OR ', ''), ' OR {ref}', '')"
    )
    step1 = f"CASE WHEN contains({expr}, '{ref}') THEN {collapse_sql(strip)} ELSE {expr} END"
    pieces = f"string_split(regexp_replace(({step1}), ' (AND|OR) ', chr(1) || ' \\1 ', 'g'), chr(1))"
    kept = f"list_filter({pieces}, lambda p: NOT contains(p, '{C.INTERNAL_REF}'))"
    glued = f"trim(regexp_replace(array_to_string({kept}, ''), '^ (AND|OR) ', ''))"
    step2 = f"CASE WHEN contains(({step1}), '{C.INTERNAL_REF}') THEN {glued} ELSE ({step1}) END"
    return step2


def collapse_sql(e: str) -> str:
    parts = f"list_transform(string_split({e}, ' AND '), lambda p: trim(p))"
    return (
        f"CASE WHEN len({parts}) > 1 AND len(list_distinct(list_transform({parts}, lambda p: lower(p)))) = 1 "
        f"THEN ({parts})[1] ELSE {e} END"
    )


def fp_cte(source: str, key: str, expr: str, name: str = "fp") -> str:
    """CTEs that end in `name(key, raw, filtered)`."""
    rewrites = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in C.APPENDIX_REWRITES)
    return f"""{name}_0 AS (SELECT {key} AS key, {expr} AS raw FROM {source}),
    {name}_1 AS (SELECT DISTINCT raw FROM {name}_0),
    {name}_2 AS (SELECT raw, {filtered_sql('raw')} AS s FROM {name}_1),
    {name}_3 AS (SELECT raw, {collapse_sql('s')} AS s FROM {name}_2),
    {name} AS (SELECT k.key, k.raw, CASE f.s {rewrites} ELSE f.s END AS filtered
               FROM {name}_0 k LEFT JOIN {name}_3 f ON k.raw = f.raw)"""


def loose_sql(e: str) -> str:
    return f"replace(replace(lower(trim({e})), '_', '-'), ' ', '')"


def spdx_sql(e: str) -> str:
    rows = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in C.SPDX_SYNONYMS.items())
    return f"CASE {loose_sql(e)} {rows} ELSE {loose_sql(e)} END"


def family_sql(e: str) -> str:
    return f"lower(trim(replace(replace(string_split({e}, ' WITH ')[1], '-or-later', ''), '-only', '')))"


# --- components --------------------------------------------------------------
ECOSYSTEM = {"ECONOMY": "pkg:cargo/", "STANDARD": "pkg:npm/", "SMALL": "pkg:pypi/", "PROMO": "pkg:generic/",
             "LARGE": "pkg:generic/", "MEDIUM": "pkg:deb/"}
CATEGORY = {"ECONOMY": C.CAT_RUST, "STANDARD": C.CAT_NPM, "SMALL": C.CAT_PYTHON, "PROMO": C.CAT_MODELS,
            "LARGE": C.CAT_GIT_HOSTED[0], "MEDIUM": C.CAT_SYSTEM}


def _case(col: Column, pairs: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in pairs.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def _case_sql(col: str, pairs: dict[str, str]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def styled(name: Column, n: Column) -> Column:
    """One of the spellings a name takes in manifests and on disk."""
    return (
        F.when(n % 3 == 0, F.replace(name, F.lit(" "), F.lit("_")))
        .when(n % 3 == 1, F.replace(name, F.lit(" "), F.lit("-")))
        .otherwise(F.upper(F.replace(name, F.lit(" "), F.lit("_"))))
    )


def styled_sql(name: str, n: str) -> str:
    return (
        f"CASE ({n}) % 3 WHEN 0 THEN replace({name}, ' ', '_') WHEN 1 THEN replace({name}, ' ', '-') "
        f"ELSE upper(replace({name}, ' ', '_')) END"
    )


LICENCE_ENTRY_TYPE = (
    "array<struct<license:struct<id:string,name:string,"
    "text:struct<contentType:string,encoding:string,content:string>>,expression:string>>"
)


def components(spark: SparkSession, folder: str) -> DataFrame:
    """(sbom_id, ord, component): every part as a nested component record."""
    p = spread(table(spark, folder, "part"))
    k = F.col("p_partkey")
    name = F.when(
        (F.col("p_type") == "STANDARD") & (k % 4 == 0), F.concat(F.lit("@scope/"), styled(F.col("p_name"), k))
    ).when(k % 4 == 1, F.col("p_name")).otherwise(styled(F.col("p_name"), k))
    version = F.concat(F.lit("1."), F.col("p_size").cast("string"), F.when(k % 7 == 0, "+cu 1").otherwise(""))
    owner = F.replace("p_brand", F.lit("#"), F.lit(""))
    slug = styled(F.col("p_name"), F.lit(1))
    home = (
        F.when(k % 11 == 0, F.concat(F.lit("https://example.org/"), slug))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("https://huggingface.co/"), owner, F.lit("/"), slug, F.lit("?ref=x")))
        .when(k % 2 == 0, F.concat(F.lit("https://github.com/"), owner, F.lit("/"), slug, F.lit("/tree/v"), F.col("p_size").cast("string")))
        .otherwise(F.concat(F.lit("https://github.com/"), owner, F.lit("/"), slug, F.lit("/")))
    )
    licences = F.from_json(
        pick((
            '[{"license":{"id":"MIT"}},{"license":{"id":"ISC"}}]',
            '[{"license":{"name":"LicenseRef-Proprietary"}}]',
            '[{"expression":"MIT OR (Apache-2.0 AND ISC)"}]',
            "[]",
            '[{"license":{}},{"license":{"name":"Custom"}},{"expression":"Zlib"}]',
            '[{"license":{"id":"GPL-3.0"}}]',
            '[{"license":{"id":"Apache-2.0"}}]',
        ), k),
        LICENCE_ENTRY_TYPE,
    )
    prop = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    category = F.when(F.col("p_brand") == "Brand#25", F.lit("Mystery")).otherwise(_case(F.col("p_type"), CATEGORY))
    return p.select(
        F.lit("parts").alias("sbom_id"),
        k.alias("ord"),
        F.struct(
            name.alias("name"), version.alias("version"),
            F.concat(_case(F.col("p_type"), ECOSYSTEM), name, F.lit("@"), version).alias("purl"),
            F.lit(None).cast("string").alias("copyright"),
            licences.alias("licenses"),
            F.array(
                prop("component:note", F.col("p_brand")),
                prop("component:category", category),
                prop("component:category", F.lit("shadowed")),
                prop("component:depot", F.when(k % 3 == 0, "app").otherwise("backend")),
            ).alias("properties"),
            F.array(
                F.struct(F.lit("vcs").alias("type"), F.replace(home, F.lit("huggingface.co"), F.lit("github.com")).alias("url")),
                F.struct(F.lit("website").alias("type"), home.alias("url")),
            ).alias("externalReferences"),
        ).alias("component"),
    )


def components_cte(name: str = "comp") -> str:
    """(ord, name, version, purl, prefix, category, depot, homepage, vcs, kind, value, declared, recorded, first_license)."""
    k = "p_partkey"
    nm = (
        f"CASE WHEN p_type = 'STANDARD' AND {k} % 4 = 0 THEN '@scope/' || {styled_sql('p_name', k)} "
        f"WHEN {k} % 4 = 1 THEN p_name ELSE {styled_sql('p_name', k)} END"
    )
    slug = "replace(p_name, ' ', '-')"
    owner = "replace(p_brand, '#', '')"
    home = f"""CASE WHEN {k} % 11 = 0 THEN 'https://example.org/' || {slug}
       WHEN p_type = 'PROMO' THEN 'https://huggingface.co/' || {owner} || '/' || {slug} || '?ref=x'
       WHEN {k} % 2 = 0 THEN 'https://github.com/' || {owner} || '/' || {slug} || '/tree/v' || p_size
       ELSE 'https://github.com/' || {owner} || '/' || {slug} || '/' END"""
    return f"""{name}_0 AS (
      SELECT {k} AS ord, {nm} AS name, '1.' || p_size || CASE WHEN {k} % 7 = 0 THEN '+cu 1' ELSE '' END AS version,
        {_case_sql('p_type', ECOSYSTEM)} AS eco,
        CASE WHEN p_brand = 'Brand#25' THEN 'Mystery' ELSE {_case_sql('p_type', CATEGORY)} END AS category,
        CASE WHEN {k} % 3 = 0 THEN 'app' ELSE 'backend' END AS depot,
        {home} AS homepage,
        (['id', 'name', 'expression', 'none', 'name', 'id', 'id'])[CAST({k} % 7 AS INTEGER) + 1] AS kind,
        (['MIT', 'LicenseRef-Proprietary', 'MIT OR (Apache-2.0 AND ISC)', '', 'Custom', 'GPL-3.0', 'Apache-2.0'])[CAST({k} % 7 AS INTEGER) + 1] AS value,
        (['MIT AND ISC', 'LicenseRef-Proprietary', 'MIT OR (Apache-2.0 AND ISC)', '(none)', 'Custom AND Zlib', 'GPL-3.0', 'Apache-2.0'])[CAST({k} % 7 AS INTEGER) + 1] AS declared
      FROM part),
    {name} AS (
      SELECT ord, name, version, eco || name || '@' || version AS purl,
        CASE WHEN eco <> 'pkg:deb/' THEN eco END AS prefix, category, depot, homepage,
        replace(homepage, 'huggingface.co', 'github.com') AS vcs, kind, value, declared,
        CASE declared WHEN 'MIT AND ISC' THEN 'MIT | ISC' WHEN 'Custom AND Zlib' THEN 'Custom | Zlib' ELSE declared END AS recorded,
        CASE declared WHEN 'MIT AND ISC' THEN 'MIT' WHEN 'Custom AND Zlib' THEN 'Custom' WHEN '(none)' THEN NULL ELSE declared END AS first_license
      FROM {name}_0)"""


# --- scanned files -----------------------------------------------------------
TAILS = ("LICENSE", "src/lib.rs", "sub/LICENSE.txt", "a/b/LICENSE", "README.md", "COPYING.txt", "src/main.py")


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, ord, path, type, expr, detections): every line item as a scanned file."""
    li = table(spark, folder, "lineitem")
    p = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    j = li.join(p, "l_partkey")
    seed = F.col("l_orderkey") + F.col("l_suppkey") * 37
    top = F.when(F.col("p_brand") == "Brand#7", F.concat(F.col("p_name"), F.lit(".dist-info"))).otherwise(
        styled(F.col("p_name"), F.col("l_suppkey"))
    )
    score = F.col("l_quantity") * 2
    hit = F.struct(F.lit("x").alias("license_expression_spdx"), score.alias("score"))
    low = F.struct(F.lit("x").alias("license_expression_spdx"), F.lit(None).cast("double").alias("score"))
    nothing = F.lit(None).cast("array<struct<license_expression_spdx:string,score:double>>")
    return with_expression(j, seed, "found").select(
        pick(C.SCAN_BUCKETS, F.col("l_suppkey")).alias("bucket"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1048576
         + (F.col("l_partkey") * 31 + F.col("l_suppkey")) % 1048576).alias("ord"),
        F.concat(top, F.lit("/"), pick(TAILS, F.col("l_linenumber"))).alias("path"),
        F.when(F.col("l_quantity") > 48, "directory").otherwise("file").alias("type"),
        F.when(F.col("l_partkey") % 3 > 0, F.col("found")).alias("expr"),
        F.array(
            F.struct(F.array(hit, low).alias("matches")),
            F.struct(F.when(F.col("l_linenumber") > 3, F.array(low)).otherwise(nothing).alias("matches")),
        ).alias("detections"),
    )


def scan_cte(name: str = "scan") -> str:
    """(bucket, ord, path, top, type, raw, filtered, score); raw and filtered null without detection."""
    rewrites = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in C.APPENDIX_REWRITES)
    expr = expression_sql("l_orderkey + l_suppkey * 37")
    return f"""{name}_a AS (
      SELECT {pick_sql(C.SCAN_BUCKETS, 'l_suppkey')} AS bucket, (l_orderkey * 8 + l_linenumber) * 1048576 + (l_partkey * 31 + l_suppkey) % 1048576 AS ord,
        CASE WHEN p_brand = 'Brand#7' THEN p_name || '.dist-info' ELSE {styled_sql('p_name', 'l_suppkey')} END AS top,
        {pick_sql(TAILS, 'l_linenumber')} AS tail,
        CASE WHEN l_quantity > 48 THEN 'directory' ELSE 'file' END AS type,
        CASE WHEN l_partkey % 3 > 0 THEN {expr} END AS raw, l_quantity * 2 AS score
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    {name}_b AS (SELECT DISTINCT raw FROM {name}_a WHERE raw IS NOT NULL),
    {name}_c AS (SELECT raw, {filtered_sql('raw')} AS s FROM {name}_b),
    {name}_d AS (SELECT raw, {collapse_sql('s')} AS s FROM {name}_c),
    {name} AS (SELECT a.bucket, a.ord, a.top || '/' || a.tail AS path, a.top, a.tail, a.type, a.raw, a.score,
                 CASE d.s {rewrites} ELSE d.s END AS filtered
               FROM {name}_a a LEFT JOIN {name}_d d ON a.raw = d.raw)"""


def dirs_cte(scan: str = "scan", name: str = "dirs") -> str:
    """(bucket, top, n_files, n_with_license, license_file_seen, license_file_detected, dominant)."""
    root = "tail IN ('LICENSE', 'sub/LICENSE.txt', 'COPYING.txt')"
    return f"""{name}_m AS (
      SELECT bucket, top, filtered AS mode_expr,
        row_number() OVER (PARTITION BY bucket, top ORDER BY count(*) DESC, min(ord)) AS rn
      FROM {scan} WHERE type = 'file' AND raw IS NOT NULL GROUP BY bucket, top, filtered),
    {name}_r AS (
      SELECT bucket, top, filtered AS root_expr,
        row_number() OVER (PARTITION BY bucket, top ORDER BY ord DESC) AS rn
      FROM {scan} WHERE type = 'file' AND raw IS NOT NULL AND {root}),
    {name}_s AS (
      SELECT bucket, top, count(*) FILTER (type = 'file') AS n_files,
        count(*) FILTER (type = 'file' AND raw IS NOT NULL) AS n_with_license,
        coalesce(bool_or(type = 'file' AND {root}), false) AS license_file_seen
      FROM {scan} GROUP BY bucket, top),
    {name} AS (
      SELECT s.*, r.root_expr AS license_file_detected,
        coalesce(nullif(r.root_expr, ''), m.mode_expr, '') AS dominant
      FROM {name}_s s
      LEFT JOIN {name}_r r ON s.bucket = r.bucket AND s.top = r.top AND r.rn = 1
      LEFT JOIN {name}_m m ON s.bucket = m.bucket AND s.top = m.top AND m.rn = 1)"""


def matched_cte(dirs: str = "dirs", comp: str = "comp", name: str = "matched") -> str:
    """Directory rows with the component found by spelling-by-spelling probing."""
    return f"""{name}_v AS (
      SELECT prefix, ord, name, version, declared, unnest([lower(name), replace(lower(name), '_', '-'), replace(lower(name), '-', '_')]) AS nk
      FROM {comp} WHERE prefix IS NOT NULL),
    {name}_i AS (
      SELECT prefix, nk, name, version, declared FROM (
        SELECT *, row_number() OVER (PARTITION BY prefix, nk ORDER BY ord) AS rn FROM {name}_v) WHERE rn = 1),
    {name}_p AS (SELECT *, {_case_sql('bucket', C.BUCKET_PREFIX)} AS prefix FROM {dirs}),
    {name} AS (
      SELECT d.*, coalesce(a.name, b.name) AS name, coalesce(a.version, b.version) AS version,
        coalesce(a.declared, b.declared) AS declared, coalesce(a.name, b.name) IS NOT NULL AS is_matched
      FROM {name}_p d
      LEFT JOIN {name}_i a ON a.prefix = d.prefix AND a.nk = replace(lower(d.top), '_', '-')
      LEFT JOIN {name}_i b ON b.prefix = d.prefix AND b.nk = lower(d.top))"""


def curation(spark: SparkSession, folder: str, flat: DataFrame | None = None) -> DataFrame:
    """(key, rationale): components without a repository homepage are curated, one entry per key."""
    from concordat.sources.inventory import flatten

    flat = flatten(components(spark, folder)) if flat is None else flat
    keyed = flat.where(F.startswith("homepage", F.lit("https://example.org/"))).select(
        F.concat("name", F.lit("@"), "version").alias("key"), "ord"
    )
    return keyed.groupBy("key").agg(
        F.concat(F.lit("kept on purpose since part "), F.min("ord").cast("string")).alias("rationale")
    )


def curation_cte(comp: str = "comp", name: str = "cur") -> str:
    return f"""{name} AS (
      SELECT name || '@' || version AS key, 'kept on purpose since part ' || min(ord) AS rationale
      FROM {comp} WHERE homepage LIKE 'https://example.org/%' GROUP BY 1)"""


# --- licence files -----------------------------------------------------------
def licence_files(spark: SparkSession, folder: str) -> DataFrame:
    """(component_id, ord, rel_path, text): documents as the files of their source."""
    d = table(spark, folder, "documents")
    return d.select(
        F.col("source").alias("component_id"),
        F.col("doc_id").alias("ord"),
        F.concat(pick(("LICENSE", "NOTICE.txt", "docs/readme", "LICENSE-APACHE", "COPYING.gpl3", "mit.txt", "x/notice"),
                      F.col("doc_id")), F.lit("-"), F.col("doc_id").cast("string")).alias("rel_path"),
        F.concat(pick(PHRASES, F.col("doc_id")), F.lit("\n"), F.col("text")).alias("text"),
    )


def licence_files_cte(name: str = "lf") -> str:
    paths = ("LICENSE", "NOTICE.txt", "docs/readme", "LICENSE-APACHE", "COPYING.gpl3", "mit.txt", "x/notice")
    return f"""{name} AS (
      SELECT source AS component_id, doc_id AS ord, {pick_sql(paths, 'doc_id')} || '-' || doc_id AS rel_path,
        {pick_sql(PHRASES, 'doc_id')} || chr(10) || text AS text
      FROM documents)"""


def source_licences(spark: SparkSession, folder: str) -> DataFrame:
    """(component_id, kind, value, all_ids): declared licence per document source."""
    d = table(spark, folder, "documents")
    n = F.try_to_number(F.regexp_extract("source", r"(\d+)$", 1), F.lit("999999999")).cast("int")
    kind = pick(("id", "expression", "id", "name", "expression", "none"), n)
    value = pick(("MIT", "MIT OR Apache-2.0 OR ISC", "Zlib", "Custom", "(GPL-3.0-or-later)", ""), n)
    from concordat.functions.spdx import split_expression

    return d.select("source").distinct().select(
        F.col("source").alias("component_id"), kind.alias("kind"), value.alias("value"),
        F.when(kind == "id", F.array(value)).when(kind == "expression", split_expression(value))
        .otherwise(F.array().cast("array<string>")).alias("all_ids"),
    )


def source_licences_cte(name: str = "sl") -> str:
    n = "CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER)"
    ids = "CASE ({n}) % 6 WHEN 0 THEN ['MIT'] WHEN 1 THEN ['MIT', 'Apache-2.0', 'ISC'] WHEN 2 THEN ['Zlib'] WHEN 4 THEN ['GPL-3.0-or-later'] ELSE CAST([] AS VARCHAR[]) END".replace("{n}", n)
    return f"""{name} AS (
      SELECT DISTINCT source AS component_id, {pick_sql(('id', 'expression', 'id', 'name', 'expression', 'none'), n)} AS kind,
        {pick_sql(('MIT', 'MIT OR Apache-2.0 OR ISC', 'Zlib', 'Custom', '(GPL-3.0-or-later)', ''), n)} AS value, {ids} AS all_ids
      FROM documents)"""


# --- verdicts ----------------------------------------------------------------
def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """(sha256, engine, fetched_at, event_id, category, filename): events as scan verdicts."""
    e = table(spark, folder, "events")
    return e.select(
        F.sha2(F.col("user_id").cast("string"), 256).alias("sha256"),
        F.concat(F.lit("engine"), (F.col("user_id") % 7).cast("string")).alias("engine"),
        F.col("ts").cast("timestamp").alias("fetched_at"), "event_id",
        _case(F.col("event_type"), EVENT_CATEGORY).alias("category"),
        F.concat(F.lit("file"), F.col("user_id").cast("string")).alias("filename"),
    )


EVENT_CATEGORY = {"view": "undetected", "click": "harmless", "error": "malicious", "purchase": "type-unsupported",
                  "signup": "timeout"}


def verdicts_cte(name: str = "v") -> str:
    return f"""{name} AS (
      SELECT sha256(CAST(user_id AS VARCHAR)) AS sha256, 'engine' || (user_id % 7) AS engine, ts AS fetched_at, event_id,
        {_case_sql('event_type', EVENT_CATEGORY)} AS category, 'file' || user_id AS filename
      FROM events)"""
