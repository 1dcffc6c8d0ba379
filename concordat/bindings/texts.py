"""Queries over licence texts, headers, copyrights and notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat import constants as C
from concordat.bindings import inputs as I
from concordat.bindings.expressions import flat
from concordat.bindings.registry import query, table
from concordat.functions import components as P
from concordat.functions import evidence, spdx
from concordat.functions import text as T
from concordat.functions.documents import redact_document
from concordat.operators import bodies, copyrights, matching, notices, ordering
from concordat.sources.archives import header_text
from concordat.sources.sinks import drift_lines, notices_blocks, subset_notices_lines

_WORDS = " OR ".join(f"contains(lower(left({{t}}, {C.TEXT_HEAD_CHARS})), '{w}')" for w in C.LICENCE_WORDS)
_MARKS = " OR ".join(f"contains(lower(left({{t}}, {C.TEXT_HEAD_CHARS})), '{w}')" for w in C.HTML_MARKS)


def plausible_sql(t: str) -> str:
    return f"(length({t}) >= {C.MIN_TEXT_CHARS} AND NOT ({_MARKS.format(t=t)}) AND ({_WORDS.format(t=t)}))"


_DOC = "CASE WHEN doc_id % 2 = 0 THEN 'License ' || text ELSE text END"


def doc_text():
    return F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("License "), F.col("text"))).otherwise(F.col("text"))


@query("plausible_license_text", f"SELECT doc_id, {plausible_sql(_DOC)} AS plausible FROM documents")
def plausible_license_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.is_plausible_licence(doc_text()).alias("plausible"))


@query("audit_all", f"SELECT count(*) AS n, count(*) FILTER (NOT {plausible_sql(_DOC)}) AS n_bad FROM documents")
def audit_all(spark, d):
    """The sample check widened to every body."""
    return table(spark, d, "documents").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~T.is_plausible_licence(doc_text())).alias("n_bad")
    )


@query("audit_sample", f"""
SELECT doc_id, {plausible_sql(_DOC)} AS plausible FROM documents ORDER BY sha256('seed|' || doc_id), doc_id LIMIT 5""")
def audit_sample(spark, d):
    docs = table(spark, d, "documents")
    picked = ordering.audit_sample(docs.select("doc_id"), F.col("doc_id"), "seed", 5)
    return docs.join(F.broadcast(picked), "doc_id").select("doc_id", T.is_plausible_licence(doc_text()).alias("plausible"))


_BAD = " OR ".join(
    f"(position('{m}' IN lower(body)) > 0 AND strlen(left(lower(body), position('{m}' IN lower(body)) - 1)) + {len(m)} <= {C.PROBE_HEAD_BYTES})"
    for m in C.HTML_MARKS
)


@query("html_probe_reject", f"""
WITH b AS (SELECT 'page' AS kind, page_id AS id, html AS body FROM pages UNION ALL SELECT 'doc', doc_id, text FROM documents)
SELECT kind, id, strlen(body) >= {C.MIN_PROBE_BYTES} AND NOT ({_BAD}) AS accepted FROM b""")
def html_probe_reject(spark, d):
    pages = table(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("body"))
    docs = table(spark, d, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("body"))
    return pages.unionByName(docs).select("kind", "id", T.is_probe_content(F.encode("body", "UTF-8")).alias("accepted"))


_PATHS = r"""text || (['', ' C:\dir\f.txt x', ' "/home/u/f" /Users/a', ' /mnt/x,/root/y'])[CAST(doc_id % 4 AS INTEGER) + 1]"""


def _redact_sql(e: str) -> str:
    for p in C.PATH_PATTERNS:
        e = f"regexp_replace({e}, '{p.replace(chr(39), chr(39) * 2)}', '{C.REDACTED}', 'g')"
    return e


@query("redact_paths", f"SELECT doc_id, sha256({_redact_sql(_PATHS)}) AS redacted FROM documents")
def redact_paths(spark, d):
    tail = I.pick(("", " C:\\dir\\f.txt x", ' "/home/u/f" /Users/a', " /mnt/x,/root/y"), F.col("doc_id"))
    return table(spark, d, "documents").select(
        "doc_id", F.sha2(T.redact_paths(F.concat("text", tail)), 256).alias("redacted")
    )


@query("redact_document", f"""WITH {I.components_cte()}
SELECT ord, {_redact_sql("name || ' D:\\x\\' || version")} AS name, {_redact_sql("'/home/' || purl")} AS purl,
  {_redact_sql("homepage || ' /mnt/' || version")} AS homepage, depot FROM comp""")
def redact_document_query(spark, d):
    c = F.col("component")
    refs = F.transform(c["externalReferences"], lambda r: r.withField(
        "url", F.concat(r["url"], F.lit(" /mnt/"), c["version"])))
    dirty = I.components(spark, d).withColumn(
        "component",
        c.withField("externalReferences", refs)
        .withField("purl", F.concat(F.lit("/home/"), c["purl"]))
        .withField("name", F.concat(c["name"], F.lit(" D:\\x\\"), c["version"])),
    )
    clean = dirty.select("ord", redact_document(c, dirty.schema["component"].dataType).alias("component"))
    return clean.select(
        "ord", c["name"].alias("name"), c["purl"].alias("purl"),
        P.first_reference(c["externalReferences"], "website").alias("homepage"),
        P.first_property(c["properties"], "component:depot").alias("depot"),
    )


@query("base64_roundtrip", """
SELECT doc_id, sha256(to_base64(encode(text))) AS encoded, sha256(text) AS decoded FROM documents""")
def base64_roundtrip(spark, d):
    encoded = T.encode_text(F.col("text"))
    return table(spark, d, "documents").select("doc_id", encoded.alias("e")).select(
        "doc_id", F.sha2("e", 256).alias("encoded"), F.sha2(T.decode_text(F.col("e")), 256).alias("decoded")
    )


@query("embed_text", f"""WITH {I.components_cte()}
SELECT ord, CASE WHEN kind = 'none' THEN '' ELSE 'License of ' || name END AS body,
  CASE WHEN kind = 'expression' THEN 4 + 1 ELSE 4 END AS n_properties,
  CASE WHEN ord % 2 = 0 THEN '(c) ' || ord END AS copyright FROM comp""")
def embed_text(spark, d):
    c = flat(spark, d)
    written = P.embed_text(
        F.col("component"), F.col("info.kind"), F.concat(F.lit("License of "), F.col("name")),
        F.when(F.col("ord") % 2 == 0, F.concat(F.lit("(c) "), F.col("ord").cast("string"))),
    )
    return c.select("ord", written.alias("component")).select(
        "ord", P.embedded_text(F.col("component")).alias("body"),
        F.size("component.properties").alias("n_properties"), "component.copyright",
    )


@query("truncate_rationale", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS shown FROM documents""")
def truncate_rationale(spark, d):
    return table(spark, d, "documents").select("doc_id", T.shorten(F.col("text")).alias("shown"))


# --- fingerprints and drift --------------------------------------------------
_HITS = "[" + ", ".join(
    "CASE WHEN contains(lower(left(text, {n})), {p}) THEN '{i}' END".format(
        n=C.FINGERPRINT_HEAD_CHARS, i=i, p="'" + p.replace("\n", "' || chr(10) || '") + "'")
    for i, p in C.FINGERPRINTS
) + "]"
_DETECTED = f"list_filter({_HITS}, lambda x: x IS NOT NULL)"
_ORDERED = "list_filter({l}, lambda x, i: list_position({l}, x) = i)".format(l=_DETECTED)


@query("license_fingerprint", f"WITH {I.licence_files_cte()} SELECT ord, array_to_string({_ORDERED}, ', ') AS detected FROM lf")
def license_fingerprint(spark, d):
    return I.licence_files(spark, d).select("ord", F.array_join(evidence.fingerprints(F.col("text")), ", ").alias("detected"))


KINDS = ("id", "expression", "id", "name", "none", "expression")
VALUES = ("MIT", "Apache-2.0 OR (MIT AND ISC)", "GPL-3.0-or-later", "Custom", "", "Apache-2.0 WITH LLVM-exception")


_DRIFT = f"""{I.licence_files_cte()},
c AS (SELECT ord, text, {I.pick_sql(KINDS, 'ord // 13')} AS kind, {I.pick_sql(VALUES, 'ord // 13')} AS declared,
  {_ORDERED} AS detected FROM lf WHERE ord NOT IN (SELECT doc_id FROM labels WHERE quality = 1)),
e AS (SELECT *, CASE declared WHEN 'Apache-2.0 OR (MIT AND ISC)' THEN ['apache-2.0', 'mit', 'isc'] WHEN 'GPL-3.0-or-later' THEN ['gpl-3.0']
    WHEN 'Apache-2.0 WITH LLVM-exception' THEN ['apache-2.0'] ELSE [lower(declared)] END AS cand,
  flatten(list_transform(detected, lambda x: CASE WHEN x = 'Apache-2.0 OR MIT' THEN ['apache-2.0', 'mit'] ELSE [lower(x)] END)) AS expanded FROM c),
dr AS (SELECT ord, declared, array_to_string(detected, ', ') AS detected, left(text, 500) AS evidence FROM e
  WHERE kind <> 'none' AND len(detected) > 0 AND NOT list_has_any(cand, expanded))"""


@query("drift_detect", f"WITH {_DRIFT} SELECT * FROM dr")
def drift_detect(spark, d):
    return drifts(spark, d).select("ord", "drift.*")


@query("drift_report", f"""WITH {_DRIFT}
SELECT ord, '  file' || ord || ' 1' || chr(10) || '    purl:     pkg:x/' || ord || chr(10) || '    declared: ' || declared || chr(10) || '    detected: ' || detected || chr(10)
  || '    evidence (first 500 chars):' || chr(10)
  || array_to_string(list_transform(string_split(regexp_replace(evidence, chr(10) || '$', ''), chr(10))[1:10], lambda l: '      | ' || l), chr(10)) || chr(10) AS line FROM dr""")
def drift_report(spark, d):
    k = F.col("ord").cast("string")
    rows = drifts(spark, d).select(
        F.lit("docs").alias("sbom_id"), "ord", F.concat(F.lit("file"), k).alias("name"), F.lit("1").alias("version"),
        F.concat(F.lit("pkg:x/"), k).alias("purl"), "drift")
    return drift_lines(rows).select("ord", "line")


def drifts(spark, d):
    """(ord, drift) of the document files that drift from a declared licence."""
    n = F.floor(F.col("ord") / 13)
    files = I.licence_files(spark, d)
    curated = table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("ord"))
    kind, value = I.pick(KINDS, n), I.pick(VALUES, n)
    ids = (
        F.when(kind == "id", F.array(value)).when(kind == "expression", spdx.split_expression(value))
        .otherwise(F.array().cast("array<string>"))
    )
    drift = evidence.drift_from(evidence.fingerprints(F.col("text")), kind, value, ids, F.col("text"))
    return files.join(curated, "ord", "left_anti").select("ord", drift.alias("drift")).where(F.col("drift").isNotNull())


# --- body choice -------------------------------------------------------------
def _rule_values(pairs) -> str:
    return "VALUES " + ", ".join("('" + "', '".join(p) + "')" for p in pairs)


_HINTS = _rule_values([(i, h) for i, hs in C.FILENAME_HINTS.items() for h in hs])
_PHRASES = _rule_values([(i, p.lower()) for i, p in C.CONTENT_PHRASES.items()])
_BEST = f"""hints(spdx_id, hint) AS ({_HINTS}), phrases(spdx_id, phrase) AS ({_PHRASES}),
hh AS (SELECT component_id, spdx_id, min(ord) AS ord FROM lf JOIN hints ON contains(lower(rel_path), hint) GROUP BY ALL),
ph AS (SELECT component_id, spdx_id, min(ord) AS ord FROM lf JOIN phrases ON contains(lower(left(text, {C.PHRASE_HEAD_CHARS})), phrase) GROUP BY ALL),
best AS (SELECT component_id, spdx_id, coalesce(hh.ord, ph.ord) AS best_ord FROM hh FULL JOIN ph USING (component_id, spdx_id))"""


@query("best_file_match", f"WITH {I.licence_files_cte()}, {_BEST} SELECT component_id, spdx_id, best_ord FROM best")
def best_file_match(spark, d):
    ids = F.array(*[F.lit(i) for i in dict.fromkeys([*C.FILENAME_HINTS, *C.CONTENT_PHRASES])])
    hits = matching.rule_hits(I.licence_files(spark, d), ["component_id"])
    best = matching.best_file(F.col("hint_ord"), F.col("phrase_ord"), F.col("spdx_id"))
    return hits.withColumn("spdx_id", F.explode(ids)).select("component_id", "spdx_id", best.alias("best_ord")).where(
        F.col("best_ord").isNotNull())


@query("longest_body", f"""WITH {I.licence_files_cte()}
SELECT component_id, ord, length(text) AS n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY component_id ORDER BY length(text) DESC, ord) AS rn FROM lf) WHERE rn = 1""")
def longest_body(spark, d):
    return ordering.longest(I.licence_files(spark, d), ["component_id"], "text", "ord")


@query("body_assignment", f"""
WITH {I.licence_files_cte('lf0')}, {I.source_licences_cte()},
lf AS (SELECT * FROM lf0 WHERE {plausible_sql('text')}), {_BEST},
ids AS (SELECT component_id, unnest(all_ids) AS spdx_id, unnest(range(1, len(all_ids) + 1)) AS pos FROM sl),
asg0 AS (SELECT ids.component_id, ids.spdx_id, pos, best_ord AS ord, row_number() OVER (PARTITION BY ids.component_id, best_ord ORDER BY pos) AS rn
  FROM ids JOIN best ON best.component_id = ids.component_id AND best.spdx_id = ids.spdx_id),
asg AS (SELECT * FROM asg0 WHERE rn = 1),
tags AS (SELECT component_id, kind, value, CASE
    WHEN kind = 'expression' AND len(all_ids) > 1 AND (component_id IN (SELECT component_id FROM asg) OR component_id IN (SELECT component_id FROM lf WHERE contains(lower(rel_path), 'notice'))) THEN 'concatenated-dual'
    WHEN kind = 'id' AND component_id IN (SELECT component_id FROM best WHERE best.spdx_id = sl.value) THEN 'matched' ELSE 'longest-file' END AS tag
  FROM sl WHERE component_id IN (SELECT component_id FROM lf)),
longest AS (SELECT component_id, arg_min(ord, (-length(text), ord)) AS ord FROM lf GROUP BY 1),
leads AS (SELECT t.component_id, tag, a.ord, a.spdx_id, a.pos FROM tags t JOIN asg a ON a.component_id = t.component_id WHERE tag = 'concatenated-dual'
  UNION ALL SELECT t.component_id, tag, best_ord, '', 1 FROM tags t JOIN best b ON b.component_id = t.component_id AND b.spdx_id = t.value WHERE tag = 'matched'
  UNION ALL SELECT t.component_id, tag, l.ord, '', 1 FROM tags t JOIN longest l ON l.component_id = t.component_id WHERE tag = 'longest-file'),
segs AS (SELECT f.component_id, 0 AS part, pos AS place, CASE WHEN tag = 'concatenated-dual' THEN '=== ' || rel_path || ' (' || spdx_id || ') ===' || chr(10) || chr(10) || text ELSE text END AS piece
    FROM lf f JOIN leads l ON l.component_id = f.component_id AND l.ord = f.ord
  UNION ALL SELECT f.component_id, 1, f.ord, '=== NOTICE (' || rel_path || ') ===' || chr(10) || chr(10) || text FROM lf f
    WHERE contains(lower(rel_path), 'notice') AND component_id IN (SELECT component_id FROM tags) AND NOT EXISTS (SELECT 1 FROM leads l WHERE l.component_id = f.component_id AND l.ord = f.ord))
SELECT t.component_id, t.tag AS source_tag, count(*) AS n_segments, sha256(string_agg(piece, chr(10) || chr(10) ORDER BY part, place)) AS body
FROM tags t JOIN segs s ON s.component_id = t.component_id GROUP BY 1, 2""")
def body_assignment(spark, d):
    files = I.licence_files(spark, d).where(T.is_plausible_licence(F.col("text")))
    chosen = bodies.choose(I.source_licences(spark, d), files)
    segs = bodies.segments(chosen, files)
    n = segs.groupBy("component_id").agg(F.count(F.lit(1)).alias("n_segments"))
    made = bodies.assemble(segs)
    return n.join(made, "component_id").select(
        "component_id", "source_tag", "n_segments", F.sha2("body", 256).alias("body"))


@query("canonical_fallback", f"""
WITH texts AS (SELECT 'lic' || doc_id AS id, {_DOC} AS text FROM documents WHERE {plausible_sql(_DOC)}),
w AS (SELECT o_orderkey, unnest(['lic' || (o_orderkey * 3 % 1117) || ' WITH x', 'lic' || (o_custkey % 991), 'lic' || o_orderkey]) AS spdx_id, unnest([0, 1, 2]) AS pos FROM orders),
j AS (SELECT w.*, row_number() OVER (PARTITION BY o_orderkey ORDER BY pos) AS rn, text FROM w JOIN texts ON texts.id = string_split(w.spdx_id, ' WITH ')[1])
SELECT o_orderkey AS component_id, spdx_id AS fallback_id, length(text) AS n_chars FROM j WHERE rn = 1""")
def canonical_fallback(spark, d):
    k = F.col("o_orderkey")
    texts = table(spark, d, "documents").select(F.concat(F.lit("lic"), F.col("doc_id").cast("string")).alias("id"), doc_text().alias("text"))
    lic = lambda n: F.concat(F.lit("lic"), n.cast("string"))
    wanted = table(spark, d, "orders").select(
        k.alias("component_id"),
        F.array(F.concat(lic(k * 3 % 1117), F.lit(" WITH x")), lic(F.col("o_custkey") % 991), lic(k)).alias("all_ids"),
    )
    return matching.canonical_fallback(wanted, texts).select(
        "component_id", "fallback_id", F.length("text").cast("bigint").alias("n_chars"))


@query("first_n_per_group", f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem)
WHERE rank <= {C.HEADER_MAX_FILES}""")
def first_n_per_group(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return ordering.first_n(li, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], C.HEADER_MAX_FILES)


# --- copyrights and headers --------------------------------------------------
_OWNED = """'Copyright (c) 20' || lpad(CAST(doc_id % 30 AS VARCHAR), 2, '0') || (['-2024  ', ', 2023 ', ' '])[CAST(doc_id % 3 AS INTEGER) + 1]
  || 'Owner ' || CASE WHEN doc_id % 4 = 0 THEN upper(source) ELSE source END || ',' || chr(10) || '(C)' || chr(10) || '1999 Lang ' || lang || ';: ' || chr(10) || text"""


@query("copyright_harvest", rf"""
WITH b AS (SELECT source AS component_id, doc_id, {_OWNED} AS text FROM documents),
m AS (SELECT component_id, doc_id, unnest(ms) AS raw, unnest(range(len(ms))) AS pos FROM (
  SELECT component_id, doc_id, regexp_extract_all(text, '{C.COPYRIGHT_PATTERN}') AS ms FROM b)),
c AS (SELECT *, left(rtrim(trim(regexp_replace(raw, '\s+', ' ', 'g')), ',;: '), {C.COPYRIGHT_MAX_CHARS}) AS line FROM m),
r AS (SELECT component_id, lower(line) AS line_key, line, row_number() OVER (PARTITION BY component_id, lower(line) ORDER BY doc_id, pos) AS rn
  FROM c WHERE regexp_matches(substr(line, position(' ' IN line)), '[A-Za-z]{{2,}}'))
SELECT component_id, line_key, {_redact_sql('line')} AS line FROM r WHERE rn = 1""")
def copyright_harvest(spark, d):
    k = F.col("doc_id")
    text = F.concat(
        F.lit("Copyright (c) 20"), F.lpad((k % 30).cast("string"), 2, "0"), I.pick(("-2024  ", ", 2023 ", " "), k),
        F.lit("Owner "), F.when(k % 4 == 0, F.upper("source")).otherwise(F.col("source")), F.lit(",\n(C)\n1999 Lang "),
        F.col("lang"), F.lit(";: \n"), F.col("text"),
    )
    blobs = table(spark, d, "documents").select(F.col("source").alias("component_id"), k.alias("blob_ord"), text.alias("text"))
    return copyrights.harvest(blobs)


_HEADER = """array_to_string(string_split((['// SPDX-License-Identifier: MIT', '/* SPDX-License-Identifier: Apache-2.0 */', '# nothing', 'x'])[CAST(doc_id % 4 AS INTEGER) + 1]
  || chr(10) || text, chr(10))[1:50], chr(10))"""


@query("header_evidence", f"""
WITH h AS (SELECT source AS component_id, {_HEADER} AS header FROM documents)
SELECT component_id, lower(trim(regexp_replace(regexp_extract(header, 'SPDX-License-Identifier:[ \\t]*([^\\r\\n]+)', 1), '(\\*/|-->|#\\}}).*$', ''))) AS spdx_id,
  count(*) AS n_files FROM h WHERE contains(header, 'SPDX-License-Identifier:') GROUP BY ALL""")
def header_evidence(spark, d):
    return copyrights.header_evidence(headers(spark, d))


def headers(spark, d):
    """(component_id, doc_id, header): first lines of documents that start with a source-file marker."""
    k = F.col("doc_id")
    head = I.pick(("// SPDX-License-Identifier: MIT", "/* SPDX-License-Identifier: Apache-2.0 */", "# nothing", "x"), k)
    body = F.encode(F.concat(head, F.lit("\n"), F.col("text")), "UTF-8")
    return table(spark, d, "documents").select(
        F.col("source").alias("component_id"), k, header_text(body, C.HEADER_MAX_LINES).alias("header"))


@query("header_totals", f"""
WITH h AS (SELECT source AS component_id, doc_id % 4 AS marker, {_HEADER} AS header FROM documents)
SELECT component_id, count(*) AS n_files, count(DISTINCT marker) AS n_ids FROM h WHERE contains(header, 'SPDX-License-Identifier:') GROUP BY ALL""")
def header_totals(spark, d):
    return copyrights.header_totals(headers(spark, d))


@query("source_headers", f"SELECT doc_id, sha256({_HEADER}) AS header FROM documents")
def source_headers(spark, d):
    return headers(spark, d).select("doc_id", F.sha2("header", 256).alias("header"))


# --- notices -----------------------------------------------------------------
_RULE = C.BLOCK_RULE


@query("notices_render", f"""WITH {I.components_cte()}
SELECT ord, sha256('COMPONENT:    ' || name || ' ' || version || chr(10) || 'LICENSE:      ' || coalesce(nullif(value, ''), 'Unknown') || chr(10)
  || 'HOMEPAGE:     ' || homepage || chr(10) || 'PURL:         ' || purl || chr(10) || chr(10) || 'COPYRIGHT' || chr(10) || '{'─' * 9}' || chr(10)
  || '(none recorded)' || chr(10) || chr(10) || 'LICENSE TEXT' || chr(10) || '{'─' * 12}' || chr(10) || '{C.NO_LICENCE_TEXT}' || chr(10) || chr(10) || '{_RULE}') AS block
FROM comp""")
def notices_render(spark, d):
    return notices_blocks(flat(spark, d)).select("ord", F.sha2("block", 256).alias("block"))


def blocks(spark, d):
    """Documents as notices blocks headed `<source> <lang> v<n>`."""
    k = F.col("doc_id")
    value = F.concat(
        F.lit("\nCOMPONENT:    "), F.col("source"), F.lit(" "), F.col("lang"), F.lit(" v"), (k % 5).cast("string"),
        F.lit("\r\nLICENSE: x\n"), F.col("text"),
    )
    docs = table(spark, d, "documents")
    return notices.parse_blocks(docs.select(k.alias("block_ord"), F.when(k % 9 == 0, F.col("text")).otherwise(value).alias("value")))


def picked_pairs(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels").where("toxic = 1"), "doc_id")
    return docs.select(
        F.concat("source", F.lit(" "), "lang").alias("name"), F.concat(F.lit("v"), (F.col("doc_id") % 5).cast("string")).alias("version"))


_BLOCKS = """b AS (SELECT doc_id AS block_ord, source || ' ' || lang AS name, 'v' || (doc_id % 5) AS version FROM documents
  WHERE doc_id % 9 <> 0 OR regexp_matches(text, '(?m)^COMPONENT:[^\\r\\n]* ')),
s AS (SELECT DISTINCT source || ' ' || lang AS name, 'v' || (doc_id % 5) AS version FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"""


@query("notices_blocks", f"WITH {_BLOCKS} SELECT block_ord, name, version FROM b")
def notices_blocks_query(spark, d):
    return blocks(spark, d).select("block_ord", "name", "version")


@query("notices_semi", f"WITH {_BLOCKS} SELECT block_ord, name, version FROM b WHERE (name, version) IN (SELECT name, version FROM s)")
def notices_semi(spark, d):
    return notices.select_blocks(blocks(spark, d), picked_pairs(spark, d)).select("block_ord", "name", "version")


@query("selection_counts", f"""WITH {_BLOCKS}, n AS (SELECT (SELECT count(*) FROM b WHERE (name, version) IN (SELECT name, version FROM s)) AS n_selected, (SELECT count(*) FROM s) AS n_expected)
SELECT n_selected, n_expected, n_expected - n_selected AS diff FROM n""")
def selection_counts(spark, d):
    return notices.selection_counts(blocks(spark, d), picked_pairs(spark, d))


_SUBSET = f"WITH {_BLOCKS}, k AS (SELECT * FROM b WHERE (name, version) IN (SELECT name, version FROM s))"


@query("subset_notices", f"""{_SUBSET}
SELECT 0 AS part, '' AS at, CAST(0 AS BIGINT) AS pos, sha256('Subset' || chr(10) || chr(10) || '{_RULE}' || chr(10) || 'TABLE OF CONTENTS' || chr(10) || '{'─' * 75}' || chr(10)
  || 'Total components: ' || count(*) || '. Alphabetical by name.' || chr(10)) AS line FROM k
UNION ALL SELECT 1, lower(name || ' ' || version), block_ord, sha256('  ' || name || ' ' || version) FROM k
UNION ALL SELECT 2, '', block_ord, sha256('{_RULE}' || chr(10) || 'COMPONENT:    ' || name || ' ' || version || chr(13) || chr(10) || 'LICENSE: x' || chr(10) || text) FROM k JOIN documents ON doc_id = block_ord""")
def subset_notices(spark, d):
    picked = notices.select_blocks(blocks(spark, d), picked_pairs(spark, d))
    return subset_notices_lines(picked, "Subset").select("part", "at", "pos", F.sha2("line", 256).alias("line"))
