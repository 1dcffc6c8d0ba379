"""Whole jobs over the shared tables: enrichment, reports and streams."""

from __future__ import annotations

import io
import tarfile
import uuid

import pandas as pd
from pyspark.sql import functions as F

from concordat.bindings import inputs as I
from concordat.bindings.expressions import flat
from concordat.bindings.registry import query, table
from concordat.bindings.scanning import _CLASSED, classified, declared_files
from concordat.bindings.texts import plausible_sql
from concordat.functions import components as P
from concordat.functions import text as T
from concordat.operators import scans
from concordat.plans import enrichment, scan_diff
from concordat.session import ensure_checkpoint_dir, pin
from concordat.sources import inventory, sinks
from concordat.streaming import verdicts as V


def member_text():
    return F.concat(I.pick(I.PHRASES, F.col("doc_id")), F.lit("\n"), F.col("text"))


def packed_archives(spark, d, planned):
    """(key, content): one gzip tar per crate part that has a document of the same number.

    The archive holds a licence file, a notice on some, and a source file with a header.
    """
    crates = planned.where("plan.kind = 'tarball'")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("ord"), member_text().alias("body"), "source")
    rows = crates.select("ord", T.content_key(F.col("plan.url")).alias("key"), F.col("plan.path_prefix").alias("prefix")).join(docs, "ord")
    one = rows.groupBy("key", "prefix").agg(F.min_by(F.struct("ord", "body", "source"), "ord").alias("r"))

    def pack(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                box = io.BytesIO()
                with tarfile.open(fileobj=box, mode="w:gz") as tar:
                    files = {"LICENSE": row.body, "src/lib.rs": f"// Copyright (c) 2021 {row.source} team\nfn x() {{}}\n"}
                    if row.ord % 4 == 0:
                        files["docs/NOTICE"] = "notice: " + row.body
                    for name, text in files.items():
                        blob = text.encode("utf-8")
                        info = tarfile.TarInfo(row.prefix + name)
                        info.size = len(blob)
                        tar.addfile(info, io.BytesIO(blob))
                out.append((row.key, box.getvalue()))
            yield pd.DataFrame(out, columns=["key", "content"])

    return one.select("key", "prefix", "r.*").mapInPandas(pack, "key string, content binary")


def probe_files(spark, d, planned):
    """(key, content): LICENSE files landed for git-hosted and hub parts with a document of the same number."""
    hosted = planned.where(F.col("plan.kind").isin(*enrichment.PROBE_KINDS))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("ord"), member_text().alias("body"))
    rows = hosted.select("ord", T.content_key(F.concat("plan.base_url", F.lit("/LICENSE"))).alias("key")).join(docs, "ord")
    return rows.groupBy("key").agg(F.min_by("body", "ord").alias("body")).select("key", F.encode("body", "UTF-8").alias("content"))


def no_tools(spark):
    from concordat.schemas import TOOL_VALUE

    return pin(spark.createDataFrame([], f"key string, tool {TOOL_VALUE}"))


def spdx_texts(spark, d):
    """(id, text): a canonical text per id, taken from the first document of a fitting source."""
    docs = table(spark, d, "documents").select(
        I.pick(("MIT", "GPL-3.0", "Zlib", "ISC"), F.col("doc_id")).alias("id"), "doc_id",
        F.concat(F.lit("License\n"), F.col("text")).alias("text")).where(T.is_plausible_licence(F.col("text")))
    first = docs.groupBy("id").agg(F.min("doc_id").alias("doc_id"))
    return docs.join(first, ["id", "doc_id"]).select("id", "text")


_LIC = "'License' || chr(10) || text"
_ENRICH = f"""{I.components_cte()}, {I.curation_cte()},
txt AS (SELECT {I.pick_sql(('MIT', 'GPL-3.0', 'Zlib', 'ISC'), 'doc_id')} AS id, {_LIC} AS text,
  row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) AS rn FROM documents WHERE {plausible_sql(_LIC)}),
canon AS (SELECT id, text FROM txt WHERE rn = 1),
body AS (SELECT doc_id, {I.pick_sql(I.PHRASES, 'doc_id')} || chr(10) || text AS body FROM documents),
pl AS (SELECT comp.*, CASE WHEN kind = 'name' AND contains(value, 'LicenseRef-') THEN 'skip'
    WHEN category = 'Rust Crates' THEN 'tar' WHEN category = 'Python Packages' AND homepage LIKE 'https://github.com/%' THEN 'probe'
    WHEN category IN ('NPM Packages', 'Python Packages') THEN 'meta'
    WHEN category = 'AI Models' AND regexp_matches(homepage, '^https?://huggingface\\.co/([^/]+)/([^/?#]+)') THEN 'probe'
    WHEN category = 'ComfyUI Nodes' AND regexp_matches(homepage, '^https?://github\\.com/') THEN 'probe' ELSE 'none' END AS src,
  CASE category WHEN 'Rust Crates' THEN name || '@' || version
    WHEN 'Python Packages' THEN CASE WHEN contains(homepage, '/tree/') THEN homepage || '@' ELSE 'nowhere' END ELSE regexp_replace(homepage, '[?].*|/$', '') || '@' ||
    CASE WHEN category = 'ComfyUI Nodes' AND contains(homepage, '/tree/') THEN '' ELSE version END END AS spot FROM comp),
land AS (SELECT src, spot, min(ord) AS doc_id FROM (SELECT pl.*, CASE src WHEN 'skip' THEN CASE category WHEN 'Rust Crates' THEN 'tar' ELSE 'probe' END ELSE src END AS src2 FROM pl) q
  JOIN body ON body.doc_id = q.ord WHERE src2 IN ('tar', 'probe') AND src2 = CASE category WHEN 'Rust Crates' THEN 'tar' ELSE 'probe' END
    AND (category <> 'AI Models' OR homepage LIKE 'https://huggingface%') AND (category <> 'ComfyUI Nodes' OR homepage LIKE 'https://github%')
    AND category IN ('Rust Crates', 'AI Models', 'ComfyUI Nodes') GROUP BY ALL),
lan AS (SELECT spot, min(doc_id) AS doc_id FROM land GROUP BY 1),
f AS (SELECT pl.ord, l.doc_id, b.body, pl.src = 'tar' AND l.doc_id % 4 = 0 AS has_notice FROM pl JOIN lan l ON l.spot = pl.spot JOIN body b ON b.doc_id = l.doc_id WHERE pl.src IN ('tar', 'probe')),
g AS (SELECT *, {plausible_sql('body')} AS ok1, has_notice AND {plausible_sql("'notice: ' || body")} AS ok2, lower(left(body, 2000)) AS h, lower(left('notice: ' || body, 2000)) AS h2 FROM f),
m AS (SELECT pl.*, g.doc_id, g.ok1, g.ok2, strlen(g.body) AS n_bytes,
    (SELECT text FROM canon WHERE id = CASE WHEN kind = 'expression' THEN 'MIT' WHEN kind = 'id' THEN value END) AS ctext,
    (SELECT text FROM canon WHERE kind = 'expression' AND id = 'ISC') AS ctext2,
    CASE WHEN ok1 AND contains(h, p1.phrase) OR ok2 AND contains(h2, p1.phrase) THEN 1 ELSE 0 END AS hit
  FROM pl LEFT JOIN g ON g.ord = pl.ord
  LEFT JOIN (VALUES ('MIT', 'permission is hereby granted, free of charge'), ('GPL-3.0', 'gnu general public license'), ('Apache-2.0', 'apache license')) p1(id, phrase) ON p1.id = value),
x AS (SELECT m.*, g.h, coalesce(m.ok1, false) OR coalesce(m.ok2, false) AS has_file,
    contains(g.h, 'permission is hereby granted, free of charge') OR contains(g.h, 'apache license') OR contains(g.h, 'permission to use, copy, modify') AS dual_hit FROM m LEFT JOIN g ON g.ord = m.ord)
SELECT ord, CASE WHEN src = 'skip' THEN 'skipped' WHEN has_file THEN 'enriched'
    WHEN kind IN ('id', 'expression') AND coalesce(ctext, ctext2) IS NOT NULL THEN 'enriched'
    WHEN src = 'none' THEN 'unresolvable-source' WHEN src = 'meta' OR src = 'tar' AND doc_id IS NULL THEN 'download-error' ELSE 'unresolvable-license' END AS status,
  CASE WHEN src = 'skip' THEN '' WHEN has_file THEN
      CASE WHEN kind = 'expression' AND (dual_hit OR ok2) THEN 'concatenated-dual' WHEN kind = 'id' AND hit = 1 THEN 'matched' ELSE 'longest-file' END
    WHEN kind IN ('id', 'expression') AND coalesce(ctext, ctext2) IS NOT NULL THEN 'spdx-canonical-fallback' ELSE '' END AS source_tag,
  CASE WHEN src = 'skip' THEN 'proprietary license ''' || value || '''' WHEN has_file THEN ''
    WHEN src = 'none' AND kind IN ('id', 'expression') AND coalesce(ctext, ctext2) IS NOT NULL THEN 'no source dispatch (' || why || '); used SPDX canonical'
    WHEN src = 'none' THEN why
    WHEN src = 'meta' OR src = 'tar' AND doc_id IS NULL THEN 'not landed' || CASE WHEN kind IN ('id', 'expression') AND coalesce(ctext, ctext2) IS NOT NULL THEN ' — fell back to SPDX canonical' ELSE '' END
    WHEN kind IN ('id', 'expression') AND coalesce(ctext, ctext2) IS NOT NULL THEN ''
    WHEN doc_id IS NOT NULL AND (src = 'tar' OR n_bytes >= 50) THEN 'suspicious-license-text' ELSE 'unresolvable' END AS reason
FROM (SELECT x.*, CASE category WHEN 'AI Models' THEN 'HF URL not parseable: ' || homepage WHEN 'ComfyUI Nodes' THEN 'GitHub URL not parseable: ' || homepage
    WHEN 'System Tools' THEN 'No curation entry for ' || name || '@' || version ELSE 'Unknown category: ' || category END AS why FROM x)"""


def enriched(spark, d):
    tools = no_tools(spark)
    planned = pin(enrichment.plan_sources(flat(spark, d), tools))
    landed = pin(packed_archives(spark, d, planned).unionByName(probe_files(spark, d, planned)))
    return enrichment.enrich(
        planned, tools, I.curation(spark, d, planned), landed, spdx_texts(spark, d))


@query("enrichment", f"WITH {_ENRICH}")
def enrichment_query(spark, d):
    """Status and body source per component after the whole enrichment job."""
    return enriched(spark, d).results.select("ord", "status", "source_tag", "reason")


@query("enriched_components")
def enriched_components(spark, d):
    """Component records with the body and copyrights written in."""
    e = enriched(spark, d)
    c = F.col("component")
    return e.components.select("ord", c["name"].alias("name"), F.length(P.embedded_text(c)).alias("n_chars"), c["copyright"].alias("copyright"))


_PART_JSON = """'{"type":"library","bom-ref":"ref-' || p_partkey || '","name":"' || p_name || '","version":"' || p_size || '","hashes":[{"alg":"SHA-256","content":"'
  || sha256(p_name) || '"}],"licenses":[{"license":{"id":"' || p_type || '","url":"https://example.org/' || p_partkey || '"}}],"pedigree":{"notes":"kept"}}'"""


@query("inventory_roundtrip", f"""WITH p AS (SELECT p_brand, {_PART_JSON} AS js, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS ord,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS back FROM part WHERE p_brand IS NOT NULL)
SELECT p_brand AS brand, CAST(ord AS BIGINT) AS ord, js || CASE WHEN back > 1 THEN ',' ELSE '' END AS line FROM p
UNION ALL SELECT p_brand, -1, '{{"bomFormat":"CycloneDX","serialNumber":"urn:' || p_brand || '","components":[' FROM p GROUP BY p_brand
UNION ALL SELECT p_brand, 9223372036854775807, ']}}' FROM p GROUP BY p_brand
UNION ALL SELECT 'empty', -1, '{{"bomFormat":"CycloneDX","components":[' UNION ALL SELECT 'empty', 9223372036854775807, ']}}'""")
def inventory_roundtrip(spark, d):
    """Inventories made of the parts of each brand, and an empty one, through the real reader and writer."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/inventories-{uuid.uuid4().hex}"
    key = F.col("p_partkey").cast("string")
    text = lambda s: F.lit(s)
    js = F.concat(
        text('{"type":"library","bom-ref":"ref-'), key, text('","name":"'), "p_name", text('","version":"'), F.col("p_size").cast("string"),
        text('","hashes":[{"alg":"SHA-256","content":"'), F.sha2("p_name", 256), text('"}],"licenses":[{"license":{"id":"'), "p_type",
        text('","url":"https://example.org/'), key, text('"}}],"pedigree":{"notes":"kept"}}'))
    made = table(spark, d, "part").where("p_brand is not null").groupBy("p_brand").agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", js.alias("js")))).alias("cs")).select(
        F.col("p_brand").alias("brand"), F.concat(
            text('{"bomFormat":"CycloneDX","serialNumber":"urn:'), "p_brand", text('","components":['),
            F.array_join(F.transform("cs", lambda c: c["js"]), ","), text("]}")).alias("value"))
    empty = spark.range(1).select(text("empty").alias("brand"), text('{"bomFormat":"CycloneDX","components":[]}').alias("value"))
    made.unionByName(empty).repartition("brand").write.partitionBy("brand").text(folder)
    lines = sinks.document_lines(inventory.read_components(spark, folder), inventory.read_documents(spark, folder))
    return lines.select(F.url_decode(F.url_decode(F.regexp_extract("sbom_id", "brand=([^/]*)", 1))).alias("brand"), "ord", F.col("value").alias("line"))


_MARK = "SELECT ord, CASE WHEN src = 'skip' THEN 'skipped'"
_HEAD, _TAIL = _ENRICH.split(_MARK)
_RESULTS = f"{_HEAD.rstrip()}, r0 AS ({_MARK}{_TAIL}), r AS (SELECT r0.*, comp.name, comp.version, comp.category FROM r0 JOIN comp ON comp.ord = r0.ord)"


@query("enrichment_report", f"""WITH {_RESULTS}
SELECT 1 AS section, status AS at, '  ' || status || ': ' || count(*) AS line FROM r GROUP BY status
UNION ALL SELECT 2, place, '  ' || what || ': ' || n FROM (
  SELECT unnest(['0', '1', '2', '3', '4']) AS place, unnest(['total_in_sbom', 'processed', 'skipped', 'enriched', 'failed']) AS what,
    unnest([count(*), count(*), count(*) FILTER (status = 'skipped'), count(*) FILTER (status = 'enriched'), count(*) FILTER (status NOT IN ('skipped', 'enriched'))]) AS n FROM r)
UNION ALL SELECT 3, 'parts|' || lpad(CAST(ord AS VARCHAR), 19, '0'), '  [' || status || '] ' || name || ' ' || version || ' (' || category || '): ' || reason FROM r WHERE status NOT IN ('skipped', 'enriched')
UNION ALL SELECT 4, source_tag, '  ' || source_tag || ': ' || count(*) FROM r WHERE status = 'enriched' GROUP BY source_tag""")
def enrichment_report(spark, d):
    return sinks.enrichment_report(enriched(spark, d).results).orderBy("section", "at")


_SCAN_REPORT = f"""WITH {_CLASSED},
n(verdict) AS (VALUES ('ACK'), ('MISMATCH'), ('NO-DETECTION'), ('CURATED'), ('UNACCOUNTED')),
place AS (SELECT bucket, top, min(ord) AS first_ord FROM scan GROUP BY 1, 2),
pl AS (SELECT cl.*, first_ord, list_position(['npm', 'nodes', 'overrides', 'rust', 'python'], cl.bucket) AS b FROM cl JOIN place p ON p.bucket = cl.bucket AND p.top = cl.top),
quiet AS (SELECT *, row_number() OVER (ORDER BY b, first_ord) AS rn FROM pl WHERE outcome = 'NO-DETECTION'),
loose AS (SELECT *, row_number() OVER (ORDER BY b, first_ord) AS rn FROM pl WHERE outcome = 'UNACCOUNTED' AND NOT (top LIKE '%.dist-info' OR top LIKE '~%')),
acks AS (SELECT *, row_number() OVER (ORDER BY b, first_ord) AS rn FROM pl WHERE outcome = 'ACK')
SELECT 1 AS section, verdict AS at, '- ' || verdict || ': ' || count(outcome) AS line FROM n LEFT JOIN cl ON outcome = verdict GROUP BY verdict
UNION ALL SELECT 2, name || chr(31) || top, '- `' || name || '` `' || version || '`: declared `' || declared || '`, detected `' || detected || '`' || chr(10) || '  - ' || rationale FROM cl WHERE outcome = 'CURATED'
UNION ALL SELECT 3, bucket || chr(31) || name || chr(31) || top, '| ' || bucket || ' | `' || name || '` | `' || version || '` | `' || declared || '` | `' || detected || '` | ' ||
  CASE WHEN license_file_seen THEN '✓' ELSE '—' END || ' | ' || n_files || ' |' FROM cl WHERE outcome = 'MISMATCH'
UNION ALL SELECT 4, '0000', '## NO-DETECTION (' || count(*) || ')' FROM quiet HAVING count(*) > 0
UNION ALL SELECT 4, lpad(rn::VARCHAR, 4, '0'), '- `' || name || '` `' || version || '` (declared `' || declared || '`, ' || n_files || ' files, ' || bucket || ')' FROM quiet WHERE rn <= 30
UNION ALL SELECT 4, '9999', '- ... and ' || (count(*) - 30) || ' more' FROM quiet HAVING count(*) > 30
UNION ALL SELECT 5, '0000', '- Total: ' || count(*) FROM cl WHERE outcome = 'UNACCOUNTED' HAVING count(*) > 0
UNION ALL SELECT 5, '0000+', '- After noise-stripping: ' || count(*) FROM loose HAVING count(*) > 0
UNION ALL SELECT 5, lpad(rn::VARCHAR, 4, '0'), '- `' || top || '` (' || bucket || ', ' || n_files || ' files, detected `' || coalesce(nullif(detected, ''), 'none') || '`)' FROM loose WHERE rn <= 30
UNION ALL SELECT 5, '9999', '- ... and ' || (count(*) - 30) || ' more' FROM loose HAVING count(*) > 30
UNION ALL SELECT 6, lpad(rn::VARCHAR, 4, '0'), '- `' || name || '` `' || version || '`: declared `' || declared || '` ✓' FROM acks WHERE rn <= 25"""


@query("scan_report", _SCAN_REPORT)
def scan_report(spark, d):
    return scan_diff.report(classified(spark, d)).orderBy("section", "at")


@query("component_scan_report", f"""WITH {I.scan_cte()},
s AS (SELECT *, CASE WHEN contains(path, 'ring') THEN NULL WHEN contains(path, 'bolt') THEN 'mit' ELSE 'Apache-2.0 AND ISC' END AS declared FROM scan WHERE type = 'file'),
c AS (SELECT * FROM s WHERE raw IS NOT NULL AND declared IS NOT NULL AND {I.loose_sql('raw')} <> {I.loose_sql('declared')})
SELECT top AS component, 1 AS section, '- Declared SPDX: `' || coalesce(declared, '(none)') || '`' || chr(10) || '- Files scanned: ' || count(*) || chr(10)
    || '- Files with no license detected: ' || count(*) FILTER (raw IS NULL) AS line FROM s GROUP BY top, declared
UNION ALL SELECT top, 2, '  - `' || raw || '`: ' || count(*) || ' file(s)' || CASE WHEN {I.loose_sql('raw')} = {I.loose_sql("coalesce(declared, '')")} THEN ' ← matches declared' ELSE '' END
  FROM s WHERE raw IS NOT NULL GROUP BY top, raw, declared
UNION ALL SELECT top, 3, '| `' || path || '` | `' || raw || '` | ' || CAST(score AS INTEGER) || ' |' FROM c""")
def component_scan_report(spark, d):
    files = declared_files(spark, d).withColumn("component", F.col("top"))
    only = files.where(scans.is_file())
    summary = scans.scan_summary(files, ["component", "declared"])
    hist = only.where(F.col("expr").isNotNull()).groupBy("component", "declared", "expr").agg(F.count(F.lit(1)).alias("n_files"))
    bad = scans.file_conflicts(files).withColumn("top_score", scans.top_score(F.col("detections")))
    return sinks.component_scan_report(files, hist, bad, summary).select("component", "section", "line")


# --- streams -----------------------------------------------------------------
def as_verdicts(e):
    return e.select(
        F.sha2(F.col("user_id").cast("string"), 256).alias("sha256"),
        F.concat(F.lit("engine"), (F.col("user_id") % 7).cast("string")).alias("engine"),
        F.col("ts").cast("timestamp").alias("fetched_at"), "event_id",
        I._case(F.col("event_type"), I.EVENT_CATEGORY).alias("category"),
        F.concat(F.lit("file"), F.col("user_id").cast("string")).alias("filename"),
    )


def event_stream(spark, d, files=None, **options):
    """The events table, or files cut from it, read as a stream of verdicts."""
    schema = table(spark, d, "events").schema
    reader = spark.readStream.schema(schema).options(**options)
    return as_verdicts(reader.parquet(files) if files else reader.option("pathGlobFilter", "events.parquet").parquet(d))


def drain(spark, stream):
    """Run a stream over what is there into a folder next to the checkpoints and read it back."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    V.run_available(stream, f"{base}/state", f"{base}/out")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query("stream_dedupe", f"WITH {I.verdicts_cte()} SELECT DISTINCT sha256, engine, epoch_us(fetched_at) AS at FROM v")
def stream_dedupe(spark, d):
    """Every verdict arrives twice; repeats are dropped within the watermark."""
    s = event_stream(spark, d)
    twice = s.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return drain(spark, V.drop_repeats(twice)).select("sha256", "engine", F.unix_micros("fetched_at").alias("at"))


@query("stream_escalate", f"""WITH {I.verdicts_cte()}
SELECT event_id, engine, CASE WHEN engine IN ('engine1', 'engine4') THEN 'alert' ELSE 'info' END AS severity FROM v WHERE category = 'malicious'""")
def stream_escalate(spark, d):
    vendors = I.verdicts(spark, d).where(F.col("engine").isin("engine1", "engine4")).select("engine").distinct()
    return drain(spark, V.escalate(event_stream(spark, d), vendors)).select("event_id", "engine", "severity")


@query("stream_retro_flags", f"""WITH {I.verdicts_cte()},
l AS (SELECT *, lag(category) OVER (PARTITION BY sha256, engine ORDER BY fetched_at, event_id) AS prev_category FROM v)
SELECT sha256, engine, epoch_us(fetched_at) AS at, category, prev_category FROM l WHERE category = 'malicious' AND prev_category <> 'malicious'""")
def stream_retro_flags(spark, d):
    V.use_rocksdb(spark)
    return drain(spark, V.retro_flags(event_stream(spark, d))).select(
        "sha256", "engine", F.unix_micros("fetched_at").alias("at"), "category", "prev_category")


@query("stream_daily_flags", f"""WITH {I.verdicts_cte()}, top AS (SELECT max(fetched_at) AS last FROM v)
SELECT strftime(date_trunc('day', fetched_at), '%Y-%m-%d') AS day, filename, count(*) FILTER (category = 'malicious') AS n_flagged, count(*) AS n_verdicts
FROM v, top WHERE date_trunc('day', fetched_at) + INTERVAL 1 DAY <= last - INTERVAL 2 DAY GROUP BY 1, 2""")
def stream_daily_flags(spark, d):
    """Days the watermark has passed; later days stay open in the state store."""
    return drain(spark, V.daily_flags(event_stream(spark, d))).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("stream_alert_ledger", f"""WITH {I.verdicts_cte()}
SELECT event_id, engine, CASE WHEN engine IN ('engine1', 'engine4') THEN 'alert' ELSE 'info' END AS severity FROM v WHERE category = 'malicious'""")
def stream_alert_ledger(spark, d):
    """Alerts of a stream in several batches whose last one is replayed after a restart, as after a crash before its commit."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/alerts-{uuid.uuid4().hex}"
    table(spark, d, "events").repartition(6, "event_id").write.parquet(f"{base}/in")
    vendors = pin(I.verdicts(spark, d).where(F.col("engine").isin("engine1", "engine4")).select("engine").distinct())
    sink = V.once_per_batch(spark, f"{base}/out")

    def run():
        V.run_available(V.escalate(event_stream(spark, d, f"{base}/in", maxFilesPerTrigger=2), vendors), f"{base}/state", foreach_batch=sink)

    run()
    jvm = spark.sparkContext._jvm
    commits = jvm.org.apache.hadoop.fs.Path(f"{base}/state/commits")
    place = commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath() for s in place.listStatus(commits)]
    last = max((p for p in names if p.getName().isdigit()), key=lambda p: int(p.getName()))
    place.delete(last, False)
    run()
    return V.alerts(spark, f"{base}/out", "event_id long, engine string, severity string").select("event_id", "engine", "severity")


@query("stream_retro_bootstrap", f"""WITH {I.verdicts_cte()},
l AS (SELECT *, lag(category) OVER (PARTITION BY sha256, engine ORDER BY fetched_at, event_id) AS prev_category FROM v)
SELECT sha256, engine, epoch_us(fetched_at) AS at, category, prev_category FROM l WHERE category = 'malicious' AND prev_category <> 'malicious'""")
def stream_retro_bootstrap(spark, d):
    """History up to the middle of the time span in batch, the rest as a stream that begins with the history's newest verdicts."""
    from concordat.operators.releases import retro_flags

    ensure_checkpoint_dir(spark)
    V.use_rocksdb(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tail-{uuid.uuid4().hex}"
    events = table(spark, d, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.agg(F.min(micros).alias("a"), F.max(micros).alias("b")).first()
    cut = (span.a + span.b) // 2 if span.a is not None else 0
    events.where(micros >= cut).write.parquet(folder)
    history = as_verdicts(events.where(micros < cut))
    early = retro_flags(history, ["sha256", "engine"], ["fetched_at", "event_id"])
    late = drain(spark, V.retro_flags(event_stream(spark, d, folder), history=history))
    names = ["sha256", "engine", F.unix_micros("fetched_at").alias("at"), "category", "prev_category"]
    return early.select(*names).unionByName(late.select(*names))


@query("stream_open_days", f"""WITH {I.verdicts_cte()}
SELECT strftime(date_trunc('day', fetched_at), '%Y-%m-%d') AS day, filename, count(*) FILTER (category = 'malicious') AS n_flagged, count(*) AS n_verdicts FROM v GROUP BY 1, 2""")
def stream_open_days(spark, d):
    """Days the watermark has passed from the output, and those still open from the state store: together, every day."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/days-{uuid.uuid4().hex}"
    stream = V.daily_flags(event_stream(spark, d))
    V.run_available(stream, f"{base}/state", f"{base}/out")
    closed = spark.read.schema(stream.schema).parquet(f"{base}/out")
    both = closed.unionByName(V.open_days(spark, f"{base}/state"))
    return both.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
