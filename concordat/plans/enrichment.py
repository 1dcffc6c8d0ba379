"""Inventory enrichment: find licence bodies, harvest copyrights, detect drift, write them back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions import components as P
from concordat.functions import evidence, urls
from concordat.functions import text as T
from concordat.operators import bodies, copyrights
from concordat.operators.curation import with_curation, with_tool
from concordat.operators.matching import canonical_fallback
from concordat.session import pin
from concordat.settings import DEFAULT_PROFILE, Profile
from concordat.sources import archives
from concordat.sources.sinks import redact_components

ARCHIVE_KINDS = ("tarball", "npm-via-metadata", "pypi-via-metadata", "system-curated")
PROBE_KINDS = ("hf-probe", "gh-raw-probe")


@dataclass
class Enriched:
    """Outputs of one run."""

    components: DataFrame  # (sbom_id, ord, component), every string redacted
    results: DataFrame  # flat result record per component
    segments: DataFrame  # licence body pieces per component
    copyrights: DataFrame  # one row per component and statement


def plan_sources(flat: DataFrame, tools: DataFrame) -> DataFrame:
    """Adds `component_id`, `plan` and `tool` to flattened components."""
    return with_tool(flat, tools).withColumn(
        "plan",
        P.source_plan(F.coalesce("category", F.lit("")), F.col("name"), F.col("version"), F.col("homepage"), F.col("tool")),
    ).withColumn("component_id", F.struct("sbom_id", "ord"))


def wanted_archives(planned: DataFrame, registry: DataFrame) -> DataFrame:
    """(component_id, kind, url, prefix, format, wanted, key): the archive each component needs.

    Registry metadata is itself a landed record, read by key to learn the archive's URL.
    """
    p = F.col("plan")
    rows = planned.where(p["kind"].isin(*ARCHIVE_KINDS)).select(
        "component_id", "plan", "tool",
        F.when(p["metadata_url"].isNotNull(), T.content_key(p["metadata_url"])).alias("meta_key"),
    )
    known = rows.join(registry.withColumnRenamed("key", "meta_key"), "meta_key", "left")
    url = (
        F.when(p["kind"] == "npm-via-metadata", archives.npm_archive_url(F.col("meta")))
        .when(p["kind"] == "pypi-via-metadata", archives.pypi_archive_url(F.col("meta")))
        .otherwise(p["url"])
    )
    none = F.array().cast("array<string>")
    listed = F.concat(
        F.coalesce(F.col("tool.license_files_in_tarball"), none),
        F.coalesce(F.col("tool.notice_files_in_tarball"), none),
    )
    return known.select(
        "component_id", p["kind"].alias("kind"), "meta_key", p["metadata_url"].alias("meta_url"), F.col("meta").isNotNull().alias("has_meta"),
        url.alias("url"), F.coalesce(p["path_prefix"], F.lit("")).alias("prefix"),
        F.when(p["kind"] == "system-curated", listed).alias("wanted"),
    ).select(
        "*", archives.archive_format(F.col("url")).alias("format"),
        F.when(F.col("url").isNotNull(), T.content_key(F.col("url"))).alias("key"),
    )


def wanted_probes(planned: DataFrame) -> DataFrame:
    """(component_id, is_rescue, ord, rel_path, key): single files tried under a base URL.

    A Python package with a GitHub homepage also lists that repository's files; they count
    only when its archive cannot be had.
    """
    p = F.col("plan")
    owner, repo, ref = urls.git_parts(p["homepage_fallback"])
    rescue = F.when(
        F.startswith(p["homepage_fallback"], F.lit("https://github.com/")) & owner.isNotNull(),
        F.concat(F.lit("https://raw.githubusercontent.com/"), owner, F.lit("/"), repo, F.lit("/"),
                 F.coalesce(ref, F.lit("main"))),
    )
    based = planned.select(
        "component_id", p["kind"].isin(*PROBE_KINDS).alias("is_probe"),
        F.coalesce(p["base_url"], rescue).alias("base_url"),
    ).where(F.col("base_url").isNotNull())
    return based.select(
        "component_id", (~F.col("is_probe")).alias("is_rescue"),
        F.posexplode(P.probe_urls(F.col("base_url"))).alias("ord", "url"),
    ).select(
        "component_id", "is_rescue", F.col("ord").cast("bigint").alias("ord"),
        F.substring_index("url", "/", -1).alias("rel_path"), T.content_key(F.col("url")).alias("key"),
    )


def curated_bodies(planned: DataFrame, extracted: DataFrame) -> DataFrame:
    """Synthetic single file per curated tool: listed licence files in order, then notices.

    `extracted(component_id, kind, rel_path, content)`. The lists come from the tool map, so
    a group is as long as one map entry.
    """
    tool = F.col("tool")
    listed = planned.where(F.col("plan.kind") == "system-curated").select(
        "component_id", F.coalesce(tool["primary_license_id"], F.lit("")).alias("spdx_id"),
        F.posexplode(F.concat(
            F.transform(tool["license_files_in_tarball"],
                        lambda f: F.struct(F.lit(False).alias("is_notice"), f.alias("rel_path"))),
            F.transform(F.coalesce(tool["notice_files_in_tarball"], F.array().cast("array<string>")),
                        lambda f: F.struct(F.lit(True).alias("is_notice"), f.alias("rel_path"))),
        )).alias("at", "f"),
    ).select("component_id", "spdx_id", "at", "f.*")
    found = extracted.where(F.col("kind") == "wanted").select(
        "component_id", "rel_path", T.decode_utf8(F.col("content")).alias("text")
    )
    head = F.when(
        F.col("is_notice"), F.concat(F.lit("=== NOTICE ("), F.col("rel_path"), F.lit(") ===\n\n"))
    ).otherwise(F.concat(F.lit("=== "), F.col("rel_path"), F.lit(" ("), F.col("spdx_id"), F.lit(") ===\n\n")))
    return (
        listed.join(found, ["component_id", "rel_path"])
        .groupBy("component_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", F.concat(head, F.col("text")).alias("piece")))).alias("ps"))
        .select(
            "component_id", F.lit(0).cast("bigint").alias("ord"), F.lit("CURATED BODY").alias("rel_path"),
            F.array_join(F.transform("ps", lambda x: x["piece"]), "\n\n").alias("text"),
        )
    )


def enrich(
    flat: DataFrame,
    tools: DataFrame,
    curation: DataFrame,
    landed: DataFrame,
    spdx_texts: DataFrame,
    registry: DataFrame | None = None,
    fetch_errors: DataFrame | None = None,
    profile: Profile = DEFAULT_PROFILE,
) -> Enriched:
    """Run the whole enrichment over flattened components.

    `landed(key, content)`: archives and single files keyed by the SHA-256 of their URL;
    `registry(key, meta)`: package-registry records, same keys, JSON text; `spdx_texts(id, text)`;
    `fetch_errors(key, code, reason)`: downloads that failed (code null when not an HTTP status).

    Components that have been through `plan_sources` are taken as they are; write them first, as they are read often.

    Rows that several branches read are pinned as tables: the planned components, the
    extracted files, the decoded licence files and the body segments.
    """
    spark = flat.sparkSession
    if registry is None:
        registry = spark.createDataFrame([], "key string, meta string")
    if fetch_errors is None:
        fetch_errors = spark.createDataFrame([], "key string, code int, reason string")
    # Written, so that the planner knows which of them are small and does not shuffle all components to meet them.
    registry, fetch_errors = pin(registry), pin(fetch_errors)
    texts = pin(spdx_texts.withColumn("_text", F.monotonically_increasing_id()).withColumn(
        "clean", T.redact_paths(F.col("text"), profile.extra_path_patterns)))
    planned = flat if {"component_id", "plan", "tool"} <= set(flat.columns) else pin(plan_sources(flat, pin(tools)))
    open_plan = planned.where(~P.is_proprietary(F.col("info")))

    # --- acquire: each distinct download is opened once, then shared by its components
    arch = wanted_archives(open_plan, registry)
    probes = wanted_probes(open_plan)
    none = F.array().cast("array<string>")
    opened = arch.where(F.col("key").isNotNull()).select("key", "prefix", "format", "wanted").unionByName(
        probes.select("key", F.lit("").alias("prefix"), F.lit("single").alias("format"), none.alias("wanted"))
    ).groupBy("key", "prefix", "format").agg(F.array_distinct(F.flatten(F.collect_set("wanted"))).alias("wanted"))
    extracted = pin(archives.extract(opened.join(landed, "key"), profile))

    failed_all = pin(_failures(arch, extracted, landed, fetch_errors))
    rescued = probes.where("is_rescue").select("component_id").distinct()
    # A recorded error without a status is a broken connection, after which no other place is tried.
    failed = failed_all.join(rescued.withColumn("fail_final", F.lit(False)), ["component_id", "fail_final"], "left_anti").drop("fail_final")
    usable_probes = probes.join(
        failed_all.where("not fail_final").select("component_id", F.lit(True).alias("no_archive")), "component_id", "left"
    ).where(~F.col("is_rescue") | F.col("no_archive"))

    per_component = arch.select("component_id", F.col("kind").alias("plan_kind"), "key", "prefix").join(
        extracted.where(F.col("kind") != "single"), ["key", "prefix"]
    )
    singles = usable_probes.join(
        extracted.where(F.col("kind") == "single").select("key", "content"), "key"
    ).where(T.is_probe_content(F.col("content")))
    from_archives = per_component.where((F.col("kind") == "license") & (F.col("plan_kind") != "system-curated"))
    columns = ("component_id", "ord", "rel_path", "text")
    all_files = pin(
        from_archives.withColumn("text", T.decode_utf8(F.col("content"))).select(*columns)
        .unionByName(singles.withColumn("text", T.decode_utf8(F.col("content"))).select(*columns))
        .unionByName(curated_bodies(open_plan, per_component))
        .withColumn("plausible", T.is_plausible_licence(F.col("text")))
    )
    files = all_files.where("plausible").drop("plausible")

    # --- choose the body; where nothing usable was found, the canonical text stands in
    known = open_plan.select("component_id", "info.kind", "info.value", "info.all_ids")
    chosen = bodies.choose(known, files)
    # Which text is found once for both uses below, by a number; the texts are few and are joined where they go.
    stand_ins = pin(canonical_fallback(
        known.where(F.col("kind").isin("id", "expression"))
        .join(files.select("component_id").distinct(), "component_id", "left_anti")
        .select("component_id", "all_ids"),
        texts,
    ).select("component_id", "_text"))
    canon = stand_ins.join(texts.select("_text", F.col("text").alias("canonical"), "clean"), "_text").drop("_text")
    no_source = (
        open_plan.where(F.col("plan.kind") == "none").select("component_id")
        .unionByName(failed.select("component_id"))
    )
    # Inside body selection the canonical text takes part in the later steps; as a stand-in
    # for a missing source it is embedded as it is.
    canon_segs = canon.join(no_source, "component_id", "left_anti").select(
        "component_id", F.struct(F.lit(0).alias("part"), F.lit(1).cast("bigint").alias("at")).alias("seg"),
        F.col("clean").alias("piece"), F.lit("spdx-canonical-fallback").alias("source_tag"),
    )
    segs = pin(
        bodies.segments(chosen, files).withColumn("piece", T.redact_paths(F.col("piece"), profile.extra_path_patterns))
        .unionByName(canon_segs)
    )
    made = bodies.assemble(segs)

    # --- derive
    has_body = segs.select("component_id").distinct()
    headers = (
        per_component.where((F.col("kind") == "header") & (F.col("plan_kind") == "tarball"))
        .join(has_body, "component_id", "left_semi")
        .select("component_id", (F.col("ord") + F.lit(1 << 50)).alias("blob_ord"),
                archives.header_text(F.col("content"), profile.header_max_lines).alias("text"))
    )
    blobs = segs.select(
        "component_id", (F.col("seg.part").cast("bigint") * F.lit(1 << 40) + F.col("seg.at")).alias("blob_ord"),
        F.col("piece").alias("text"),
    ).unionByName(headers)
    seeds = open_plan.where(F.col("plan.kind") == "system-curated").join(has_body, "component_id", "left_semi").select(
        "component_id", F.posexplode("tool.copyright_seed").alias("seed_ord", "line"))
    harvested = pin(copyrights.harvest(blobs, seeds, profile.extra_path_patterns))

    facts = (
        made.join(copyrights.joined(harvested).select("component_id", "copyright"), "component_id", "left")
        .select("component_id", "source_tag", "body", "copyright")
    )
    rows = (
        planned.join(facts, "component_id", "left")
        .join(canon.join(no_source, "component_id", "left_semi").drop("clean"), "component_id", "left")
        .join(all_files.select("component_id", F.lit(True).alias("has_files")).distinct(), "component_id", "left")
        .join(failed, "component_id", "left")
    )
    done = pin(_conclude(with_curation(rows, curation.select("key", "rationale")), profile))
    results = done.select(
        "sbom_id", "ord",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "version", "purl", "category")],
        "status", "reason", "drift", "source_tag",
    )
    by_id = lambda df: df.select("component_id.*", *[c for c in df.columns if c != "component_id"])
    written = done.select("sbom_id", "ord", "component", *[c for c in ("raw",) if c in done.columns])
    components = redact_components(written, profile)
    has_text = F.exists("component.licenses", lambda entry: entry["license"]["text"].isNotNull())
    broken = bodies.implausible_bodies(redact_components(written.where(has_text), profile))
    if not broken.isEmpty():
        raise ValueError(f"embedded licence text does not read like one: {broken.first()}")
    return Enriched(components, results, by_id(segs), by_id(harvested))


def _failures(arch: DataFrame, extracted: DataFrame, landed: DataFrame, fetch_errors: DataFrame) -> DataFrame:
    """(component_id, fail_status, fail_reason, fail_final) of archive plans that could not be read."""
    broken = extracted.where(F.col("kind") == "archive-error").select(
        "key", "prefix", F.col("message").alias("broken"))
    there = landed.select("key", F.lit(True).alias("is_landed"))
    errors = fetch_errors.select(F.col("key").alias("fetch_key"), "code", F.col("reason").alias("why"))
    needed = arch.withColumn("fetch_key", F.when(F.col("meta_key").isNotNull() & ~F.col("has_meta"), F.col("meta_key"))
                             .otherwise(F.col("key")))
    joined = (
        needed.join(broken, ["key", "prefix"], "left").join(there, "key", "left").join(errors, "fetch_key", "left")
    )
    no_url = F.col("has_meta") & F.col("url").isNull()
    meta_url = F.coalesce(F.col("meta_url"), F.lit(""))
    status = (
        F.when(F.col("broken").isNotNull() | no_url, "download-error")
        .when(F.col("code") == 404, "download-404")
        .when(F.col("is_landed").isNull(), "download-error")
    )
    # What an archive's failure is reported as; system tools have a wording of their own.
    said = F.when(F.col("kind") == "system-curated", "system-tool tarball error: ").otherwise("RuntimeError: ")
    reason = (
        F.when(F.col("broken").isNotNull(),
               F.concat(said, F.lit("Archive open failed for "), F.col("url"), F.lit(": "), F.col("broken")))
        .when(no_url & (F.col("kind") == "npm-via-metadata"),
              F.concat(said, F.lit("npm metadata has no dist.tarball: "), meta_url))
        .when(no_url, F.concat(said, F.lit("PyPI metadata has no sdist or wheel: "), meta_url))
        .when(F.col("code").isNotNull(),
              F.concat(F.lit("HTTP "), F.col("code").cast("string"), F.lit(": "), F.coalesce("why", F.lit(""))))
        .otherwise(F.coalesce("why", F.lit("not landed")))
    )
    final = F.col("broken").isNull() & ~F.coalesce(no_url, F.lit(False)) & F.col("code").isNull() & F.col("why").isNotNull()
    return joined.select("component_id", status.alias("fail_status"), reason.alias("fail_reason"), final.alias("fail_final")).where(
        F.col("fail_status").isNotNull())


def _conclude(rows: DataFrame, profile: Profile) -> DataFrame:
    """Status, reason, drift and the written-back component of every row."""
    info, plan = F.col("info"), F.col("plan")
    skipped = P.is_proprietary(info)
    no_plan = plan["kind"] == "none"
    chosen = F.col("source_tag").isNotNull()
    stand_in = F.col("canonical").isNotNull()
    failed = F.col("fail_status").isNotNull()
    status = (
        F.when(skipped, "skipped")
        .when(chosen | stand_in, "enriched")
        .when(no_plan, "unresolvable-source")
        .when(failed, F.col("fail_status"))
        .otherwise("unresolvable-license")
    )
    reason = (
        F.when(skipped, F.concat(F.lit("proprietary license '"), info["value"], F.lit("'")))
        .when(chosen, F.lit(""))
        .when(no_plan & stand_in,
              F.concat(F.lit("no source dispatch ("), plan["reason"], F.lit("); used SPDX canonical")))
        .when(no_plan, plan["reason"])
        .when(failed & stand_in, F.concat(F.col("fail_reason"), F.lit(" — fell back to SPDX canonical")))
        .when(failed, F.col("fail_reason"))
        .when(F.col("has_files"), F.lit("suspicious-license-text"))
        .otherwise(F.lit("unresolvable"))
    )
    drift = F.when(
        chosen & ~F.col("curated"),
        evidence.drift_from(evidence.fingerprints(F.col("body")), info["kind"], info["value"], info["all_ids"],
                            F.col("body")),
    )
    settled = (
        rows.withColumn("status", status)
        .withColumn("reason", reason)
        .withColumn("drift", drift)
        .withColumn("final_body", F.coalesce("body", "canonical"))
        .withColumn("source_tag", F.when(
            F.col("status") == "enriched", F.coalesce("source_tag", F.lit("spdx-canonical-fallback"))
        ).otherwise(F.lit("")))
    )
    written = F.when(
        F.col("status") == "enriched",
        P.embed_text(F.col("component"), info["kind"], F.col("final_body"), F.col("copyright"), profile),
    ).otherwise(F.col("component"))
    return settled.withColumn("component", written).select(
        "sbom_id", "ord", "component", *[c for c in ("raw",) if c in rows.columns], "name", "version", "purl", "category",
        "status", "reason", "drift", "source_tag")
