from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from concordat.operators import notices
from concordat.operators import releases as R
from concordat.sources import inventory, sinks
from concordat.sources import releases as S


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(path)


SBOM = {
    "bomFormat": "CycloneDX", "specVersion": "1.5", "metadata": {"tools": []},
    "components": [
        {"name": "zeta", "version": "1", "purl": "pkg:npm/zeta@1", "licenses": [{"license": {"id": "MIT"}}],
         "properties": [{"name": "component:category", "value": "NPM Packages"}, {"name": "component:category", "value": "x"}],
         "externalReferences": [{"type": "vcs", "url": "v"}, {"type": "website", "url": "w"}, {"type": "website", "url": "w2"}]},
        {"name": "alpha beta", "version": "2+local", "licenses": [{"expression": "MIT OR ISC"}]},
        {"name": "gamma"},
    ],
}


def test_inventory_keeps_order_and_defaults(spark, tmp_path):
    path = put(tmp_path / "a.json", SBOM)
    flat = inventory.flatten(inventory.read_components(spark, path)).orderBy("ord").collect()
    assert [(r.name, r.category, r.homepage, r.prefix, r.declared) for r in flat] == [
        ("zeta", "NPM Packages", "w", "pkg:npm/", "MIT"), ("alpha beta", "", None, None, "MIT OR ISC"),
        ("gamma", "", None, None, "(none)")]
    assert inventory.read_components(spark, path, limit=2).count() == 2
    comps, docs = inventory.read_components(spark, path), inventory.read_documents(spark, path)
    out = json.loads(sinks.rebuild_documents(comps, docs, F.expr("array(named_struct('vendor','v','name','n','version','1'))")).first().value)
    assert [c["name"] for c in out["components"]] == ["zeta", "alpha beta", "gamma"]
    assert out["metadata"]["tools"][0]["name"] == "n" and out["specVersion"] == "1.5"


def test_unknown_fields_survive_and_are_redacted(spark, tmp_path):
    doc = {
        "bomFormat": "CycloneDX", "specVersion": "1.5", "serialNumber": "urn:x", "metadata": {"timestamp": "t", "tools": [{"name": "old"}]},
        "components": [
            {"type": "library", "bom-ref": "r", "name": "a", "version": "1", "hashes": [{"alg": "x"}], "scope": None, "rank": 2.5,
             "licenses": [{"license": {"id": "MIT", "url": "u"}}], "notes": {"at": "C:\\Users\\me\\x.c", "C:\\k": ["/home/me/y"]}},
            {"type": "file", "name": "b"}],
        "dependencies": [{"ref": "r", "dependsOn": []}],
    }
    path = put(tmp_path / "a.json", doc)
    comps, docs = inventory.read_components(spark, path), inventory.read_documents(spark, path)
    assert json.loads(sinks.rebuild_documents(comps, docs).first().value) == doc
    stamp = F.expr("array(named_struct('vendor','v','name','n','version','1'))")
    stamped = json.loads(sinks.rebuild_documents(comps, docs, stamp).first().value)
    assert stamped["metadata"] == {"timestamp": "t", "tools": [{"vendor": "v", "name": "n", "version": "1"}]}
    assert stamped["dependencies"] == doc["dependencies"]
    hidden = json.loads(sinks.rebuild_documents(sinks.redact_components(comps), docs).first().value)
    assert hidden["components"][0]["notes"] == {"at": "[REDACTED-PATH]", "C:\\k": ["[REDACTED-PATH]"]}
    for name in ("none", "absent"):
        empty = {"bomFormat": "CycloneDX", "components": []} if name == "none" else {"bomFormat": "CycloneDX"}
        path = put(tmp_path / f"{name}.json", empty)
        out = sinks.rebuild_documents(inventory.read_components(spark, path), inventory.read_documents(spark, path))
        assert json.loads(out.first().value) == {"bomFormat": "CycloneDX", "components": []}
    sinks.write_documents(sinks.document_lines(comps, docs), str(tmp_path / "out"))
    lines = sorted((tmp_path / "out").glob("*/part-*"))
    assert json.loads("".join(p.read_text() for p in lines)) == doc


def test_maps_drop_comments_and_may_be_missing(spark, tmp_path):
    path = put(tmp_path / "c.json", {"_comment": "x", "_note": {"rationale": "no"}, "a@1": {"rationale": "r"}})
    # a comment that is no object makes the whole value unreadable for a strict parser; it must not here
    assert [(r.key, r.rationale) for r in inventory.read_curation(spark, path).collect()] == [("a@1", "r")]
    assert inventory.read_curation(spark, str(tmp_path / "none.json")).count() == 0
    tools = put(tmp_path / "t.json", {"_comment": "x", "t@1": {"source_tarball": "u", "license_files_in_tarball": ["L"], "notice_files_in_tarball": []}})
    row = inventory.read_tools(spark, tools).first()
    assert (row.key, row.tool.license_files_in_tarball) == ("t@1", ["L"])


def test_scans_skip_missing_buckets(spark, tmp_path):
    put(tmp_path / "npm.json", {"files": [
        {"path": "a/LICENSE", "type": "file", "detected_license_expression_spdx": "MIT",
         "license_detections": [{"matches": [{"license_expression_spdx": "MIT", "score": 99.5}, {}]}, {}]},
        {"path": "", "type": "file"}, {"path": "a", "type": "directory"}]})
    rows = inventory.read_scans(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.bucket, r.ord, r.top, r.expr) for r in rows] == [("npm", 0, "a", "MIT"), ("npm", 2, "a", None)]
    assert inventory.read_scans(spark, str(tmp_path / "no")).count() == 0


def test_notices_round_trip(spark, tmp_path):
    flat = inventory.flatten(inventory.read_components(spark, put(tmp_path / "a.json", SBOM)))
    sinks.write_notices(flat, str(tmp_path / "notices"))
    blocks = notices.parse_blocks(inventory.read_notices(spark, str(tmp_path / "notices")))
    assert {(r.name, r.version) for r in blocks.collect()} == {("zeta", "1"), ("alpha beta", "2+local"), ("gamma", "?")}
    picked = spark.createDataFrame([("alpha beta", "2+local"), ("missing", "1")], "name string, version string")
    assert [r.header for r in notices.select_blocks(blocks, picked).collect()] == ["alpha beta 2+local"]
    assert notices.selection_counts(blocks, picked).first()[:] == (1, 2, 1)
    sinks.write_subset_notices(notices.select_blocks(blocks, picked), str(tmp_path / "subset"), "Subset")
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "subset")).collect())
    assert "Total components: 1." in text and "COMPONENT:    alpha beta 2+local" in text


def release(folder, tag, build, flagged=False):
    sha = hashlib.sha256(b"exe").hexdigest()
    put(folder / tag / "release.json", {"tag": tag, "raw_buildid": build, "generated_at": "2026-01-02T03:04:05Z",
                                       "files": [{"filename": "a.exe", "sha256": sha.upper(), "size": 5}]})
    put(folder / tag / "CHECKSUMS", f"{sha} *a.exe\n# comment\n")
    cats = ["undetected", "malicious" if flagged else "undetected", "failure"]
    put(folder / tag / "verdicts_a.json", {
        "tag": tag, "filename": "a.exe", "sha256": sha, "fetched_at": f"2026-01-0{build}T00:00:00Z",
        "last_analysis_stats": {"malicious": int(flagged), "undetected": 2 - flagged, "failure": 1, "type-unsupported": 0},
        "last_analysis_results": {f"e{i}": {"category": c, "engine_update": "20260101", "result": None} for i, c in enumerate(cats)}})
    notes = f"# {tag}\n\n| Field | Value |\n|-------|-------|\n| Depot | 7 |\n| Components | 1{build} (unchanged) |\n"
    put(folder / tag / "NOTES.md", notes if build != "3" else "- **Depot:** 7\n- **Components:** 1,013 (CycloneDX)\n")


def test_release_files(spark, tmp_path):
    for i, tag in enumerate(("r-0.9", "r-0.10", "r-0.11"), 1):
        release(tmp_path, tag, str(i), flagged=i == 3)
    hashes = S.read_hashes(spark, f"{tmp_path}/*/release.json")
    sums = S.read_checksums(spark, f"{tmp_path}/*/CHECKSUMS")
    assert R.checksum_differences(hashes, sums).count() == 0
    assert {r.build for r in hashes.collect()} == {1, 2, 3}
    docs = S.read_verdict_documents(spark, f"{tmp_path}/*/verdicts_*.json")
    v = S.explode_verdicts(docs)
    assert v.count() == 9 and v.where("engine_update is null").count() == 0
    assert R.verdict_reconcile(v, S.stored_stats(docs), ["tag", "filename"]).where("not agrees").count() == 0
    flags = R.retro_flags(v, ["sha256", "engine"], ["fetched_at"]).collect()
    assert [(r.tag, r.engine) for r in flags] == [("r-0.11", "e1")]
    wide = S.pivot_notes(S.read_notes(spark, f"{tmp_path}/*/NOTES.md"), ["tag"], ["Depot", "Components"])
    rel = wide.withColumn("components", S.component_count(F.col("components"))).join(hashes.select("tag", "build"), "tag")
    delta = R.component_delta(rel.select("tag", "build", "components"), ["build"]).orderBy("build").collect()
    assert [(r.prev_tag, r.delta) for r in delta] == [(None, None), ("r-0.9", 1), ("r-0.10", 1001)]
    local = spark.createDataFrame([("r-0.9", "a.exe", "00"), ("r-0.9", "b", "00")], "tag string, filename string, sha256 string")
    assert {r.filename: r.outcome for r in R.verify_hashes(local, hashes).collect()} == {"a.exe": "mismatch", "b": "unpublished"}


ARCHIVE = {k: os.environ.get(f"ARCHIVE_{k.upper()}", "") for k in ("hashes", "sums", "verdicts", "notes")}


@pytest.mark.skipif(not all(ARCHIVE.values()), reason="set ARCHIVE_HASHES, _SUMS, _VERDICTS and _NOTES to path patterns")
def test_published_release_archive(spark):
    """Invariants of a published archive: both hash renderings and both verdict tallies agree."""
    hashes, sums = S.read_hashes(spark, ARCHIVE["hashes"]), S.read_checksums(spark, ARCHIVE["sums"])
    assert hashes.count() == sums.count() > 0
    assert R.checksum_differences(hashes, sums).count() == 0
    docs = S.read_verdict_documents(spark, ARCHIVE["verdicts"])
    v = S.explode_verdicts(docs)
    assert R.verdict_reconcile(v, S.stored_stats(docs), ["tag", "filename"]).where("not agrees").count() == 0
    assert S.pivot_notes(S.read_notes(spark, ARCHIVE["notes"]), ["tag"], ["Components"]).count() > 0
    assert R.retro_flags(v, ["sha256", "engine"], ["fetched_at"]).count() == 0
    print(hashes.count(), docs.count(), {r.category: r["count"] for r in v.groupBy("category").count().collect()})
