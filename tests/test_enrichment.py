from __future__ import annotations

import base64
import hashlib
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from concordat.operators import bodies
from concordat.plans import enrichment
from concordat.settings import Profile
from concordat.sources import archives, inventory, sinks

MIT = "MIT License\n\nCopyright (c) 2020 Ann Author\n\nPermission is hereby granted, free of charge, " + "x " * 100
APACHE = "Apache License\n                           Version 2.0, January 2004 at C:\\build\\here\n" + "y " * 150
ISC = "License ISC permission to use, copy, modify, and/or distribute " + "z " * 100


def key(url: str) -> str:
    return hashlib.sha256(url.encode()).hexdigest()


def tar(files: dict[str, str]) -> bytes:
    box = io.BytesIO()
    with tarfile.open(fileobj=box, mode="w:gz") as t:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))
    return box.getvalue()


def zipped(files: dict[str, str]) -> bytes:
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return box.getvalue()


def comp(name, category, licences, version="1", home=None):
    return {
        "name": name, "version": version, "purl": f"pkg:x/{name}@{version}", "licenses": licences,
        "properties": [{"name": "component:category", "value": category}],
        "externalReferences": [{"type": "website", "url": home}] if home else [],
    }


def lid(x):
    return [{"license": {"id": x}}]


COMPONENTS = [
    comp("matched", "Rust Crates", lid("MIT")),
    comp("dual", "Rust Crates", [{"expression": "MIT OR Apache-2.0"}]),
    comp("longest", "Rust Crates", [{"license": {"name": "Custom"}}]),
    comp("secret", "Rust Crates", [{"license": {"name": "LicenseRef-Proprietary"}}]),
    comp("gone", "Rust Crates", lid("ISC")),
    comp("gone-too", "Rust Crates", lid("NoSuchId")),
    comp("broken", "Rust Crates", lid("Zlib")),
    comp("what", "Mystery", lid("ISC")),
    comp("what-else", "Mystery", [{"license": {"name": "Custom"}}]),
    comp("@s/pkg", "NPM Packages", lid("MIT")),
    comp("wheel", "Python Packages", lid("Apache-2.0")),
    comp("rescued", "Python Packages", lid("MIT"), home="https://github.com/o/rescued"),
    comp("model", "AI Models", lid("Apache-2.0"), home="https://huggingface.co/o/model"),
    comp("tool", "System Tools", lid("GPL-3.0-or-later")),
    comp("html", "ComfyUI Nodes", lid("ISC"), home="https://github.com/o/html/tree/v9"),
    comp("drifts", "Rust Crates", lid("Apache-2.0")),
    comp("drift-curated", "Rust Crates", lid("Apache-2.0")),
]


def crate(name):
    return f"https://crates.io/api/v1/crates/{name}/1/download"


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("enrich")
    (tmp / "a.json").write_text(json.dumps({"bomFormat": "CycloneDX", "components": COMPONENTS}))
    flat = inventory.flatten(inventory.read_components(spark, str(tmp / "a.json")))
    landed = {
        crate("matched"): tar({"matched-1/LICENSE-MIT": MIT, "matched-1/NOTICE": "notice license " + "n " * 120,
                               "matched-1/src/lib.rs": "// Copyright 2019 Header Holder\n" + "\n" * 60 + "// Copyright 2018 Too Deep\n"}),
        crate("dual"): tar({"dual-1/LICENSE-APACHE": APACHE, "dual-1/LICENSE-MIT": MIT}),
        crate("longest"): tar({"longest-1/LICENSE": MIT, "longest-1/COPYING": MIT + "longer"}),
        crate("secret"): tar({"secret-1/LICENSE": MIT}),
        crate("broken"): b"not an archive",
        crate("drifts"): tar({"drifts-1/LICENSE": MIT}),
        crate("drift-curated"): tar({"drift-curated-1/LICENSE": MIT}),
        "https://npm/pkg.tgz": tar({"package/LICENSE": MIT}),
        "https://pypi/wheel.whl": zipped({"wheel.dist-info/LICENSE": APACHE}),
        "https://raw.githubusercontent.com/o/rescued/main/LICENSE": MIT.encode(),
        "https://huggingface.co/o/model/resolve/1/LICENSE.md": APACHE.encode() + b"\xff",
        "https://raw.githubusercontent.com/o/html/v9/LICENSE": b"<!DOCTYPE html>" + ISC.encode(),
        "https://src/tool.tar.gz": tar({"tool-1/COPYING.B": "License B " + "b " * 100, "tool-1/COPYING.A": "License A " + "a " * 100, "tool-1/CREDITS": "people"}),
    }
    rows = [(key(u), bytearray(b)) for u, b in landed.items()]
    registry = [
        (key("https://registry.npmjs.org/@s%2Fpkg/1"), json.dumps({"dist": {"tarball": "https://npm/pkg.tgz"}})),
        (key("https://pypi.org/pypi/wheel/1/json"), json.dumps({"urls": [
            {"packagetype": "bdist_wheel", "url": "https://pypi/wheel.whl"}, {"packagetype": "bdist_wheel", "url": "https://pypi/other.whl"}]})),
    ]
    tool = [("tool@1", ("https://src/tool.tar.gz", "tool-1/", ["COPYING.A", "COPYING.missing", "COPYING.B"], "GPL-3.0-or-later", ["CREDITS"], ["Copyright (c) Tool people", "  copyright (C) tool PEOPLE "], "r"))]
    from concordat.schemas import TOOL_VALUE

    return enrichment.enrich(
        flat,
        spark.createDataFrame(tool, f"key string, tool {TOOL_VALUE}"),
        spark.createDataFrame([("drift-curated@1", "on purpose")], "key string, rationale string"),
        spark.createDataFrame(rows, "key string, content binary"),
        spark.createDataFrame([("ISC", ISC), ("Zlib", "short")], "id string, text string"),
        spark.createDataFrame(registry, "key string, meta string"),
        spark.createDataFrame([(key(crate("gone")), 404, "Not Found"), (key(crate("gone-too")), 404, "Not Found")], "key string, code int, reason string"),
    )


def test_statuses_and_tags(out):
    got = {r.name: (r.status, r.source_tag) for r in out.results.collect()}
    assert got == {
        "matched": ("enriched", "matched"),
        "dual": ("enriched", "concatenated-dual"),
        "longest": ("enriched", "longest-file"),
        "secret": ("skipped", ""),
        "gone": ("enriched", "spdx-canonical-fallback"),
        "gone-too": ("download-404", ""),
        "broken": ("download-error", ""),
        "what": ("enriched", "spdx-canonical-fallback"),
        "what-else": ("unresolvable-source", ""),
        "@s/pkg": ("enriched", "matched"),
        "wheel": ("enriched", "matched"),
        "rescued": ("enriched", "matched"),
        "model": ("enriched", "matched"),
        "tool": ("enriched", "longest-file"),
        "html": ("enriched", "spdx-canonical-fallback"),
        "drifts": ("enriched", "longest-file"),
        "drift-curated": ("enriched", "longest-file"),
    }
    reasons = {r.name: r.reason for r in out.results.collect()}
    assert reasons["gone"] == "HTTP 404: Not Found — fell back to SPDX canonical"
    assert reasons["what"] == "no source dispatch (Unknown category: Mystery); used SPDX canonical"
    assert reasons["secret"] == "proprietary license 'LicenseRef-Proprietary'"
    assert reasons["broken"].startswith(f"RuntimeError: Archive open failed for {crate('broken')}: ")


def texts(out):
    rows = {}
    for r in out.components.collect():
        c = r.component
        if c.licenses and c.licenses[0].expression:
            held = [p.value for p in c.properties if p.name == "component:licenseText"]
            rows[c.name] = base64.b64decode(held[0]).decode() if held else None
        else:
            t = c.licenses[0].license.text
            rows[c.name] = base64.b64decode(t.content).decode() if t else None
    return rows


def test_bodies(out):
    t = texts(out)
    redacted = APACHE.replace("C:\\build\\here", "[REDACTED-PATH]")
    assert t["matched"] == MIT + "\n\n=== NOTICE (NOTICE) ===\n\nnotice license " + "n " * 120
    assert t["dual"] == f"=== LICENSE-MIT (MIT) ===\n\n{MIT}\n\n=== LICENSE-APACHE (Apache-2.0) ===\n\n{redacted}"
    assert t["longest"] == MIT + "longer"
    assert t["secret"] is None and t["broken"] is None
    assert t["gone"] == ISC
    assert t["model"] == redacted + "\ufffd"
    assert t["tool"] == ("=== COPYING.A (GPL-3.0-or-later) ===\n\nLicense A " + "a " * 100 + "\n\n=== COPYING.B (GPL-3.0-or-later) ===\n\nLicense B "
                         + "b " * 100 + "\n\n=== NOTICE (CREDITS) ===\n\npeople")


def test_copyrights_and_drift(out):
    c = {r.component.name: r.component.copyright for r in out.components.collect()}
    assert c["matched"] == "Copyright (c) 2020 Ann Author\nCopyright 2019 Header Holder"
    assert c["tool"] == "copyright (C) tool PEOPLE"
    assert c["gone"] is None and c["secret"] is None
    drift = {r.name: r.drift for r in out.results.collect() if r.drift}
    assert set(drift) == {"drifts", "longest"}  # a licence known by name only is its own candidate
    assert (drift["drifts"].declared, drift["drifts"].detected) == ("Apache-2.0", "MIT")


def test_reports(out, spark, tmp_path):
    report = {(r.section, r["at"]): r.line for r in sinks.enrichment_report(out.results).collect()}
    assert report[2, "0"] == "  total_in_sbom: 17" and report[2, "4"] == "  failed: 3"
    assert report[4, "spdx-canonical-fallback"] == "  spdx-canonical-fallback: 3"
    line = sinks.drift_lines(out.results).first().line
    assert "    detected: MIT" in line and "      | MIT License" in line
    assert bodies.implausible_bodies(out.components).count() == 0
    sinks.write_components(out.components, str(tmp_path / "c"))
    back = inventory.flatten(spark.read.parquet(str(tmp_path / "c")))
    blocks = {r.block.split("\n")[0]: r.block for r in sinks.notices_blocks(back).collect()}
    assert "Ann Author" in blocks["COMPONENT:    matched 1"]
    assert "(license text not embedded; see homepage)" in blocks["COMPONENT:    broken 1"]


def test_header_caps_and_errors(spark):
    files = {f"p-1/src/f{i}.py": f"line{i}\n" * 3 for i in range(7)}
    rows = [("k", "p-1/", "tar.gz", [], bytearray(tar({**files, "p-1/sub/License.txt": "x"}))), ("bad", "", "zip", [], bytearray(b"PK??"))]
    df = spark.createDataFrame(rows, "key string, prefix string, format string, wanted array<string>, content binary")
    got = archives.extract(df, Profile(header_max_files=4)).collect()
    assert sorted((r.key, r.kind, r.rel_path) for r in got if r.kind != "header") == [
        ("bad", "archive-error", None), ("k", "license", "sub/License.txt")]
    assert [r.rel_path for r in sorted((r for r in got if r.kind == "header"), key=lambda r: r.ord)] == [f"src/f{i}.py" for i in range(4)]
    shown = spark.createDataFrame([(bytearray(b"a\nb\nc"),)], "c binary").select(archives.header_text(F.col("c"), 2)).first()[0]
    assert shown == "a\nb"
