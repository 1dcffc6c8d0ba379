from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from concordat.functions import components as P
from concordat.functions import evidence, paths, urls
from concordat.functions import text as T
from concordat.functions.documents import redact_document
from concordat.operators import bodies, copyrights, counts, matching, ordering, scans, upstream
from concordat.operators import releases as R


def one(spark, value, fn, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("small", [False, True])
def test_previous_row_with_a_hot_key(spark, small):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}", rng.randrange(50), i, rng.choice("abc")) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v string")
    got = ordering.previous_row(df, ["k"], ["t", "i"], ["v"], small_groups=small).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "i", "v"]).sort_values(["k", "t", "i"])
    pdf["prev_v"] = pdf.groupby("k")["v"].shift(1)
    want = pdf.set_index("i")["prev_v"].where(lambda s: s.notna(), None).to_dict()
    assert got.set_index("i")["prev_v"].where(lambda s: s.notna(), None).to_dict() == want


@pytest.mark.parametrize("small", [False, True])
def test_previous_row_without_keys(spark, small):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("o"), (F.col("id") % 5).alias("v"))
    got = ordering.previous_row(df, [], ["o"], ["o"], small_groups=small)
    assert got.where("prev_o is null").count() == 1
    assert got.where("prev_o is not null and prev_o + 1 <> o").count() == 0


def test_global_rank(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = [r.k for r in ordering.global_rank(df, ["k"], "n").orderBy("n").collect()]
    assert got == sorted(got) and len(got) == 5000
    assert ordering.global_rank(df, ["k"], "n").agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 5000, 5000)


def test_matching_equals_spelling_by_spelling_probing(spark):
    rng = random.Random(11)

    def name():
        return "".join(rng.choice(["a", "B", "-", "_"]) for _ in range(rng.randrange(1, 5)))

    comps = [(rng.choice(["pkg:npm/", "pkg:pypi/", None]), i, name(), str(i), "MIT") for i in range(150)]
    dirs = sorted({(rng.choice(["npm", "python"]), name()) for _ in range(200)})
    index: dict[tuple[str, str], str] = {}
    for prefix, _, n, version, _ in comps:
        if prefix:
            low = n.lower()
            for key in (low, low.replace("_", "-"), low.replace("-", "_")):
                index.setdefault((prefix, key), version)
    want = {}
    for bucket, top in dirs:
        prefix = {"npm": "pkg:npm/", "python": "pkg:pypi/"}[bucket]
        low = top.lower()
        want[bucket, top] = index.get((prefix, low.replace("_", "-"))) or index.get((prefix, low))
    got = matching.match_dirs(
        spark.createDataFrame(dirs, "bucket string, top string"),
        spark.createDataFrame(comps, "prefix string, ord bigint, name string, version string, declared string"),
    ).collect()
    assert {(r.bucket, r.top): r.version for r in got} == want
    assert any(want.values()) and not all(want.values())


FILES = [
    # bucket, ord, path, type, expr
    ("npm", 1, "a/LICENSE", "file", "MIT"),
    ("npm", 2, "a/sub/COPYING", "file", "ISC"),  # still a root licence file; the last one wins
    ("npm", 3, "a/x/y/LICENSE", "file", "Zlib"),  # too deep
    ("npm", 4, "a/LICENSE.md", "file", None),  # seen, no detection
    ("npm", 5, "b/x.js", "file", "MIT"),
    ("npm", 6, "b/y.js", "file", "ISC"),
    ("npm", 7, "b/z.js", "file", "ISC AND ISC"),
    ("npm", 8, "b/w.js", "file", "MIT AND MIT"),  # tie: MIT was seen first
    ("npm", 9, "c/LICENSE", "file", "LicenseRef-scancode-x"),  # filtered to nothing: falls to the mode
    ("npm", 10, "c/m.js", "file", "BSD-3-Clause"),
    ("npm", 11, "c/d", "directory", "GPL-3.0-only"),
    ("npm", 12, "e", "directory", None),
    ("npm", 13, "", "file", "MIT"),
]


def test_dominant_licence_rules(spark):
    df = spark.createDataFrame(FILES, "bucket string, ord bigint, path string, type string, expr string")
    got = {r.top: r for r in scans.aggregate_dirs(df).collect()}
    assert {t: r.dominant for t, r in got.items()} == {"a": "ISC", "b": "MIT", "c": "", "e": ""}
    assert (got["a"].n_files, got["a"].n_with_license, got["a"].license_file_seen) == (4, 3, True)
    assert (got["c"].license_file_detected, got["c"].n_files) == ("", 2)
    assert (got["e"].n_files, got["e"].license_file_seen) == (0, False)


def test_path_rules(spark):
    df = spark.createDataFrame([("pkg/sub/LICENSE",), ("pkg/a/b/LICENSE",), ("LICENSE",), ("x/licence-mit.txt",), ("x/COPYRIGHTS",)], "p string")
    got = df.select(paths.is_root_licence(F.col("p")), paths.is_licence_file(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, True), (True, True), (False, True), (False, False)]


def test_text_rules(spark):
    assert one(spark, "License " + "x" * 192, T.is_plausible_licence) is True
    assert one(spark, "License " + "x" * 191, T.is_plausible_licence) is False
    assert one(spark, "<HTML> license" + "x" * 300, T.is_plausible_licence) is False
    assert one(spark, None, T.is_plausible_licence) is False
    assert one(spark, b"x" * 49, T.is_probe_content, "v binary") is False
    assert one(spark, b"\xff" * 60, T.is_probe_content, "v binary") is True
    assert one(spark, b"ok\xff\xfe!", T.decode_utf8, "v binary") == "ok\ufffd\ufffd!"
    assert one(spark, "see C:\\a\\b 'd:\\x' /home/u/y, /mnt/z", T.redact_paths) == (
        "see [REDACTED-PATH] '[REDACTED-PATH]' [REDACTED-PATH] [REDACTED-PATH]")
    assert one(spark, "key ABC", lambda c: T.redact_paths(c, ["# note", "[bad", "A.C"])) == "key [REDACTED-PATH]"
    assert one(spark, "é" * 200, T.encode_text).count("\n") == 0
    assert one(spark, "not base64!", T.decode_text) is None
    assert one(spark, "it's", T.quoted) == '"it\'s"'
    assert one(spark, "a\nb\r\nc\n", lambda c: T.head_lines(c, 2)) == ["a", "b"]
    assert one(spark, "a\nb\n", lambda c: T.head_lines(c, 5)) == ["a", "b"]
    assert one(spark, "", lambda c: T.head_lines(c, 5)) == []


def test_urls(spark):
    assert one(spark, "@a/b c+d~*é", urls.quote_path) == "%40a/b%20c%2Bd~%2A%C3%A9"
    assert one(spark, "https://huggingface.co/o/r/tree/main?x#y", urls.hub_repo_id) == "o/r"
    assert one(spark, "https://huggingface.co/o/", urls.hub_repo_id) is None
    assert one(spark, "https://github.com/o/r/", urls.git_repo_id) == "o/r"
    assert one(spark, None, urls.git_repo_id) is None


def test_copyright_rules(spark):
    text = (
        "Copyright (c) 2020, 2021-2022 Jane Doe,\n(c)\u00a02019 ACME Inc;: \nCOPYRIGHT 2020 no\n"
        "Copyright 2018 Bob\n\nCopyright 2018   BOB\n© 2001 " + "x" * 400 + "\nCopyright (c) 2020\nName On Next Line\n"
    )
    got = one(spark, text, evidence.copyright_lines)
    assert got[0] == "Copyright (c) 2020, 2021-2022 Jane Doe"
    assert got[1] == "(c) 2019 ACME Inc"
    assert "Copyright 2018 Bob" in got and "Copyright 2018 BOB" in got
    assert "Copyright (c) 2020 Name On Next Line" in got
    assert max(map(len, got)) <= 250
    blobs = spark.createDataFrame([("c", 1, text), ("c", 2, "copyright Copyright 2018 bob")], "component_id string, blob_ord int, text string")
    seeds = spark.createDataFrame([("c", 0, "Copyright 2018 bOB "), ("c", 1, "Copyright 2018 boB")], "component_id string, seed_ord int, line string")
    rows = {r.line_key: r.line for r in copyrights.harvest(blobs, seeds).collect()}
    assert rows["copyright 2018 bob"] == "Copyright 2018 boB"  # the last seed spelling stays
    joined = copyrights.joined(copyrights.harvest(blobs, seeds)).first()
    assert joined.copyright.split("\n") == [rows[k] for k in sorted(rows)]


def test_drift_rules(spark):
    gpl = "GNU General Public License\n                       Version 3, 29 June 2007"
    dual = "The Rust Project is dual-licensed under Apache 2.0 and MIT"
    rows = [
        (gpl, "id", "GPL-3.0-or-later", ["GPL-3.0-or-later"], False),
        (gpl, "id", "MIT", ["MIT"], True),
        (gpl, "name", "gpl-3.0", [], False),
        (gpl, "none", "", [], False),
        (dual, "expression", "ISC OR MIT", ["ISC", "MIT"], False),
        (dual, "id", "Zlib", ["Zlib"], True),
        ("nothing known", "id", "MIT", ["MIT"], False),
        ("unicode license v3 permission is hereby granted, free of charge", "id", "Unicode-3.0", ["Unicode-3.0"], False),
    ]
    df = spark.createDataFrame(rows, "t string, kind string, value string, ids array<string>, want boolean")
    drift = evidence.drift_from(evidence.fingerprints(F.col("t")), F.col("kind"), F.col("value"), F.col("ids"), F.col("t"))
    got = df.select("want", drift.alias("d")).collect()
    assert [r.d is not None for r in got] == [r.want for r in got]
    assert got[5].d.detected == "Apache-2.0 OR MIT"


def test_best_file_prefers_names_then_content(spark):
    files = [
        ("c", 0, "COPYING", "Permission is hereby granted, free of charge"),
        ("c", 1, "LICENSE-MIT", "whatever"),
        ("c", 2, "LICENSE-APACHE", "Apache License"),
        ("c", 3, "NOTICE", "n" * 50),
    ]
    df = spark.createDataFrame(files, "component_id string, ord bigint, rel_path string, text string")
    h = matching.rule_hits(df, ["component_id"]).first()
    assert (h.hint_ord["MIT"], h.hint_ord["Apache-2.0"], h.phrase_ord["MIT"], h.longest_ord) == (1, 2, 0, 3)
    comps = [("c", "expression", "MIT OR Apache-2.0 OR MIT", ["MIT", "Apache-2.0", "MIT"])]
    chosen = bodies.choose(spark.createDataFrame(comps, "component_id string, kind string, value string, all_ids array<string>"), df)
    body = bodies.assemble(bodies.segments(chosen, df)).first()
    assert body.source_tag == "concatenated-dual"
    assert body.body == (
        "=== LICENSE-MIT (MIT) ===\n\nwhatever\n\n=== LICENSE-APACHE (Apache-2.0) ===\n\nApache License\n\n"
        f"=== NOTICE (NOTICE) ===\n\n{'n' * 50}")


def test_repo_plan_keeps_the_first_licence(spark):
    rows = [("r/a", 1, "MIT", "mit"), ("r/a", 2, "Apache-2.0", "apache-2.0"), ("r/a", 3, "MIT", "mit"), ("r/b", 4, "GPL-3.0-only", "gpl-3.0"), ("r/b", 5, "GPL-3.0", "gpl-3.0"), ("r/c", 6, "Zlib", None)]
    df = spark.createDataFrame(rows, "repo_id string, ord bigint, recorded string, hub string")
    got = {r.repo_id: (r.license, r.spdx, r.conflict, r.n_components) for r in upstream.repo_plan(df).collect()}
    assert got == {"r/a": ("mit", "MIT", True, 2), "r/b": ("gpl-3.0", "GPL-3.0-only", False, 2)}


def test_redaction_reaches_every_string(spark):
    df = spark.createDataFrame(
        [((["/home/a", None], {"k": "/mnt/x"}, [("d:\\y", 3)], None),)],
        "doc struct<a:array<string>,m:map<string,string>,s:array<struct<t:string,n:int>>,z:string>")
    got = df.select(redact_document(F.col("doc"), df.schema["doc"].dataType).alias("d")).first().d.asDict(recursive=True)
    r = "[REDACTED-PATH]"
    assert got == {"a": [r, None], "m": {"k": r}, "s": [{"t": r, "n": 3}], "z": None}


def test_counts_are_zero_filled(spark):
    df = spark.createDataFrame([("ACK",)], "verdict string")
    assert {r.verdict: r.n for r in counts.verdict_counts(df, ("ACK", "MISMATCH")).collect()} == {"ACK": 1, "MISMATCH": 0}
    empty = df.where("verdict = 'x'")
    assert {r.n for r in counts.verdict_counts(empty, ("ACK", "MISMATCH")).collect()} == {0}


def test_errata_and_reconcile(spark):
    pub = spark.createDataFrame([("a", 1, "MIT"), ("a", 9, "MIT"), ("b", 1, "ISC")], "name string, release_seq int, license string")
    err = spark.createDataFrame([("a", "GPL-3.0", 1, 5)], "name string, corrected string, lo_seq int, hi_seq int")
    got = {(r.name, r.release_seq): (r.effective_license, r.corrected) for r in R.apply_errata(pub, err).collect()}
    assert got == {("a", 1): ("GPL-3.0", True), ("a", 9): ("MIT", False), ("b", 1): ("ISC", False)}
    v = spark.createDataFrame([("f", "undetected")] * 3, "filename string, category string")
    stats = spark.createDataFrame([("f", "undetected", 3), ("f", "malicious", 0), ("f", "failure", 1)], "filename string, category string, stored bigint")
    assert {r.category: r.agrees for r in R.verdict_reconcile(v, stats, ["filename"]).collect()} == {
        "undetected": True, "malicious": True, "failure": False}


def test_sample_with_rest(spark):
    lines = [r.line for r in ordering.sample_with_rest(spark.range(5), ["id"], F.col("id").cast("string"), 3).collect()]
    assert lines == ["0", "1", "2", "... and 2 more"]
    assert ordering.sample_with_rest(spark.range(3), ["id"], F.col("id").cast("string"), 3).count() == 3


def test_first_property_and_licence_info(spark):
    schema = "p array<struct<name:string,value:string>>, l array<struct<license:struct<id:string,name:string>,expression:string>>"
    rows = [
        ([("a", "1"), ("a", "2")], [(None, "MIT OR ISC")]),
        ([], [((None, None), None), ((None, "Custom"), None)]),
        (None, None),
        ([("b", None)], [(("", "x"), None)]),
    ]
    df = spark.createDataFrame(rows, schema)
    got = df.select(
        P.first_property(F.col("p"), "a").alias("a"), P.licence_info(F.col("l")).alias("i"),
        P.audit_label(F.col("l")).alias("label")).collect()
    assert [r.a for r in got] == ["1", None, None, None]
    assert [(r.i.kind, r.i.value, r.i.all_ids) for r in got] == [
        ("expression", "MIT OR ISC", ["MIT", "ISC"]), ("name", "Custom", []), ("none", "", []), ("id", "", [""])]
    assert [r.label for r in got] == ["MIT OR ISC", "Custom", "(none)", "x"]
