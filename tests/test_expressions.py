from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from concordat.functions import spdx


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


CASES = {
    "split_expression": {
        "MIT": ["MIT"],
        "(MIT or Apache-2.0) AND  ISC": ["MIT", "Apache-2.0", "ISC"],
        "Apache-2.0 WITH LLVM-exception OR MIT": ["Apache-2.0 WITH LLVM-exception", "MIT"],
        "": [],
        "ORACLE AND ANDY": ["ORACLE", "ANDY"],
        "MIT\u00a0OR ISC": ["MIT", "ISC"],
    },
    "normalise_loose": {" GPL_3.0 only ": "gpl-3.0only", "": "", None: "", "MIT": "mit"},
    "normalise_spdx": {"GPL-3.0": "gpl-3.0-only", "LGPL_2.1": "lgpl-2.1-only", "AGPL-3.0-only": "agpl-3.0-only"},
    "normalise_family": {"Apache-2.0 WITH LLVM-exception": "apache-2.0", "GPL-2.0-or-later": "gpl-2.0", "LGPL-3.0-only ": "lgpl-3.0"},
    "collapse_repeats": {
        "MIT AND MIT": "MIT", "MIT AND mit AND MIT": "MIT", "MIT AND ISC": "MIT AND ISC", "": "", "MIT": "MIT",
        None: None,
    },
    "drop_commercial_alternative": {
        "(GPL-3.0-only OR LicenseRef-scancode-commercial-license) AND GPL-3.0-only": "GPL-3.0-only",
        "LicenseRef-scancode-commercial-license OR MIT": "MIT",
        "MIT OR LicenseRef-scancode-commercial-license": "MIT",
        # only a single token inside the parentheses is unwrapped
        "(A AND B OR LicenseRef-scancode-commercial-license) AND C": "(A AND B) AND C",
    },
    "drop_internal_refs": {
        "LicenseRef-scancode-unknown": "",
        "MIT AND LicenseRef-scancode-x OR ISC": "MIT OR ISC",
        "LicenseRef-scancode-x AND MIT": "MIT",
        "(MIT OR LicenseRef-scancode-x) AND ISC": "(MIT AND ISC",  # parentheses are not balanced
        "MIT OR ISC": "MIT OR ISC",
    },
    "filter_false_positives": {
        "GPL-3.0-only AND GPL-3.0-or-later": "GPL-3.0-only",
        "GPL-3.0-or-later AND GPL-3.0-only": "GPL-3.0-only",
        "GPL-2.0-only AND GPL-2.0-or-later": "GPL-2.0-only",
        "GPL-2.0-or-later AND GPL-2.0-only": "GPL-2.0-or-later AND GPL-2.0-only",
        "(GPL-3.0-only OR LicenseRef-scancode-commercial-license) AND GPL-3.0-only": "GPL-3.0-only",
        "MIT AND LicenseRef-scancode-x AND mit": "MIT",
        "LicenseRef-scancode-x": "",
        "": "",
    },
}


@pytest.mark.parametrize("name", CASES)
def test_literal_rows(spark, name):
    cases = CASES[name]
    assert run(spark, getattr(spdx, name), list(cases)) == list(cases.values())


# (declared, detected) pairs a published review settled as mismatches
MISMATCHES = [
    ("MIT", "(MIT AND BSD-3-Clause) AND MIT AND BSD-3-Clause AND ISC"), ("Apache-2.0", "BSD-2-Clause"),
    ("BSD-2-Clause", "BSD-3-Clause"), ("MIT", "Apache-2.0"), ("MIT", "BSD-3-Clause OR GPL-2.0-only"),
    ("PSF-2.0", "OFL-1.1"), ("BSD-3-Clause", "(NCSA AND BSD-3-Clause) AND BSD-3-Clause"),
    ("Apache-2.0 OR BSD-2-Clause", "BSD-3-Clause OR Apache-2.0"), ("MIT", "Python-2.0 AND MIT"),
]
ACKS = [
    ("MIT", "MIT"), ("GPL-3.0", "GPL-3.0-only"), ("MIT OR Apache-2.0", "Apache-2.0"), ("(MIT OR ISC)", "isc"),
    ("Apache-2.0 AND MIT", "MIT"), ("GPL-2.0 OR MIT", "GPL-2.0-only"),
]


def test_verdicts(spark):
    rows = [(*p, "MISMATCH") for p in MISMATCHES] + [(*p, "ACK") for p in ACKS]
    rows += [("MIT", "", "NO-DETECTION"), ("MIT", None, "NO-DETECTION"), ("(none)", "MIT", "MISMATCH")]
    df = spark.createDataFrame(rows, "declared string, detected string, want string")
    got = df.select("*", spdx.verdict(F.col("declared"), F.col("detected")).alias("v")).select("want", "v.*").collect()
    assert [r.want for r in got] == [r.verdict for r in got]
    assert got[0].detail == f"declared='MIT' vs detected='{MISMATCHES[0][1]}'"
    assert got[len(MISMATCHES) + 2].detail == "detected 'Apache-2.0' is one of the declared alternatives in 'MIT OR Apache-2.0'"


def test_random_expressions(spark):
    rng = random.Random(7)
    terms = ["MIT", "mit", "ISC", "GPL-3.0-only", "LicenseRef-scancode-a", "LicenseRef-scancode-commercial-license"]
    exprs = []
    for _ in range(400):
        parts = [rng.choice(terms)]
        for _ in range(rng.randrange(5)):
            parts += [rng.choice(["AND", "OR"]), rng.choice(terms)]
        exprs.append(" ".join(parts))
    once = run(spark, spdx.collapse_repeats, exprs)
    assert run(spark, spdx.collapse_repeats, once) == once
    for raw, out in zip(exprs, run(spark, spdx.filter_false_positives, exprs), strict=True):
        assert "LicenseRef-scancode-" not in out, raw
        tokens = out.split(" ") if out else []
        assert all(t in ("AND", "OR") for t in tokens[1::2]) and not any(t in ("AND", "OR") for t in tokens[::2]), (raw, out)
