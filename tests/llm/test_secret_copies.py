"""Credentials that many documents of one source have."""

from __future__ import annotations

import time

from concordat.llm import secrets


def test_copies_under_one_owner_are_examples(stored):
    copied, few = "Zq8vLw3xKp0T", "Hn4tYb7uRm2s"
    rows = [(i, f"password={copied}", "hot") for i in range(secrets.MAX_REPOSITORIES + 1)]
    rows += [(100 + i, f"password={few}", "hot") for i in range(secrets.MAX_REPOSITORIES)]
    rows += [(100, f"password={few}", "hot")] * 5  # repeated rows are one repository
    got = secrets.scan(stored(rows, "doc_id long, text string, source string")).collect()
    assert {(r.n_live, r.n_example) for r in got if r.doc_id < 100} == {(0, 1)}
    assert {(r.n_live, r.n_example) for r in got if r.doc_id >= 100} == {(1, 0)}


def test_many_matches_in_one_text(stored):
    """A hundred thousand matches of each of two kinds: the work follows their number, not its square."""
    n = 100_000
    texts = [" ".join(f"token=é{i:08d}Qz é" for i in range(2)), " ".join(f"token=Qz{i:08d}! {i:032x}" for i in range(n))]
    docs = stored([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    began = time.time()
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert time.time() - began < 60
    assert (got[0].n_assign, got[1].n_assign, got[1].n_access, got[1].n_hex) == (0, n, 0, n)
    spans = [x.split(":") for x in got[1].base.split(",")]
    assert len(spans) == 2 * n
    for i in (0, 1, 2, 3, 99_998, 2 * n - 2, 2 * n - 1):
        kind, start, end = spans[i][0], int(spans[i][1]), int(spans[i][2])
        assert texts[1][start:end] == (f"token=Qz{i // 2:08d}" if kind == "assign" else f"{i // 2:032x}")
