"""The registered queries on the smallest tables, against SQL twins or brute force."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tests.llm import plain
from tests.oracle import compare, connect
from tokenizers import Tokenizer

from concordat.llm import chat, line_dedup
from concordat.llm.queries import INTRUDER, QUERIES, TWINS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def texts(con):
    return {d: t or "" for d, t in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("name", TWINS)
def test_twin(spark, con, name):
    n, issues = compare(QUERIES[name](spark, FOLDER), con, TWINS[name])
    assert n and not issues, issues


def test_fingerprints_and_components(spark, texts):
    prints = {
        d: plain.simhash([xxhash.xxh64_intdigest(s, 42) for s in plain.shingles(plain.WORD.findall(plain.ascii_lower(t)), 3)])
        for d, t in texts.items()
    }
    lead = plain.groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(lambda: 1 << 60)
    for d, p in prints.items():
        least[lead[p]] = min(least[lead[p]], d)
    want = {d: (f"{p:016x}", least[lead[p]]) for d, p in prints.items()}
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op2_simhash_pivots"](spark, FOLDER).collect()} == want


def test_secret_spans(spark, texts):
    kinds = (
        ("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII), 2, 8),
        ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 1, 16),
        ("hex", re.compile(r"([0-9a-f]+)"), 1, 32),
    )
    for r in QUERIES["op4_secret_owners"](spark, FOLDER).collect():
        found = sorted(
            (m.start(), k, name, m.end())
            for k, (name, p, g, least) in enumerate(kinds) for m in p.finditer(texts[r.doc_id]) if len(m[g]) >= least)
        base = [f"{n}:{a}:{z}" for a, _, n, z in found]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(f[1] == k for f in found) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("live:")] == base


def test_fuzzy_lines(spark, texts):
    places = defaultdict(list)
    for d, t in texts.items():
        for i, line in enumerate(line_dedup.normalised(t)):
            if len(line) >= line_dedup.MIN_CHARS:
                places[line].append((d, i))
    lines = sorted(places, key=len)
    # All pairs by edit distance alone; `within` is held against plain.edit_distance in test_lines.py.
    links = [
        (a, b) for i, b in enumerate(lines) for a in lines[:i]
        if 5 * (len(b) - len(a)) <= len(b) and line_dedup.within(a, b, len(b) // 5)]
    linked = set(links)
    lead = plain.groups(lines, lambda a, b: (a, b) in linked or (b, a) in linked)
    group, home = defaultdict(set), {}
    for line in lines:
        group[lead[line]] |= set(places[line])
        home.update((at, lead[line]) for at in places[line])
    want = {at for g in group.values() for at in sorted(g)[1:]}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed_lines) for r in QUERIES["op5_fuzzy_lines"](spark, FOLDER).collect()}
    gone = {(d, int(i)) for d, (_, _, told) in got.items() for i in told.split(",") if i}
    assert {d: v[0] for d, v in got.items()} == {d: t.count("\n") + 1 for d, t in texts.items()}
    assert all(n == len([x for x in told.split(",") if x]) for _, n, told in got.values())
    assert gone <= want and len(gone) >= 0.9 * len(want)
    assert {at for spots in places.values() for at in sorted(spots)[1:]} <= gone


def test_chat_read_back(spark, con):
    rows = con.execute("SELECT conv_id, turn, role, coalesce(text, '') FROM conversations ORDER BY 1, 2").fetchall()
    rows += [(-1, 0, "user", INTRUDER), (-1, 1, "assistant", INTRUDER)]
    turns = defaultdict(list)
    for c, _, role, text in rows:
        turns[c].append((role, text))

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    got = {r.conv_id: r for r in QUERIES["op6_event_log"](spark, FOLDER).collect()}
    assert set(got) == set(turns)
    for c, told in turns.items():
        learnt = "".join(t for role, t in told if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(told), digest("".join(f"{a}\n{b}\n" for a, b in told)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), digest(learnt))
        assert r.formatted_chars >= sum(len(a) + len(b) + len(chat.START + chat.END) + 2 for a, b in told)


def test_token_counts_and_files(spark, texts, library):
    counts = {r.doc_id: r for r in QUERIES["op7_heap_merge_counts"](spark, FOLDER).collect()}
    files = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_mixing_coder"](spark, FOLDER).collect()}
    start = 0
    for d, t in texts.items():
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert tuple(counts[d]) == (d, len(t.encode()), len(ids) - 1, len(ids) - 1 > 2048)
        assert files[d] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(counts) == len(files) == len(texts)


def test_quality_counts(spark, texts):
    for r in QUERIES["op8_line_first"](spark, FOLDER).collect():
        assert tuple(r)[1:7] == plain.quality_counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_benchmark_windows(spark, con, texts):
    want = plain.benchmark_hits(texts, dict(con.execute("SELECT item_id, text FROM benchmark").fetchall()))
    got = {(r.doc_id, r.item_id): (r.similarity, r.window_start) for r in QUERIES["op10_simhash_windows"](spark, FOLDER).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
