"""Whitening, cross-tokenizer alignment and substring dedup against brute force, on odd rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm import plain
from tests.llm.conftest import odd_rows
from tokenizers import Tokenizer

from concordat.llm import alignment, substrings, whitening
from concordat.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROWS = odd_rows()


# substring dedup


def repeats(rows, window):
    """Kept words and removed runs per row, by looking at all windows in order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        w = plain.WORD.findall(rows[i][1] or "")
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = (" ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone))
    return out


def shared_passages(seed, n=120):
    rng = random.Random(seed)
    passages = [[f"p{k}w{rng.randrange(50)}" for _ in range(rng.randrange(15, 60))] for k in range(5)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randrange(6)):
            w += rng.choice(passages) if rng.random() < 0.5 else [f"x{rng.randrange(10_000)}" for _ in range(rng.randrange(40))]
        rows.append((None if i % 17 == 3 else rng.randrange(n), rng.choice([" ", "\n", " \t"]).join(w) + rng.choice(["", " ", "\x1c \x85"])))
    return rows


def digest(found):
    return Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in found)


@pytest.mark.parametrize("size,segment,bucket", [(1 << 20, 1 << 20, 1 << 20), (300, 1000, 50)])
def test_substrings(spark, stored, size, segment, bucket):
    rows = shared_passages(5)
    docs = stored(rows, "doc_id long, text string").coalesce(1)
    found = substrings.without_repeats(docs, 20, size=size, segment_text=segment, bucket=bucket).collect()
    # One file read in order, so ties are settled by the order of the rows there.
    rows = [tuple(r) for r in docs.collect()]
    want = repeats(rows, 20)
    assert Counter((r.n_words, r.n_removed) for r in found) == Counter(v[1:] for v in want.values())
    assert digest(found) == Counter((rows[i][0], *want[i]) for i in want)
    for r in found:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    words = {(r.doc_id, r.n_words): r for r in found}
    for d, t in rows:
        w, r = plain.WORD.findall(t), words[d, len(plain.WORD.findall(t))]
        if sum(1 for q in found if (q.doc_id, q.n_words) == (d, len(w))) == 1:
            gone = {k for s in r.removed for k in range(s.start, s.end)}
            assert " ".join(x for k, x in enumerate(w) if k not in gone) == r.text


def test_substrings_odd_rows(odd, none):
    found = substrings.without_repeats(odd).collect()
    assert len(found) == len(ROWS)
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    full = [x for x in ROWS if x[0] == 1][0][1]
    # The null doc_id is the least, so its copy of the shared text stays and all others go.
    assert [r.n_removed for r in by[1]] == [len(full.split())] * 2 and by[2][0].text == ""
    assert {r.n_removed for r in by[None]} == {0} and by[3][0].text == by[4][0].text == by[6][0].text == ""
    assert by[7][0].text == "one"
    assert substrings.without_repeats(none).count() == 0


def test_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    sketch = np.zeros((2, 1 << substrings.CELL_BITS), np.uint8)
    pool = rng.integers(0, 1 << 32, 50_000, dtype=np.uint32)
    truth = Counter()
    sent = []
    for _ in range(20):
        x, n = np.unique(rng.choice(pool, 5_000), return_counts=True)
        substrings.merge(sketch, x, n > 1)
        truth.update(dict(zip(x.tolist(), n.tolist(), strict=True)))
        sent.append(x)
    seen = np.unique(np.concatenate(sent))
    low = np.minimum([truth[v] for v in seen.tolist()], 2)
    got = substrings.estimate(sketch, seen)
    assert (got >= low).all() and (got > low).mean() < 0.01


def test_rolling_hash():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    twice = np.concatenate([h, h])
    for n in (1, 2, 5, 16, 20, 31):
        r = substrings.rolling(twice, n, substrings._BASES[0])
        assert len(r) == 120 - n + 1 and (r[: 60 - n] == r[60 : 120 - n]).all() and len(set(r.tolist())) == 60


# alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def whole(libraries, text):
    """Groups and links of a text from the libraries' own encoding of all of it, or None."""
    a, b = libraries
    symbol = {c: i for i, c in enumerate(alignment.byte_symbols())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)
    bytes_a = [bytes(symbol[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]
    want = (" " + text).encode()
    if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None

    def ranges(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    ra, rb = ranges(bytes_a), ranges(bytes_b)
    cuts = sorted({e for _, e in ra} & {e for _, e in rb})
    groups, low = [], 0
    for c in cuts:
        groups.append(([i for i, r in zip(ids_a, ra, strict=True) if low < r[1] <= c], [i for i, r in zip(ids_b, rb, strict=True) if low < r[1] <= c]))
        low = c
    links = []
    for i, x in zip(ids_a, ra, strict=True):
        links += [(i, j) for j, y in zip(ids_b, rb, strict=True) if x[0] < y[1] and y[0] < x[1]]
    return len(ids_a), len(ids_b), groups, links


def text_of(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ODD_TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "  a  b   c\n\n d\te ", "it's we'll x'd", "naïve café ﬁne ½", "▁ low line", "<|endoftext|> and <s></s><unk>", "日本語 テキスト、です。",
    "a\x1c b\x85 c d  e​ f", "̀ x", "😀😀 👩‍👩‍👧", "a" * 5000, " " * 3000, "x " * 2000, "\r\n\r\n", "\x00\x01", "ſ ı İ", "1234567 8,9.0", "<0x0A> <0xZZ>", "Ω Å K",
]


def fuzzed():
    rng = random.Random(7)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'", ".", "é", "é", "世", " ", "　", "\x1c", "1", "▁", "<", "0x", ">", "﻿", "ß"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]


def test_alignment(spark, stored, libraries):
    texts = ODD_TEXTS + fuzzed()
    docs = stored([(i, t, 0) for i, t in enumerate(texts)] + [(None, "a a", 1), (0, "a a", 1)], "doc_id long, text string, n long").coalesce(2)
    per_doc, pairs = alignment.links(docs, PATH_A, PATH_B, size=2000, bucket=100)
    want = [whole(libraries, t) if t else None for t in [*texts, "a a", "a a"]]
    keys = [*range(len(texts)), None, 0]
    count = Counter(p for w in want if w for p in w[3])
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    expect = Counter()
    for k, w in zip(keys, want, strict=True):
        if w is None:
            expect[k, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        a, b, groups, links = w
        best = sum(count[p] == top[p[1]] for p in links)
        expect[k, a, b, len(groups), len(links), best, sum(count[p] for p in links), hashlib.sha256(text_of(groups).encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in per_doc.collect())
    assert got == expect, (list((got - expect).items())[:3], list((expect - got).items())[:3])
    assert {(r.a, r.b): (r.n, r.best) for r in pairs.collect()} == {p: (n, n == top[p[1]]) for p, n in count.items()}
    listed = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in alignment.groups(docs, PATH_A, PATH_B).where("doc_id > 0").collect()}
    assert listed == {k: (w[2] if w else []) for k, w in zip(keys, want, strict=True) if k}


def test_alignment_odd_rows(odd, none, libraries):
    rows = alignment.links(odd, PATH_A, PATH_B)[0].collect()
    assert len(rows) == len(ROWS)
    want = Counter((r[0], len(w[2]) if (w := whole(libraries, r[1]) if r[1] and len(r[1]) < 9999 else None) else 0) for r in ROWS if r[0] != 5)
    assert Counter((r.doc_id, r.n_groups) for r in rows if r.doc_id != 5) == want
    assert alignment.links(none, PATH_A, PATH_B)[0].count() == 0 == alignment.groups(none, PATH_A, PATH_B).count()


@pytest.mark.parametrize("text", ["a" + " " * 150_000 + "b", "\n" * 120_000, "é" * 60_000, "x y. " * 40_000])
def test_long_texts_have_the_library_s_ids(libraries, text):
    (found,) = alignment.Pair(PATH_A, PATH_B).encoded([text])
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text, num_threads=1)
    assert found[0].tolist() == a and found[1].tolist() == b


def test_slices_link_what_overlaps():
    # bytes: aab|b / a|abb|... ends 2,3,6 against 1,3,4,6
    groups, links = alignment.align([1, 2, 3], [7, 8, 9, 10], [2, 1, 3], [1, 2, 1, 2])
    assert groups == [([1, 2], [7, 8]), ([3], [9, 10])] and links == [(1, 7), (1, 8), (2, 8), (3, 9), (3, 10)]


def test_alignment_of_documents(spark, libraries):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    a, b = libraries
    got = {r.doc_id: r for r in QUERIES["op12_end_dictionaries"](spark, FOLDER).collect()}
    assert got.keys() == texts.keys()
    pair = alignment.Pair(PATH_A, PATH_B)
    for d, t in texts.items():
        if got[d].n_a:
            # the unit-wise encoding is that of the libraries over whole texts
            ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t, num_threads=1)
            groups, links = alignment.align(ids_a, ids_b, [len(pair.bytes_a[i]) for i in ids_a], [len(pair.bytes_b[i]) for i in ids_b])
            assert (got[d].n_a, got[d].n_b, got[d].n_groups, got[d].n_links) == (len(ids_a), len(ids_b), len(groups), len(links))
            assert got[d].groups_sha256 == hashlib.sha256(text_of(groups).encode()).hexdigest()
        else:
            assert whole(libraries, t or "") is None
    assert sum(r.n_a > 0 for r in got.values()) > len(got) // 2


# whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string, key int"


def vectors(seed, n=400, d=12, deficient=False):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * np.geomspace(30, 0.05, d)
    if deficient:
        m[:, 3] = 2.0
        m[:, 5] = m[:, 4]
    m[n // 2 :: 3] = m[0]
    return m.astype(np.float32)


def check(rows, m, ids):
    x = np.floor(m.astype(np.float64) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    got = defaultdict(dict)
    for r in rows:
        got[r.vec_id][r.component] = r
    assert len(rows) == 4 * len(ids)
    for c in range(1, 5):
        z = (x - s / n) @ v[:, c - 1] / np.sqrt(e[c - 1])
        mine = np.array([got[i][c].whitened for i in ids])
        sign = np.sign(z @ mine)
        assert np.abs(z * sign - mine).max() < 1e-6 * max(1, np.abs(z).max())
        assert all(abs(got[i][c].explained / (e[c - 1] / e.sum()) - 1) < 1e-9 for i in ids)
    for i, row in zip(ids, x.tolist(), strict=True):
        assert got[i][1].deviation == got[i][4].deviation == sum((n * a - int(b)) ** 2 for a, b in zip(row, s, strict=True))
        assert got[i][2].n == n and got[i][1].identity_error < 1e-8


@pytest.mark.parametrize("deficient", [False, True])
def test_whitening(stored, deficient):
    m = vectors(3, deficient=deficient)
    bad = [(1000, None), (1001, [None] * 12), (1002, [1.0] * 11 + [None]), (1003, [float("nan")] * 12), (1004, [float("inf")] + [0.0] * 11), (1005, [])]
    rows = [(i, v.tolist(), 1, "c", 2) for i, v in enumerate(m)] + [(i, v, None, None, None) for i, v in bad]
    found = whitening.whiten(stored(rows, VECTORS)).collect()
    check(found, m, list(range(len(m))))


def test_whitening_odd_rows(spark, stored):
    assert whitening.whiten(stored([], VECTORS)).count() == 0
    assert whitening.whiten(stored([(1, [1.0, 2.0], 0, "", 0)] * 3, VECTORS)).count() == 0  # no variance
    two = whitening.whiten(stored([(1, [1.0, 2.0], 0, "", 0), (None, [1.0, 3.0], 0, "", 0), (1, [1.0, 2.0], 0, "", 0)], VECTORS)).collect()
    assert [r.component for r in two] == [1] * 3 and {round(abs(r.whitened), 9) for r in two} == {1.0} and {r.deviation for r in two} == {256**2}
    with pytest.raises(ValueError):
        whitening.whiten(stored([(1, [1.0], 0, "", 0), (2, [1.0, 2.0], 0, "", 0)], VECTORS))


def test_shifted_passes(spark):
    """Nearly dependent columns: the plain Gram matrix has no Cholesky factor worth its name, the composed R does."""
    rng = np.random.default_rng(0)
    a = rng.normal(size=(300, 8)) * np.geomspace(1e7, 1e-2, 8)
    fit = spark.createDataFrame([(r,) for r in a.tolist()], "x array<double>")
    mean = a.mean(0)
    r, passes = whitening.shifted_qr(fit, mean, len(a))
    want = np.linalg.svd(a - mean, compute_uv=False)
    assert np.allclose(np.linalg.svd(r, compute_uv=False), want, rtol=1e-7) and 3 <= passes <= whitening.PASSES
    assert np.allclose(np.tril(r, -1), 0)


def test_whitening_of_embeddings(spark):
    rows = [r for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect() if r.embedding is not None]
    m = np.array([r.embedding for r in rows], np.float32)
    keep = np.isfinite(m).all(1)
    check(QUERIES["op11_shifted_cholesky"](spark, FOLDER).collect(), m[keep], [r.vec_id for r, k in zip(rows, keep, strict=True) if k])
