from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from concordat.llm import near_copies
from tests.llm import plain


def shingle_set(text):
    return set(plain.shingles(plain.WORD.findall(plain.ascii_lower(text or "")), 5))


def close_pairs(texts, least=0.8):
    """Brute force: every pair that shares a shingle is measured, fingerprints play no part."""
    sets = {k: shingle_set(t) for k, t in texts.items()}
    where = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            where[x].append(k)
    met = {(a, b) for ks in where.values() for a in ks for b in ks if a < b}
    return {(a, b) for a, b in met if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9}


def planted(seed=5):
    """Texts with copies in which a word is replaced, dropped or added here and there, and one template with many variants."""
    pick, texts = random.Random(seed), {}
    vocabulary = [f"w{i}" for i in range(3000)]
    for family in range(150):
        words = pick.choices(vocabulary, k=pick.choice((60, 120, 400)))
        texts[len(texts)] = " ".join(words)
        for _ in range(2):
            changed = list(words)
            for _ in range(max(1, len(words) // pick.choice((50, 70, 100)))):
                i = pick.randrange(len(changed))
                changed[i : i + 1] = pick.choice(([], [pick.choice(vocabulary)], [changed[i], "new"]))
            texts[len(texts)] = " ".join(changed)
    template = pick.choices(vocabulary, k=200)
    for i in range(300):
        changed = list(template)
        changed[pick.randrange(200)] = f"n{i}"
        texts[len(texts)] = " ".join(changed)
    return texts


def grouped(df):
    out = defaultdict(set)
    for r in near_copies.near_copies(df).collect():
        out[r.group].add(r.doc_id)
    return {d: g for g, ds in out.items() for d in ds}


def test_recall_and_no_false_links(stored):
    texts = planted()
    group = grouped(stored([(k, t) for k, t in texts.items()], "doc_id long, text string"))
    true = close_pairs(texts)
    found = sum(group[a] == group[b] for a, b in true)
    small = [(a, b) for a, b in true if a < 450]
    assert len(small) > 150 and found >= 0.95 * len(true)
    assert sum(group[a] == group[b] for a, b in small) >= 0.95 * len(small)
    reach = {k: k for k in texts}

    def find(x):
        while reach[x] != x:
            x = reach[x]
        return x

    for a, b in true:
        reach[find(a)] = find(b)
    first = {}
    for d, g in group.items():  # a group holds nothing that brute force does not connect
        assert find(first.setdefault(g, d)) == find(d)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    group, true = grouped(docs), close_pairs(texts)
    assert true and sum(group[a] == group[b] for a, b in true) >= 0.95 * len(true)


def test_keep_one(odd, none, stored):
    kept = near_copies.keep_one(odd)
    assert kept.columns == odd.columns and near_copies.keep_one(none).count() == 0
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    ids = [d for d, _ in rows]
    assert sorted(i for i in ids if i is not None) == [1, 3, 5, 7, 8] and len(ids) == 5
    lone = stored([(None, "a b c d e f"), (None, "a b c d e f"), (None, "quite another text here now")], "doc_id long, text string")
    assert near_copies.keep_one(lone).count() == 2


@pytest.mark.parametrize("distinct", [1, 10**5, 10**7, 2 * 10**10])
def test_cells_meet_alike_at_every_size(distinct):
    width, cells = near_copies.plan_cells(distinct, 0.8)
    meet = (1 - near_copies.disagreement(0.8)) ** width
    assert 1 - (1 - meet) ** cells >= near_copies.RECALL and distinct <= 1 << max(width, 16)


def test_wide_print():
    hashes = np.array([3, 5, 9, 12, 100], np.uint64)
    salts = [np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for k in range(1, near_copies.WORDS + 1)]
    for word, salt in zip(near_copies.wide_print(hashes), salts, strict=True):
        assert int(word) & (1 << 64) - 1 == plain.simhash([int(x) for x in near_copies._mixed(hashes ^ salt)])
    assert not near_copies.wide_print(hashes[:0]).any()


def test_shingle_set():
    words = np.arange(1, 9, dtype=np.uint64)
    assert len(near_copies.shingle_set(words)) == 4 and not len(near_copies.shingle_set(words[:0]))
    assert len(near_copies.shingle_set(words[:3])) == 1 and len(near_copies.shingle_set(np.ones(50, np.uint64))) == 1
    assert set(near_copies.shingle_set(words[:7])) < set(near_copies.shingle_set(words))
    assert not set(near_copies.shingle_set(words[:4])) & set(near_copies.shingle_set(words))


def test_rows_of_a_loose_family(stored, monkeypatch):
    """A family whose members are mostly just less alike than 0.8 costs rows by its members and links, not by its pairs."""
    pick = random.Random(11)
    template = pick.choices([f"w{i}" for i in range(3000)], k=150)
    texts = {}
    for i in range(400):
        changed = list(template)
        for at in pick.sample(range(150), pick.choice((1, 4, 4, 4, 5))):
            changed[at] = f"n{i}x{at}"
        texts[i] = " ".join(changed)
    sizes, pin = [], near_copies.pin

    def counting(df):
        out = pin(df)
        if out.columns == ["a", "b"]:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "pin", counting)
    group = grouped(stored(list(texts.items()), "doc_id long, text string"))
    true = close_pairs(texts)
    assert sum(group[a] == group[b] for a, b in true) >= 0.95 * len(true)
    assert len(set(group.values())) > 200 and len(sizes) > 2 and max(sizes) <= 20 * len(texts)
