"""Documents that are a benchmark item less a few words."""

from __future__ import annotations

from collections import Counter

from concordat.llm import decontaminate


def weighted(a, b, n=5):
    a, b = (Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for w in (a, b))
    return (a & b).total() / (a | b).total()


def test_documents_shorter_than_the_item(stored):
    words = [f"w{i * i}" for i in range(40)]
    twice = [f"v{i % 17}" for i in range(40)]
    texts = {1: words[:39], 2: words[3:], 3: words[:36], 4: words[:33], 5: words[:32], 6: words[:20], 7: [*words[:30], "x"], 8: twice[:38], 9: words}
    docs = stored([(d, " ".join(t)) for d, t in texts.items()], "doc_id long, text string")
    bench = stored([(1, " ".join(words)), (2, " ".join(twice))], "item_id long, text string")
    items = {1: words, 2: twice}
    want = {(d, i): round(s, 9) for d, t in texts.items() for i, w in items.items() if (s := weighted(t, w)) >= 0.8}
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.window_start) for r in decontaminate.found_in(docs, bench).collect()}
    assert got == {k: (s, 0) for k, s in want.items()}
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (8, 2)} <= want.keys() and not {5, 6, 7} & {d for d, _ in want}
    assert {r.doc_id for r in decontaminate.without_benchmark(docs, bench).collect()} == {5, 6, 7}
