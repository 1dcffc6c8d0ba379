"""Byte-range reading of JSON arrays, replaced outputs, phrase tables and forward filling, against plain versions."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from concordat.operators import ordering, phrases
from concordat.sources import json_ranges, replace

SCALARS = ("a", '"q\\', "}]{[,", 'x"files": [1,2]', "é世 ", "\\", r"\\\"", 1, 2.5, None, True, "")


def value(rng, depth=0):
    r = rng.random()
    if depth > 3 or r < 0.3:
        return rng.choice(SCALARS)
    if r < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["files", "k", '"files":[', "b\\"]) + str(i) * (i > 0): value(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.mark.parametrize("size", [7, 1000])
def test_entries_wherever_ranges_fall(spark, tmp_path, size):
    rng = random.Random(3)
    docs = []
    for i in range(12):
        d = {"headers": [value(rng), {"files": [1, {"a": 2}]}], "n": {"files": [3, 4]}}
        if i % 5 != 4:
            d["files"] = [value(rng) for _ in range(rng.choice([0, 1, 2, 30, 80]))]
        d["after"] = [value(rng), {"files": [5]}]
        docs.append(d)
        (tmp_path / f"d{i:03d}.json").write_text(json.dumps(d, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5))
    got = {}
    for r in json_ranges.read_array(spark, str(tmp_path), "files", size).collect():
        got.setdefault(r.file[-8:-5], {})[r.ord] = r.value
    for i, d in enumerate(docs):
        mine = got[f"{i:03d}"]
        places = [o for o in sorted(mine) if o not in (json_ranges.HEAD, json_ranges.TAIL)]
        assert [json.loads(mine[o]) for o in places] == d.get("files", []) and places == list(range(len(places)))
        assert json.loads(mine[json_ranges.HEAD] + mine.get(json_ranges.TAIL, "")) == (d | {"files": []} if "files" in d else d)


def test_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(replace.NoVersion):
        replace.current(spark, path)
    with replace.replacing(spark, path) as target:
        spark.range(3).write.parquet(target)
    with pytest.raises(ValueError), replace.replacing(spark, path) as target:
        spark.range(5).write.parquet(target)
        raise ValueError
    assert spark.read.parquet(replace.current(spark, path)).count() == 3
    with pytest.raises(RuntimeError), replace.replacing(spark, path) as mine:
        spark.range(7).write.parquet(mine)
        with replace.replacing(spark, path) as other:
            spark.range(9).write.parquet(other)
    assert spark.read.parquet(replace.current(spark, path)).count() == 9
    assert replace.prune(spark, path) == 1 and spark.read.parquet(replace.current(spark, path)).count() == 9


def test_phrases(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5)))
    texts = {i: "".join(word() + rng.choice([" ", "  ", "\n"]) for _ in range(rng.randrange(30))) for i in range(40)}
    rules = {i: rng.choice(list(texts.values()))[(a := rng.randrange(20)) : a + rng.randrange(1, 14)] for i in range(80)} | {90: " ", 91: "", 92: "zz zz zz", 93: None}
    got = {(r.id, r.rule_id): r.at for r in phrases.match_phrases(
        spark.createDataFrame(list(texts.items()), "id int, t string"), ["id"], "t", spark.createDataFrame(list(rules.items()), "rule_id int, phrase string")).collect()}
    assert got == {(i, k): t.index(p) + 1 for i, t in texts.items() for k, p in rules.items() if p and p.strip() and p in t}


def test_carry_forward(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(9)}", i, rng.randrange(99) if rng.random() < 0.05 else None) for i in range(2000)]
    got = {r.n: r.v for r in ordering.carry_forward(spark.createDataFrame(rows, "k string, n int, v int"), ["k"], ["n"], "v").collect()}
    last, want = {}, {}
    for k, n, v in rows:
        last[k] = v if v is not None else last.get(k)
        want[n] = last[k]
    assert got == want


def test_packed_numbers(spark):
    pairs = [(0, 0), (0, -(1 << 62)), (5, 7), (5, -7), ((1 << 31) - 1, (1 << 62)), (3, (1 << 63) - 1), (3, -(1 << 63))]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", ordering.packed(F.col("a"), F.col("b")).alias("p"))
    rows = df.select("a", "b", "p", *[c.alias(n) for c, n in zip(ordering.unpacked(F.col("p")), "xy", strict=True)]).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in rows)
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.p)] == sorted(pairs)
