"""Joins of the pipeline whose sides Spark sizes too low, and the two operators of its second stage."""

import pytest

import corpus_pipeline
from concordat.llm import decontaminate, idfiles, mixing, near_copies, simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in enumerate(texts)], COLUMNS)


def plans(monkeypatch, module, run):
    """The plans of all tables that a module writes."""
    seen, pin = [], module.pin

    def noting(df):
        seen.append(df._jdf.queryExecution().sparkPlan().toString())
        return pin(df)

    monkeypatch.setattr(module, "pin", noting)
    run()
    return seen


def test_cells_are_not_broadcast(spark, monkeypatch):
    texts = [" ".join(f"w{i // 3}x{k}" for k in range(40 + i % 3)) for i in range(60)]
    seen = plans(monkeypatch, near_copies, lambda: near_copies.keep_one(documents(spark, texts)).count())
    met = [p for p in seen if "cell#" in p and "Join" in p]
    assert len(met) >= 3 and not [p for p in met if "BroadcastHashJoin" in p]


def test_slots_are_not_broadcast(spark, monkeypatch):
    texts = [" ".join(f"w{k}" for k in range(900 + i)) for i in range(20)]
    seen = plans(monkeypatch, mixing, lambda: mixing.mixture(documents(spark, texts)).count())
    listed = [p for p in seen if "slot#" in p and "Generate" in p]
    assert listed and not [p for p in listed if "BroadcastHashJoin" in p]


def test_windows_are_not_broadcast(spark, monkeypatch):
    item = " ".join(f"w{k}" for k in range(30))
    docs = documents(spark, [f"{i} {item} {i}" for i in range(5)] + ["nothing of it"])
    bench = spark.createDataFrame([("a", item)], "item_id string, text string")
    seen = plans(monkeypatch, decontaminate, lambda: decontaminate.found_in(docs, bench).count())
    # Row numbers alone decide which texts are read again; the arrays of windows are merged.
    met = [p for p in seen if "_windows#" in p and "LeftSemi" in p]
    assert met and all("SortMergeJoin" in p for p in met)
    assert {(r.doc_id, r.item_id) for r in decontaminate.found_in(docs, bench).collect()} == {(i, "a") for i in range(5)}


def test_second_stage_has_both_operators(spark):
    round_ = " ".join(f"r{k}" for k in range(11)) + " "
    # The repeated words alone make op2's fingerprint; of the distinct five-word shingles the tails have most.
    looped = [round_ * 200 + " ".join(f"t{i}x{k}" for k in range(30)) for i in range(2)]
    # One word in 150 is another: near copies, too far apart for op2.
    plain = [f"p{k}" for k in range(150)]
    near = [" ".join(plain), " ".join([*plain[:70], "other", *plain[71:]])]
    lone = [" ".join(f"q{i}x{k}" for k in range(60)) for i in range(3)]
    docs = documents(spark, [*looped, *near, *lone])

    def kept(rows):
        return sorted(r.doc_id for r in rows.collect())

    assert kept(near_copies.keep_one(docs)) == [0, 1, 2, 4, 5, 6]
    assert kept(simhash.keep_one(docs)) == [0, 2, 3, 4, 5, 6]
    assert kept(corpus_pipeline.simhash_near_dedup(spark, docs, "")) == [0, 2, 4, 5, 6]


def test_texts_come_in_small_batches(spark, monkeypatch):
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, before = [], spark.conf.get(limit)

    def noting(df):
        seen.append(spark.conf.get(limit))
        raise KeyError("stopped")

    monkeypatch.setattr(idfiles, "pin", noting)
    with pytest.raises(KeyError):
        idfiles.write_ids(documents(spark, ["a b c"]), "")
    assert seen == [str(idfiles.BATCH)] and int(before) > idfiles.BATCH and spark.conf.get(limit) == before
