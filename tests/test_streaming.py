from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from concordat.operators import releases as R
from concordat.sources import releases as S
from concordat.streaming import verdicts as V


def document(folder, day, categories, name="a.exe", sha="s"):
    (folder / f"{name}-{day:02d}-{len(categories)}.json").write_text(json.dumps({
        "tag": "t", "filename": name, "sha256": sha, "fetched_at": f"2026-01-{day:02d}T06:00:00Z",
        "last_analysis_results": {e: {"category": c} for e, c in categories.items()}}))


def drain(spark, stream, tmp_path, name):
    out = str(tmp_path / f"out-{name}")
    V.run_available(stream, str(tmp_path / f"state-{name}"), out)
    return spark.read.schema(stream.schema).parquet(out)


def test_retro_flags_keep_state_between_runs(spark, tmp_path):
    V.use_rocksdb(spark)
    inbox = tmp_path / "in"
    inbox.mkdir()
    document(inbox, 1, {"A": "undetected", "B": "malicious"})
    document(inbox, 2, {"A": "malicious", "B": "malicious"})
    job = lambda: V.retro_flags(V.read_verdict_stream(spark, str(inbox)))
    assert [(r.engine, r.prev_category) for r in drain(spark, job(), tmp_path, "r").collect()] == [("A", "undetected")]
    document(inbox, 3, {"A": "undetected", "B": "undetected"})
    document(inbox, 4, {"A": "suspicious", "B": "timeout"})
    drain(spark, job(), tmp_path, "r")
    document(inbox, 3, {"A": "malicious", "B": "malicious", "C": "malicious"})  # older than the kept row
    got = drain(spark, job(), tmp_path, "r").orderBy("fetched_at").collect()
    assert [(r.engine, r.fetched_at.day, r.category) for r in got] == [("A", 2, "malicious"), ("A", 4, "suspicious")]


def test_stream_equals_batch(spark, tmp_path):
    V.use_rocksdb(spark)
    inbox = tmp_path / "in"
    inbox.mkdir()
    rng = random.Random(5)
    cats = ["undetected", "malicious", "timeout", "suspicious"]
    for day in range(1, 13):
        document(inbox, day, {f"E{i}": cats[rng.randrange(4)] for i in range(6)}, sha=f"s{day % 2}")
    batch = S.explode_verdicts(S.read_verdict_documents(spark, str(inbox)))
    want = R.retro_flags(batch, ["sha256", "engine"], ["fetched_at"]).select("sha256", "engine", "fetched_at")
    got = drain(spark, V.retro_flags(V.read_verdict_stream(spark, str(inbox))), tmp_path, "e")
    assert want.count() > 5
    assert sorted(map(tuple, got.select("sha256", "engine", "fetched_at").collect())) == sorted(map(tuple, want.collect()))
    daily = drain(spark, V.daily_flags(V.read_verdict_stream(spark, str(inbox))), tmp_path, "d")
    closed = R.daily_flags(batch).where("day + interval 1 day <= timestamp'2026-01-10 06:00:00'")
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, closed.collect())) != []


def test_repeats_and_escalation(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    document(inbox, 1, {"Big": "malicious", "Small": "suspicious", "Calm": "undetected"})
    (inbox / "copy.json").write_text(next(inbox.glob("a.exe*")).read_text())
    vendors = spark.createDataFrame([("Big",)], "engine string")
    stream = V.escalate(V.drop_repeats(V.read_verdict_stream(spark, str(inbox))), vendors)
    got = drain(spark, stream, tmp_path, "x")
    assert sorted((r.engine, r.severity) for r in got.collect()) == [("Big", "alert"), ("Small", "info")]
    seen = []
    V.run_available(stream.select("engine", F.col("severity")), str(tmp_path / "fb"), foreach_batch=lambda df, i: seen.append(df.count()))
    assert sum(seen) == 2
