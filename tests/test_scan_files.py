"""Scan files of many tasks, and byte ranges over entries that have members of the array's name themselves."""

import json

import pyarrow as pa
import pytest

from concordat.bindings.layers import scan_files_read
from concordat.sources import inventory, json_ranges

ORDERS = 200_000


def test_scan_files_are_whole(spark, tmp_path):
    """More rows than fit one task of the shuffle: every file has its head, all of its entries and its end."""
    rows = spark.range(ORDERS).selectExpr(
        "id as l_orderkey", "1 as l_linenumber", "id % 1000 as l_partkey", "if(id % 97 = 0, null, id % 89) as l_suppkey", "double(id % 50) as l_quantity")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.shuffle.partitions": "60"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = scan_files_read(spark, str(tmp_path))
        got = [(r.path, r.score) for r in found.select("path", "score").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # Rows without a bucket are in no file.
    want = [(f"p{i % 1000}/s\"{i % 89}.rs", float(i % 50)) for i in range(ORDERS) if i % 97]
    assert sorted(got) == sorted(want)


def test_members_of_entries_are_not_kept(tmp_path):
    """A range reports one place for each depth, not one for each entry that has such a member."""
    doc = {"files": [{"path": f"a{i}", "files": ["x", {"files": [1]}]} for i in range(500)]}
    path = tmp_path / "npm.json"
    path.write_text(json.dumps(doc))
    size = path.stat().st_size
    batch = pa.RecordBatch.from_pylist([{"path": str(path), "start": s, "length": min(4096, size - s)} for s in range(0, size, 4096)])
    (looked,) = json_ranges._look("files", iter([batch]))
    for seen in looked.column("seen").to_pylist():
        for one in seen:
            assert len({m["depth"] for m in one["marks"]}) == len(one["marks"]) <= 4


@pytest.mark.parametrize("size", [50, 1 << 16])
def test_odd_entries(spark, tmp_path, size):
    """Bytes that are no UTF-8, entries of several ranges, white space around entries, and quotes behind backslashes."""
    (tmp_path / "one").mkdir()
    paths = [b"a\xff", b"b" * 5000, b"c,", b'q\\"', b"e\\\\", b"", "é世".encode()]
    (tmp_path / "one" / "npm.json").write_bytes(b'{"files":[' + b" ,\n\t ".join(b'{"path":"' + p + b'"}' for p in paths) + b" \n]}")
    (tmp_path / "one" / "other.json").write_text('{"files":[{"path":"not read"}]}')
    rows = inventory.read_scans(spark, str(tmp_path), size).orderBy("ord").collect()
    assert [(r.scan_id, r.bucket, r.ord, r.path) for r in rows] == [
        ("one", "npm", i, p) for i, p in enumerate(["a�", "b" * 5000, "c,", 'q"', "e\\", "", "é世"]) if p]
