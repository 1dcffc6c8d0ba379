"""Row numbers that several jobs agree on, however the files are split."""

from __future__ import annotations

import pytest

from concordat.llm import simhash
from concordat.llm.common import numbered


@pytest.fixture()
def split(spark):
    """Sets how many bytes of a file a task reads."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


@pytest.mark.parametrize("files", [1, 5])
def test_numbers_do_not_depend_on_splits(spark, split, tmp_path, files):
    path = str(tmp_path / "a b%41é")
    rows = spark.range(6000).selectExpr("id as doc_id", "repeat(md5(string(id)), 9) as text", "'x' as _metadata")
    rows.repartition(files).write.option("parquet.block.size", 65536).parquet(path)
    docs = spark.read.parquet(path)
    split("64k")
    many = numbered(docs).select("_row", "_doc.doc_id")
    assert many.rdd.getNumPartitions() > files
    many = {r._row: r.doc_id for r in many.collect()}
    split("128m")
    assert {r._row: r.doc_id for r in numbered(docs).select("_row", "_doc.doc_id").collect()} == many
    assert sorted(many.values()) == list(range(6000))


def test_numbers_of_other_tables(spark, stored):
    docs = stored([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    for other in (docs.unionByName(docs), docs.crossJoin(spark.range(2).withColumnRenamed("id", "k")), docs.limit(0)):
        rows = numbered(other)
        assert rows.select("_row").distinct().count() == other.count() and rows.select("_doc.*").columns == other.columns
    assert simhash.keep_one(docs.unionByName(docs)).count() == 20


def test_every_component_keeps_a_document(stored):
    texts = ["one two three four five", "six seven eight nine ten", "red blue green grey pink"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[0]), (7, texts[2]), (7, texts[1] + " eleven twelve"), (9, texts[2])]
    kept = simhash.keep_one(stored(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in kept) == sorted([*texts, texts[1] + " eleven twelve"])
    assert [r.doc_id for r in kept if r.text == texts[2]] == [7]
