"""Heavy rows of a small table are dealt over tasks."""

from __future__ import annotations

from concordat.bindings import inputs, layers
from concordat.sources import inventory


def test_small_tables_are_spread(spark, tmp_path):
    """A table of one small file does not leave its heavy rows to one task."""
    rows = [(i, f"ring bolt {i}", "Brand#1", "ECONOMY", i % 50, 1.0) for i in range(200)] + [(None, None, None, None, None, None)]
    made = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    made.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert spark.read.parquet(f"{tmp_path}/part.parquet").rdd.getNumPartitions() == 1
    merged = layers.identity_merge(spark, str(tmp_path))
    assert merged.rdd.getNumPartitions() >= 8 and merged.count() == 201
    assert inventory.flatten(inputs.components(spark, str(tmp_path))).rdd.getNumPartitions() >= 8
