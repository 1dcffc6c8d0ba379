"""From raw documents to token ids: clean, deduplicate, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents; between stages rows are written as Parquet and read again, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from concordat.llm import decontaminate, idfiles, mixing, near_copies, quality, simhash
from concordat.llm.common import steady
from concordat.llm.queries import table, tokenizer
from concordat.session import pin

# The last stage's rows depend on the tokenizer's library and on XXH64, which SQL does not have.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and with them documents that lose too much or fail the base rules."""
    return quality.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays. op2's duplicates and near copies (0.8 of their five-word shingles) are connected."""
    docs = steady(docs)
    return near_copies.keep_one(docs, also=simhash.near_duplicates(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated so that sources come near their targets."""
    return mixing.mixed(docs)


def token_id_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids are written to files; one row per document says where they are and what they sum to."""
    return idfiles.read_ids(idfiles.write_ids(docs, tokenizer()))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_id_output", token_id_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
