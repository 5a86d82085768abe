"""The corpus pipeline: stages over documents, each one an operator of dqloom.llm.

Every stage reads all rows its predecessor kept, and all but the last return the columns of
``documents``. A stage that filters drops whole documents and never changes a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.llm import common, decontamination, jaccard_join, mixing, quality_rules, sharding


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least doc_id, of each group of similar ones."""
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; a repeat is a row."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``, in whose
    place no column of the documents stays."""
    names = docs.columns
    placed = sharding.sharded(docs.toDF(*[n if n in ("doc_id", "text") else f"own{i}" for i, n in enumerate(names)]))
    given = placed.schema["place"].dataType.fieldNames()
    own = [F.col(placed.columns[i]).alias(n) for i, n in enumerate(names) if n.lower() not in given]
    return placed.select(*own, "place.*")


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("mixing", mixture),
    ("sharding", shards),
]

# The line labels have no equivalent in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.stored(docs)
    return docs
