"""A cleaning pipeline over ``documents``: each stage is one operator of ``glossweave.llm`` with its decisions applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.llm.common import read_table
from glossweave.llm.decontaminate import without_contaminated
from glossweave.llm.line_dedup import remove_repeated_lines
from glossweave.llm.near_dedup import one_of_each_group
from glossweave.llm.packing import pack_documents
from glossweave.llm.quality import quality_rules
from glossweave.session import materialise, stage_path

#: Wider near duplicates, looked for in what the fingerprints of ``op5_simhash_near_dedup`` leave: shingles of five words, of which 0.8 are common. Of fingerprints of 256 bits, texts of
#: similarity 0.8 differ in 38 bits on average (standard deviation 6), so candidates may differ in 52.
NEAR = {"shingle": 5, "words": 4, "radius": 52, "minima": 6, "similarity": 0.8}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility bands keep."""
    return quality_rules(docs, prefix="__quality_").filter("__quality_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of repeated passages."""
    return remove_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints of 64 bits within 3, all found by equal blocks, then
    wider ones whose texts are compared."""
    distinct = materialise(one_of_each_group(docs), "near-3-bits")
    return one_of_each_group(distinct, **NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs, F.col("doc_id")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: Fertility, fingerprints and packing have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet below the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = stage_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
