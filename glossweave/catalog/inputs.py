"""Inputs shared by several queries: document lines as cells, an earlier run, answer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.catalog.registry import table
from glossweave.functions.text import memory_key
from glossweave.operators.cells import document_cells
from glossweave.operators.pool import build_pool, language_fanout
from glossweave.session import spread

MODEL, RULES = "m1", "r1"

#: Rows of the answer table in a task: each has four cells, in every language, counted on three levels by the reports.
ANSWER_ROWS = 100_000


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_cells(table(spark, sf_dir, "documents")).withColumn("col_ord", F.lit(0))


def labelled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the documents that carry a label: what an earlier run has covered."""
    return line_cells(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


def line_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_pool(line_cells(spark, sf_dir))


def earlier_memory(spark: SparkSession, sf_dir: str, *langs: str) -> DataFrame:
    """Memory rows of the earlier run in the given languages, as a deterministic pseudo translation."""
    pool = language_fanout(build_pool(labelled_cells(spark, sf_dir)), langs)
    return pool.select(
        memory_key(F.col("lang"), F.lit(MODEL), F.lit(RULES), F.col("text_norm")).alias("key"),
        "lang",
        "text_norm",
        F.concat(F.lit("["), "lang", F.lit("] "), "text_norm").alias("translation"),
        F.lit(False).alias("is_fallback"),
    )


def answer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a multiple-choice table with every kind of answer key."""
    key = (
        F.when(F.col("p_partkey") % 8 == 0, "A")
        .when(F.col("p_partkey") % 8 == 1, "b")
        .when(F.col("p_partkey") % 8 == 2, " C ")
        .when(F.col("p_partkey") % 8 == 3, F.col("p_brand"))
        .when(F.col("p_partkey") % 8 == 4, F.col("p_type"))
        .when(F.col("p_partkey") % 8 == 5, "")
        .when(F.col("p_partkey") % 8 == 6, "no such answer")
        .otherwise(F.col("p_size").cast("string"))
    )
    return spread(table(spark, sf_dir, "part"), ANSWER_ROWS).select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_name").alias("A"),
        F.col("p_brand").alias("B"),
        F.col("p_type").alias("C"),
        F.col("p_size").cast("string").alias("D"),
        key.alias("Richtig1"),
        F.lit("").alias("Richtig_Text1"),
        F.lit("").alias("Richtig1_Text"),
        F.lit("DE").alias("Sprache"),
    )


ANSWER_SQL = """answers AS (
  SELECT p_partkey AS row_id, p_name AS A, p_brand AS B, p_type AS C, p_size::VARCHAR AS D,
    CASE p_partkey % 8 WHEN 0 THEN 'A' WHEN 1 THEN 'b' WHEN 2 THEN ' C ' WHEN 3 THEN p_brand WHEN 4 THEN p_type
      WHEN 5 THEN '' WHEN 6 THEN 'no such answer' ELSE p_size::VARCHAR END AS Richtig1, 'DE' AS Sprache
  FROM part)"""
FIXED_SQL = f"""{ANSWER_SQL}, fixed AS (
  SELECT * REPLACE (CASE WHEN upper(trim(Richtig1)) IN ('A','B','C','D','E','') THEN Richtig1
      WHEN trim(A) = trim(Richtig1) THEN 'A' WHEN trim(B) = trim(Richtig1) THEN 'B'
      WHEN trim(C) = trim(Richtig1) THEN 'C' WHEN trim(D) = trim(Richtig1) THEN 'D' ELSE Richtig1 END AS Richtig1),
    upper(trim(Richtig1)) NOT IN ('A','B','C','D','E','')
      AND trim(Richtig1) IN (trim(A), trim(B), trim(C), trim(D)) AS was_fixed
  FROM answers)"""
