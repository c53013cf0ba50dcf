"""Registered queries of this folder: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.llm.centroids import centroid_clusters, clusters_sql
from glossweave.llm.common import read_table
from glossweave.llm.decontaminate import contaminated
from glossweave.llm.html_main import main_texts
from glossweave.llm.imatch import FINGERPRINTS_SQL, document_fingerprints
from glossweave.llm.lexical_search import RANKED_SQL, ranked_search
from glossweave.llm.licences import SCAN_SQL, licence_scan
from glossweave.llm.line_dedup import REMOVED_LINES_SQL, remove_repeated_lines
from glossweave.llm.near_dedup import fingerprint_hex, near_duplicates
from glossweave.llm.packing import pack_documents
from glossweave.llm.pii import personal_data
from glossweave.llm.quality import quality_rules
from glossweave.llm.toxicity import toxicity
from glossweave.llm.warc import ROUND_TRIP_SQL, archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_texts(read_table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read_table(spark, sf_dir, "documents"), F.col("doc_id"))
    return groups.select(
        F.col("id").alias("doc_id"), fingerprint_hex(F.col("print")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


ORACLES["op6_line_dedup"] = REMOVED_LINES_SQL + "SELECT doc_id, text, n_lines, n_removed FROM kept"


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules(read_table(spark, sf_dir, "documents"), columns=["doc_id"])
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.select("doc_id", *figures, "n_tokens", "chars_per_token", "byte_share", "token_entropy")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(read_table(spark, sf_dir, "documents"))


ORACLES["op8_license_scan"] = SCAN_SQL


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), F.col("doc_id")).withColumnRenamed("id", "doc_id")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


ORACLES["op10_warc"] = ROUND_TRIP_SQL


@query
def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLES["op11_ranked_lexical_search"] = RANKED_SQL


@query
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(read_table(spark, sf_dir, "documents"))


ORACLES["op12_document_fingerprints"] = FINGERPRINTS_SQL


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(read_table(spark, sf_dir, "embeddings"))


ORACLES["op13_centroid_clustering"] = clusters_sql()
