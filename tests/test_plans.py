"""Shape of the physical plans: what must not appear in them, and what must."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from glossweave.catalog import tables
from glossweave.catalog.inputs import answer_table, line_cells
from glossweave.catalog.registry import QUERIES
from glossweave.functions.text import normalise, residue_at_least, strip, translatable_stripped
from glossweave.operators.cells import unpivot_cells
from glossweave.operators.pool import build_pool
from glossweave.session import spread
from glossweave.sources.memory import latest_translation

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["build_pool", "memory_misses", "apply_memory", "localize_table", "greedy_chunks", "fixed_batches", "suspect_sample"])
def test_no_cross_join_and_no_single_task(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "SinglePartition" not in text


def test_scan_reads_only_what_is_needed(spark):
    text = plan(driver.queries()["work_estimate"](spark, SF_DIR))
    assert "ReadSchema: struct<lang:string>" in text
    filtered = line_cells(spark, SF_DIR).where(F.col("doc_id") == 3)
    assert "EqualTo(doc_id,3)" in plan(filtered) and "lang:string" not in plan(filtered)


def test_sample_limits_inside_each_task(spark):
    assert "WindowGroupLimit" in plan(driver.queries()["suspect_sample"](spark, SF_DIR))


def test_pool_collapses_copies_before_the_shuffle(spark):
    text = plan(build_pool(line_cells(spark, SF_DIR)))
    assert "HashAggregate" in text and "partial_min" in text and "SortAggregate" not in text


def test_generated_code_stays_small_enough_to_be_compiled(spark):
    """The JVM does not compile methods above 8,000 bytes of byte code."""
    cells = unpivot_cells(spark.read.parquet(f"{SF_DIR}/part.parquet"), "p_partkey", ["p_name", "p_brand", "p_type"])
    staged = cells.withColumn("v", strip(F.col("value")))
    frames = [
        build_pool(cells),
        staged.where(translatable_stripped(F.col("v"))).select(normalise(F.col("value")).alias("n")),
        staged.select(residue_at_least(F.col("v"), 1.2).alias("score")),
    ]
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for frame in frames:
            code = debug.codegenString(frame.select("*")._jdf.queryExecution().executedPlan())
            sizes = [int(part.split(";")[0].split(",")[0]) for part in code.split("maxMethodCodeSize:")[1:]]
            assert sizes and 0 < max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_worked_on_once(spark):
    """No filter normalises a text again, or takes its lower case for each mark of the source language."""
    assert _optimised(QUERIES["build_pool"](spark, SF_DIR)).count("regexp_replace(") <= 3
    assert _optimised(QUERIES["suspect_residue"](spark, SF_DIR)).count("lower(") <= 1


def test_the_latest_row_moves_its_translation_once(spark, tmp_path):
    log = spark.createDataFrame([("k", True, 1, None, "a", "b1"), ("k", False, 0, None, "b", "b2")], "key string, is_fallback boolean, attempt int, updated_at timestamp_ntz, translation string, batch_id string")
    latest = latest_translation(log)
    assert "max_by" not in _optimised(latest)
    assert latest.columns == [*log.columns, "tried"] and [tuple(r) for r in latest.collect()] == [("k", False, 0, None, "b", "b2", 1)]


def test_tables_are_dealt_to_tasks(spark, monkeypatch):
    """The answer table is not read in one task, and the file of quoted texts is written by several."""
    assert answer_table(spark, SF_DIR).rdd.getNumPartitions() >= 8
    assert spread(spark.range(2_500, numPartitions=1), 100).rdd.getNumPartitions() == 25
    paths = []
    monkeypatch.setattr(tables, "scan_split", lambda spark, path, sep: [paths.append(path)])
    tables.scan_split_quoted(spark, SF_DIR)
    assert len([f for f in os.listdir(paths[0]) if f.endswith(".csv")]) > 1
