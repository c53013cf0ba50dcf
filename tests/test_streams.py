"""Streams merged into one query: a text that several of them bring is sent once."""

import pytest
from pyspark.sql import functions as F

from glossweave.catalog.models import pseudo_translate
from glossweave.sources.memory import TranslationMemory
from glossweave.streaming.incremental import incremental_localize, merge_streams

TEXTS = [["The first shared line", "Only on the left here", None], ["A second shared line", "The first shared line"]]
OTHERS = [["A second shared line", "Only on the right here"], ["The first shared line", ""]]


def to_cells(stream):
    return stream.select("row_id", F.lit(0).alias("col_ord"), F.col("line").alias("value"))


def source(spark, path, batches):
    """A stream of one file a micro-batch; no file at all where ``batches`` is empty."""
    path.mkdir()
    for number, lines in enumerate(batches):
        rows = [(100 * number + k, line) for k, line in enumerate(lines)]
        spark.createDataFrame(rows, "row_id bigint, line string").coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema("row_id bigint, line string").option("maxFilesPerTrigger", 1).parquet(str(path))


def run(spark, tmp_path, *streams):
    memory, sent = TranslationMemory(spark, str(tmp_path / "memory")), (str(tmp_path / "checkpoint"), ["EN", "AR"], "m", "r")
    merged = merge_streams(*[(s, to_cells) for s in streams])
    incremental_localize(merged, lambda cells: cells, memory, *sent, pseudo_translate).awaitTermination()
    return sorted((r["lang"], r["text_norm"]) for r in memory.log().collect())


def test_texts_of_two_streams_are_sent_once(spark, tmp_path):
    """In one micro-batch, and where the second stream brings a text later than the first."""
    got = run(spark, tmp_path, source(spark, tmp_path / "a", TEXTS), source(spark, tmp_path / "b", OTHERS))
    texts = {t for batch in TEXTS + OTHERS for t in batch if t}
    assert got == sorted((lang, t) for lang in ("EN", "AR") for t in texts)


def test_an_empty_stream_and_none(spark, tmp_path):
    got = run(spark, tmp_path, source(spark, tmp_path / "a", TEXTS), source(spark, tmp_path / "b", []))
    assert len(got) == 6
    with pytest.raises(ValueError):
        merge_streams()
