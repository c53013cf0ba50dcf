"""Incremental localisation: new input is prepared as a stream and sent once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.functions.text import ABBREVIATION_MAX_POOL, normalise, text_key
from glossweave.operators.chunks import MAX_CHARS, MAX_ITEMS
from glossweave.operators.inference import Translate, raise_failed, translate_items
from glossweave.operators.pool import build_pool, translatable_cells
from glossweave.plans.by_pool import chunk_misses, memory_rows
from glossweave.session import materialise
from glossweave.sources.memory import TranslationMemory, memory_misses, with_memory_key


def stream_prepare(cells: DataFrame, abbr_max: int = ABBREVIATION_MAX_POOL) -> DataFrame:
    """Stateless preparation of cells, the same on a stream as on a table: filter, normalise, key."""
    norm = translatable_cells(cells, abbr_max).withColumn("text_norm", normalise(F.col("value")))
    return norm.where(F.col("text_norm") != "").withColumn("text_key", text_key(F.col("text_norm")))


def merge_streams(*sources: tuple[DataFrame, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The cells ``row_id, col_ord, value`` of several streams as one, for a single query.

    Each source is a stream and the stateless function that makes its cells. Two queries at the same time cannot see what
    the other has sent but not stored yet, and pay for a common text twice; in one query a text is in one pool of a
    micro-batch, and later batches find it in the memory, so it is sent once whichever stream brings it first. Every
    source keeps its own offsets in the one checkpoint: the sources of a query and their order must stay the same.
    A source may be empty or repeat another's rows.
    """
    if not sources:
        raise ValueError("no streams to merge")
    cells = [to_cells(stream).select(F.col("row_id").cast("bigint"), F.col("col_ord").cast("int"), F.col("value").cast("string")) for stream, to_cells in sources]
    return reduce(DataFrame.unionByName, cells)


def incremental_localize(
    stream: DataFrame,
    to_cells: Callable[[DataFrame], DataFrame],
    memory: TranslationMemory,
    checkpoint: str,
    langs: Sequence[str],
    model: str,
    rules_id: str,
    translate: Translate,
    available_now: bool = True,
    max_items: int = MAX_ITEMS,
    max_chars: int = MAX_CHARS,
    abbr_max: int = ABBREVIATION_MAX_POOL,
    strict: bool = True,
):
    """Start a query that adds the missing translations of each micro-batch to the memory.

    Texts already in the memory are not sent, also those a failed batch has stored before it is replayed. Batch ids hold
    the checkpoint, so several streams can feed one memory; those that run at the same time and share texts belong
    together by ``merge_streams``. With ``strict`` a batch with items that got no answer fails
    after the others are stored, and its replay asks for the missing ones only.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, batch_no: int) -> None:
        pool = materialise(build_pool(to_cells(batch), abbr_max), "batch-pool")
        misses = memory_misses(with_memory_key(pool, langs, model, rules_id), memory.rows(langs, model, rules_id))
        items = chunk_misses(misses, max_items, max_chars, texts=pool)
        if items.isEmpty():
            return
        done = translate_items(items, translate, max_items)
        memory.append(memory_rows(done.resolved, model, rules_id, attempt=0), f"stream-{stream_id}-{batch_no}")
        if strict:
            raise_failed(done.failed, f"batch {batch_no}")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
