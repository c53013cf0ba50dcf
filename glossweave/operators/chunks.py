"""Batches and chunks of work: fixed size, greedy by size, halves of failed ones, request bodies."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.functions.text import non_blank
from glossweave.operators.ordering import broadcast_if_small, ordered_positions
from glossweave.session import materialise

# Budgets of the first pass, of the quality rounds, and of the row and value batches.
MAX_ITEMS, MAX_CHARS = 200, 18_000
RETRY_ITEMS, RETRY_CHARS = 120, 14_000
ROW_BATCH, VALUE_BATCH, RETRY_BATCH = 200, 100, 50

BLOCK_ROWS = 50_000
FAN_IN = 512


def fixed_batches(df: DataFrame, group: Sequence[str], order: Sequence[str], size: int = ROW_BATCH) -> DataFrame:
    """``batch_no`` and ``item_no`` in row order, exact over a whole group of any size."""
    placed = ordered_positions(df, group, order, position="_pos")
    return placed.select(
        *df.columns,
        F.floor(F.col("_pos") / size).cast("bigint").alias("batch_no"),
        (F.col("_pos") % size).alias("item_no"),
    )


def greedy_chunks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    size: str,
    max_items: int = MAX_ITEMS,
    max_chars: int = MAX_CHARS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Next-fit packing in order; adds ``pos``, ``chunk_no`` and ``item_no``.

    A chunk closes when it is full or when the next text would exceed the budget; an oversize text
    travels alone. The rule is sequential, yet the result here is the one a single pass over the
    whole group gives, while no task sees more than a block: where a chunk that starts at a row
    ends depends only on the rows after it, so each block is summarised by "entered at offset e,
    left at offset f, after n chunks" (``max_items`` pairs). Summaries are combined ``FAN_IN`` at a
    time, and the entry of each block is handed back down the same way. ``df`` is read more than once: pass a written
    table, or what follows cheaply from one.
    """
    if block_rows < max_items:
        raise ValueError("block_rows must be at least max_items")
    group = list(group)
    largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] if group else None
    if largest is not None and largest <= block_rows:
        # Every group fits one block, so one bounded sort a group places its rows.
        within = Window.partitionBy(*group).orderBy(*order)
        placed, last_block = df.withColumn("pos", (F.row_number().over(within) - 1).cast("bigint")), 0
    else:
        placed = ordered_positions(df, group, order)
        last_block = placed.agg(F.max("pos")).first()[0]
    sizes = placed.select(*group, "pos", F.col(size).cast("bigint").alias("size"))

    blocks = _with_halo(sizes, block_rows, max_items)
    key_fields = [placed.schema[c] for c in group]
    levels = 0
    while last_block is not None and last_block // block_rows // FAN_IN**levels > 0:
        levels += 1

    entries = None
    if levels:
        block_key = T.StructField("block", T.LongType())
        summary = T.StructType(
            [*key_fields, block_key, T.StructField("exits", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))]
        )
        maps = [
            materialise(
                blocks.groupBy(*group, "block").applyInPandas(_summariser(group, block_rows, max_items, max_chars), summary),
                "block-maps",
            )
        ]
        for _ in range(levels - 1):
            upper = maps[-1].withColumn("_sub", F.col("block")).withColumn("block", F.floor(F.col("block") / FAN_IN).cast("bigint"))
            maps.append(materialise(upper.groupBy(*group, "block").applyInPandas(_combiner(group), summary), "block-maps"))
        entry = T.StructType([*key_fields, block_key, T.StructField("entry", T.LongType()), T.StructField("base", T.LongType())])
        for level in reversed(maps):
            below = level.withColumn("_sub", F.col("block")).withColumn("block", F.floor(F.col("block") / FAN_IN).cast("bigint"))
            if entries is None:
                below = below.withColumns({"entry": F.lit(0).cast("bigint"), "base": F.lit(0).cast("bigint")})
            else:
                below = _join_null_safe(below, entries, [*group, "block"], ["entry", "base"])
            entries = materialise(below.groupBy(*group, "block").applyInPandas(_descender(group), entry), "block-entries")
        blocks = _join_null_safe(blocks, broadcast_if_small(entries, entries.count()), [*group, "block"], ["entry", "base"])
    else:
        blocks = blocks.withColumns({"entry": F.lit(0).cast("bigint"), "base": F.lit(0).cast("bigint")})

    assigned_schema = T.StructType(
        [*key_fields, *[T.StructField(c, T.LongType()) for c in ("pos", "chunk_no", "item_no")]]
    )
    assigned = blocks.groupBy(*group, "block").applyInPandas(
        _assigner(group, block_rows, max_items, max_chars), assigned_schema
    )
    return _join_null_safe(placed, assigned, [*group, "pos"], ["chunk_no", "item_no"])


def _with_halo(sizes: DataFrame, block_rows: int, max_items: int) -> DataFrame:
    """Each row in its block; the first ``max_items`` rows of a block also follow the block before."""
    home = F.floor(F.col("pos") / block_rows).cast("bigint")
    in_halo = (F.col("pos") % block_rows < max_items) & (home > 0)
    targets = F.when(in_halo, F.array(home, home - 1)).otherwise(F.array(home))
    return sizes.withColumn("block", F.explode(targets))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return left.join(right, on).select(*[left[c] for c in left.columns], *[right[c] for c in take])


def _next_starts(sizes: np.ndarray, max_items: int, max_chars: int) -> np.ndarray:
    """For a chunk that starts at row i: the row where the next chunk starts."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    fits = np.searchsorted(ends, ends[:-1] + max_chars, side="right") - 1
    rows = np.arange(len(sizes))
    return np.minimum(np.maximum(fits, rows + 1), rows + max_items)


def _block(pdf: pd.DataFrame, block_rows: int) -> tuple[np.ndarray, int, int]:
    """Sizes in order with the halo behind, rows of the block itself, first position."""
    pdf = pdf.sort_values("pos", kind="stable")
    first = int(pdf["block"].iloc[0]) * block_rows
    own = int((pdf["pos"] < first + block_rows).sum())
    return pdf["size"].to_numpy(), own, first


def _keys(pdf: pd.DataFrame, group: Sequence[str]) -> dict:
    return {c: pdf[c].iloc[0] for c in group}


def _summariser(group, block_rows, max_items, max_chars):
    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes, own, _ = _block(pdf, block_rows)
        following = _next_starts(sizes, max_items, max_chars)[:own].tolist()
        exits, counts = [0] * own, [0] * own
        for i in range(own - 1, -1, -1):
            j = following[i]
            exits[i], counts[i] = (exits[j], counts[j] + 1) if j < own else (j - own, 1)
        # A short last block may be entered behind its end: nothing is left to pack then.
        pad = max(0, max_items - own)
        row = {"block": int(pdf["block"].iloc[0]), "exits": exits[:max_items] + [0] * pad, "counts": counts[:max_items] + [0] * pad}
        return pd.DataFrame([_keys(pdf, group) | row])

    return summarise


def _combiner(group):
    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_sub")
        exits = counts = None
        for e, n in zip(pdf["exits"], pdf["counts"]):
            e, n = np.asarray(e), np.asarray(n)
            exits, counts = (e, n) if exits is None else (e[exits], counts + n[exits])
        return pd.DataFrame([_keys(pdf, group) | {"block": int(pdf["block"].iloc[0]), "exits": exits, "counts": counts}])

    return combine


def _descender(group):
    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_sub")
        entry, base, rows = int(pdf["entry"].iloc[0]), int(pdf["base"].iloc[0]), []
        for sub, exits, counts in zip(pdf["_sub"], pdf["exits"], pdf["counts"]):
            rows.append(_keys(pdf, group) | {"block": int(sub), "entry": entry, "base": base})
            entry, base = int(exits[entry]), base + int(counts[entry])
        return pd.DataFrame(rows)

    return descend


def _assigner(group, block_rows, max_items, max_chars):
    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes, own, first = _block(pdf, block_rows)
        following = _next_starts(sizes, max_items, max_chars)
        start, number = int(pdf["entry"].iloc[0]), int(pdf["base"].iloc[0])
        starts, stops = [], []
        while start < own:
            starts.append(start)
            start = min(int(following[start]), len(sizes))
            stops.append(start)
        lengths = np.asarray(stops, dtype="int64") - np.asarray(starts, dtype="int64")
        begin = np.repeat(np.asarray(starts, dtype="int64"), lengths)
        places = np.arange(len(begin)) + (starts[0] if starts else 0)
        out = pd.DataFrame(
            {
                "pos": first + places,
                "chunk_no": number + np.repeat(np.arange(len(starts)), lengths),
                "item_no": places - begin,
            }
        )
        for c, value in _keys(pdf, group).items():
            out[c] = value
        return out[[*group, "pos", "chunk_no", "item_no"]]

    return assign


def split_failed_chunks(items: DataFrame, chunk: Sequence[str], order: str = "item_no") -> DataFrame:
    """Halve each chunk: its first ``n // 2`` items, then the rest. A chunk is small by construction."""
    whole = Window.partitionBy(*chunk)
    numbered = items.withColumns(
        {"_n": F.count(F.lit(1)).over(whole), "_at": F.row_number().over(whole.orderBy(order))}
    )
    half = F.when(F.col("_at") <= F.floor(F.col("_n") / 2), 0).otherwise(1)
    return numbered.withColumn("half", half).drop("_n", "_at")


def text_requests(
    items: DataFrame, chunk: Sequence[str], item_id: str = "id", text: str = "text_norm", carry: Sequence[str] | None = None
) -> DataFrame:
    """One request per chunk: a JSON array of ``{id, text}``, with item count, characters and ids.

    With ``carry`` the items travel along: ``sent`` is the array of structs of id, text and these columns, by id.
    """
    body = F.sort_array(
        F.collect_list(F.struct(F.col(item_id).cast("bigint").alias("id"), F.col(text).alias("text"), *(carry or ())))
    )
    grouped = items.groupBy(*chunk).agg(body.alias("sent"), F.sum(F.length(text)).alias("n_chars"))
    return grouped.select(*chunk, *request_columns(F.col("sent"), F.col("n_chars"), carry is not None))


def request_columns(sent: Column, n_chars: Column | None = None, carried: bool = True) -> list[Column]:
    """Body, item count, characters and ids of the request for the items ``sent``, and the items themselves if ``carried``."""
    body = F.transform(sent, lambda x: F.struct(x["id"].alias("id"), x["text"].alias("text"))) if carried else sent
    if n_chars is None:
        n_chars = F.aggregate(sent, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(F.length(x["text"]), F.lit(0)))
    return [
        F.to_json(body).alias("request"),
        F.size(sent).alias("n_items"),
        n_chars.alias("n_chars"),
        F.transform(sent, lambda x: x["id"]).alias("ids"),
        *([sent.alias("sent")] if carried else []),
    ]


def split_failed_requests(rejected: DataFrame, chunk: Sequence[str]) -> DataFrame:
    """``split_failed_chunks`` for requests that carry their items ``sent``: ``half`` 0 has the first ``n // 2`` of them,
    ``half`` 1 the rest. Nothing is gathered again, so nothing moves."""
    n = F.size("sent")
    first = F.floor(n / 2).cast("int")
    halves = [
        F.struct(F.lit(0).alias("half"), F.slice("sent", F.lit(1), first).alias("sent")),
        F.struct(F.lit(1).alias("half"), F.slice("sent", first + 1, n - first).alias("sent")),
    ]
    return rejected.select(*chunk, F.inline(F.array(*halves)))


def row_requests(cells: DataFrame, chunk: Sequence[str]) -> DataFrame:
    """One request per batch of rows: a JSON array of ``{row_index, fields}`` with non-blank fields only.

    Rows without any such field are not sent.
    """
    rows = (
        cells.where(non_blank(F.col("value")))
        .groupBy(*chunk, "row_id")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("col", "value")))).alias("fields"),
             F.sum(F.length("value")).alias("_chars"))
    )
    # Maps cannot be ordered, so rows are sorted by id through a comparator.
    row = F.struct(F.col("row_id").alias("row_index"), "fields")

    def by_id(a, b):
        return F.when(a["row_index"] < b["row_index"], -1).when(a["row_index"] > b["row_index"], 1).otherwise(0)

    return (
        rows.groupBy(*chunk)
        .agg(F.array_sort(F.collect_list(row), by_id).alias("_body"), F.sum("_chars").alias("n_chars"))
        .select(
            *chunk,
            F.to_json("_body").alias("request"),
            F.size("_body").alias("n_items"),
            "n_chars",
            F.transform("_body", lambda x: x["row_index"]).alias("ids"),
        )
    )

