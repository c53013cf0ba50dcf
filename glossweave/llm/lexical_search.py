"""Ranked lexical search by a dual tree: the best documents of every item of a query set, exactly.

Documents are read once: a row of the index holds a document's length and the counts of its terms that occur in an item.
A task cuts its index rows into shards and lays a tree over each, as it lays one over the items; a node holds the largest
coordinate of each term below it. The product of two nodes bounds every score of an item below the one with a document
below the other, so a pair whose bound does not beat the weakest k-th score of its items is left with all that is below
it. Coordinates, weights and bounds are integers, so nothing is lost to rounding, ties included.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import filled, text_bytes
from glossweave.operators.ordering import ordered_positions
from glossweave.session import materialise, stage_path

#: UTF-8 bytes of items handled together; what is broadcast and collected is bounded by it (and by the longest item).
ITEM_BYTES = 4 * 2**20
#: Columns of the items searched together, and cells (columns x documents) of a shard.
ITEM_COLUMNS = 2**14
SHARD_CELLS = 2**22
#: Documents of a leaf, children of a node.
LEAF = 16
FAN = 8
#: Saturation and length normalisation of the score.
K1_LENGTH, K1_FIXED, ONE = 75, 25, 1_000_000_000

_NONE = np.iinfo(np.int64).max
_WORD = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: Each byte that is no part of a term becomes a blank, A-Z become lower case; bytes of other code points stay.
_BYTES = bytes(b if b in _WORD else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_BYTES).split()


@dataclass
class ItemNode:
    """Items of a subtree: their columns, and the largest weight of each; children, none for a single item."""

    items: np.ndarray
    columns: np.ndarray
    weights: np.ndarray
    children: list[ItemNode] = field(default_factory=list)


@dataclass
class ItemGroup:
    """Items searched together: ``column`` maps terms of the index to columns (-1: none)."""

    column: np.ndarray
    size: int
    root: ItemNode
    kind: type


def item_groups(entries: list[tuple[np.ndarray, np.ndarray]], vocabulary: int) -> list[ItemGroup]:
    """Groups of the items that have terms; ``entries`` holds (terms, weight times occurrences) of each item."""
    used = [i for i, (terms, _) in enumerate(entries) if len(terms)]
    groups, start = [], 0
    while start < len(used):
        columns, stop = set(entries[used[start]][0].tolist()), start + 1
        while stop < len(used) and len(columns) + len(more := set(entries[used[stop]][0].tolist()) - columns) <= ITEM_COLUMNS:
            columns |= more
            stop += 1
        terms = np.array(sorted(columns))
        column = np.full(vocabulary, -1, dtype=np.int64)
        column[terms] = np.arange(len(terms))
        members = used[start:stop]
        # Sums of integers below 2^53 are exact in doubles, whose products are fast.
        most = max(int(entries[i][1].sum()) for i in members) * (ONE // 1000)
        dense = {i: (column[entries[i][0]], entries[i][1]) for i in members}
        groups.append(ItemGroup(column, len(terms), _item_tree(members, dense, len(terms)), np.float64 if most < 2**53 else np.int64))
        start = stop
    return groups


def _item_tree(members: list[int], entries: dict[int, tuple[np.ndarray, np.ndarray]], size: int) -> ItemNode:
    """Members are parted by the term that comes nearest to halving them, so that items of one language meet."""
    if len(members) == 1:
        columns, weights = entries[members[0]]
        return ItemNode(np.array(members), columns, weights)
    maxima, count = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for i in members:
        columns, weights = entries[i]
        maxima[columns] = np.maximum(maxima[columns], weights)
        count[columns] += 1
    term = int(np.abs(2 * count - len(members)).argmin())
    parts = [[i for i in members if (term in entries[i][0]) == side] for side in (True, False)]
    if not all(parts):
        parts = [members[: len(members) // 2], members[len(members) // 2 :]]
    columns = np.flatnonzero(count)
    return ItemNode(np.array(members), columns, maxima[columns], [_item_tree(part, entries, size) for part in parts])


class Best:
    """The ``k`` best documents so far of each item: by score, then by id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score, self.ident = [np.zeros(0, dtype=np.int64)] * items, [np.zeros(0, dtype=np.int64)] * items
        # What a document must beat: a score above 0 at first.
        self.kth, self.kth_id = np.zeros(items, dtype=np.int64), np.full(items, -_NONE)

    def offer(self, item: int, score: np.ndarray, ident: np.ndarray) -> None:
        good = (score > self.kth[item]) | ((score == self.kth[item]) & (ident < self.kth_id[item]))
        if not good.any():
            return
        score, ident = np.concatenate([self.score[item], score[good]]), np.concatenate([self.ident[item], ident[good]])
        order = np.lexsort((ident, -score))[: self.k]
        self.score[item], self.ident[item] = score[order], ident[order]
        if len(order) == self.k:
            self.kth[item], self.kth_id[item] = score[order[-1]], ident[order[-1]]


class Shard:
    """Documents with a tree of coordinate maxima: ``levels[0]`` are leaves of documents, the last one is the root."""

    def __init__(self, coordinates: np.ndarray, ident: np.ndarray):
        self.coordinates, self.ident = coordinates, ident
        self.levels, self.least = [], []
        below, ids, width = coordinates, ident, LEAF
        while True:
            starts = np.arange(0, below.shape[1], width)
            below, ids, width = np.maximum.reduceat(below, starts, axis=1), np.minimum.reduceat(ids, starts), FAN
            self.levels.append(below)
            self.least.append(ids)
            if len(ids) == 1:
                return

    def search(self, root: ItemNode, best: Best) -> None:
        """Descend both trees from the pair of roots; a pair goes on only if its bound can beat a k-th score."""
        todo = [(root, len(self.levels) - 1, np.zeros(1, dtype=np.int64))]
        while todo:
            node, level, live = todo.pop()
            live = live[self._promising(node, level, live, best)]
            if not len(live):
                continue
            if not node.children and not level:
                rows = _children(live, LEAF, len(self.ident))
                score = node.weights @ self.coordinates[np.ix_(node.columns, rows)]
                best.offer(int(node.items[0]), score.astype(np.int64), self.ident[rows])
                continue
            down = _children(live, FAN, len(self.least[level - 1])) if level else live
            todo += [(child, max(0, level - 1), down) for child in node.children or [node]]

    def _promising(self, node: ItemNode, level: int, live: np.ndarray, best: Best) -> np.ndarray:
        bound = node.weights @ self.levels[level][np.ix_(node.columns, live)]
        weakest = best.kth[node.items].min()
        return (bound > weakest) | ((bound == weakest) & (self.least[level][live] < best.kth_id[node.items].max()))


def _children(nodes: np.ndarray, width: int, n: int) -> np.ndarray:
    below = (nodes[:, None] * width + np.arange(width)).ravel()
    return below[below < n]


def coordinates(count: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The factor of a term that occurs ``count`` times in a document of ``length`` terms."""
    norm = K1_FIXED + (K1_LENGTH * length * documents) // total
    return (ONE * count) // (1000 * count + 8 * norm)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _index(docs: DataFrame, ident: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(``id``, ``n``, ``terms``, ``counts``) of each document: its length, and its terms that are in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            length, rows, found = [], [], []
            for row, value in enumerate(text_bytes(batch.column("text"))):
                words = terms_of(value)
                length.append(len(words))
                known = np.array([t for t in map(number, words) if t is not None], dtype=np.int64)
                terms, counts = np.unique(known, return_counts=True)
                rows.append(terms)
                found.append(counts)
            offsets = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], pa.int32())) for x in (rows, found)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(length, pa.int64()), *lists], ["id", "n", "terms", "counts"])

    rows = docs.select(F.col(f"`{ident}`").cast("bigint").alias("id"), filled(F.col(f"`{text}`")).alias("text"))
    return materialise(rows.mapInArrow(index, "id long, n long, terms array<int>, counts array<int>"), "index")


def _search(index: DataFrame, groups: list[ItemGroup], weights: np.ndarray, items: int, k: int, documents: int, total: int) -> DataFrame:
    """(``item``, ``id``, ``absent``, ``score``): the best documents of each item in each task."""
    shared = index.sparkSession.sparkContext.broadcast((groups, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, weights = shared.value
        best, best_absent = Best(items, k), Best(items, k)
        for batch in batches:
            id_column = batch.column("id")
            absent = np.asarray(id_column.is_null())
            # Rows without an id are ranked on their own, since they come after equal scores that have one.
            for part, found in ((~absent, best), (absent, best_absent)):
                if part.any():
                    rows = batch.filter(pa.array(part))
                    ident = rows.column("id").fill_null(_NONE).to_numpy(zero_copy_only=False)
                    _search_batch(rows, ident, groups, weights, found, documents, total)
        for found, missing in ((best, False), (best_absent, True)):
            sizes = [len(s) for s in found.score]
            if sum(sizes):
                ids = np.concatenate(found.ident)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.arange(items), sizes)),
                        pa.array(ids, mask=np.full(len(ids), missing)),
                        pa.array(np.concatenate(found.score)),
                    ],
                    ["item", "id", "score"],
                )

    return index.mapInArrow(search, "item long, id long, score long")


def _search_batch(
    batch: pa.RecordBatch, ident: np.ndarray, groups: list[ItemGroup], weights: np.ndarray, best: Best, documents: int, total: int
) -> None:
    lists = batch.column("terms")
    size = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(size)), size)
    term, count = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(np.int64)
    value = coordinates(count, batch.column("n").to_numpy()[row], documents, total)
    order = _similar_together(row, term, weights[term], len(size))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    ident, at = ident[order], place[row]
    by_place = np.argsort(at, kind="stable")
    at, term, value = at[by_place], term[by_place], value[by_place]
    for group in groups:
        column = group.column[term]
        inside = column >= 0
        columns, places, values = column[inside], at[inside], value[inside]
        width = max(LEAF, SHARD_CELLS // group.size)
        for start in range(0, len(ident), width):
            stop = min(len(ident), start + width)
            low, high = np.searchsorted(places, (start, stop))
            if low < high:
                dense = np.zeros((group.size, stop - start), dtype=group.kind)
                dense[columns[low:high], places[low:high] - start] = values[low:high]
                Shard(dense, ident[start:stop]).search(group.root, best)


def _similar_together(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The rows in the order of their three heaviest terms, so that copies and texts of one subject share a leaf."""
    heaviest = np.full((3, n), -1, dtype=np.int64)
    order = np.lexsort((term, -weight, row))
    start = np.searchsorted(row[order], np.arange(n))
    stop = np.searchsorted(row[order], np.arange(n), side="right")
    for number in range(3):
        have = start + number < stop
        heaviest[number, have] = term[order[start[have] + number]]
    return np.lexsort(heaviest[::-1])


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
) -> DataFrame:
    """(``item_id``, ``rank``, ``doc_id``, ``score``): each item's ``k`` best documents with a score above 0.

    Equal scores go by ascending id, NULL ids last. NULL and empty texts have no terms: such a document is found by no
    item and does not count, such an item finds nothing. Rows that repeat an id are documents, or items, of their own.
    Without documents or items there is no row; further columns are not read. Document ids are whole numbers.
    """
    spark = docs.sparkSession
    named = items.select(F.col(f"`{item_id}`").alias("item_id"), filled(F.col(f"`{item_text}`")).alias("text"))
    placed = ordered_positions(named.withColumn("bytes", F.octet_length("text").cast("bigint")), [], ["item_id", "text"], running={"upto": "bytes"})
    placed = materialise(placed.withColumn("block", F.expr(f"(upto - bytes) div {ITEM_BYTES}")), "items")
    blocks = placed.agg(F.max("block")).first()[0]
    schema = f"item_id {named.schema['item_id'].dataType.simpleString()}, rank int, {doc_id} long, score long"
    paths = []
    for block in range(0 if blocks is None else blocks + 1):
        # At most ITEM_BYTES and one item.
        texts = [bytes(row["text"], "utf-8") for row in placed.filter(F.col("block") == block).orderBy("pos").select("text").collect()]
        best = _block_search(docs, doc_id, text, texts, k)
        if best is None:
            continue
        first = placed.filter(F.col("block") == block).agg(F.min("pos")).first()[0]
        rows = best.join(placed.select((F.col("pos") - first).alias("item"), "item_id"), "item")
        paths.append(stage_path(spark, "ranked"))
        rows.select("item_id", "rank", F.col("id").alias(doc_id), "score").write.parquet(paths[-1])
    found = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return found.withColumnRenamed("item_id", item_id)


def _block_search(docs: DataFrame, ident: str, text: str, texts: list[bytes], k: int) -> DataFrame | None:
    words = [terms_of(value) for value in texts]
    vocabulary = {word: n for n, word in enumerate(sorted({w for item in words for w in item}))}
    if not vocabulary:
        return None
    index = _index(docs, ident, text, vocabulary)
    documents, total = index.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    # One number for each term of the block.
    holding = dict(index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect())
    weights = np.array([term_weight(documents, holding.get(n, 0)) for n in range(len(vocabulary))])
    entries = []
    for item in words:
        terms, occurrences = np.unique([vocabulary[w] for w in item if vocabulary[w] in holding], return_counts=True)
        terms = terms.astype(np.int64)
        entries.append((terms, weights[terms] * occurrences))
    found = _search(index.filter(F.size("terms") > 0), item_groups(entries, len(vocabulary)), weights, len(texts), k, documents, total)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


_SQL_TERMS = (
    "regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

RANKED_SQL = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, {_SQL_TERMS.format(text="text")} AS terms FROM documents),
lengths AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM doc WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM doc) AS u GROUP BY doc_id, term),
asked AS (SELECT item_id, unnest({_SQL_TERMS.format(text="text")}) AS term FROM benchmark),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) AS d CROSS JOIN whole
), part AS (
  SELECT t.doc_id, t.term, w * ((1000000000 * tf) // (1000 * tf + 8 * ({K1_FIXED} + ({K1_LENGTH} * n * docs) // total))) AS part
  FROM tf AS t JOIN lengths AS l ON l.doc_id = t.doc_id JOIN weight AS x ON x.term = t.term CROSS JOIN whole
), scored AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked AS a JOIN part AS p ON p.term = a.term GROUP BY item_id, doc_id
)
SELECT * FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0) AS r WHERE rank <= 10
"""
