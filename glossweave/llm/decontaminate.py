"""Benchmark decontamination with SimHash windows of each item's size.

A window of as many words as an item, its shingles' SimHash within a Hamming radius of the item's, is a candidate; the
blocks of a multi-index guarantee that every fingerprint within the radius is found (one of m blocks differs in at most
radius // m bits, and the index lists each block under all values that close). Candidates are verified by the exact
similarity of shingle counts (sum of minima over sum of maxima). A window that shares no shingle with any item has
similarity 0, so windows are only laid where a shingle of an item of that size occurs; nothing else is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import mix64

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 17
#: First bits of the index blocks of a fingerprint.
BLOCKS = (0, 11, 22, 33, 44, 54, 64)
#: Words of the items of one index, which bounds what is broadcast; more items are searched in several indexes.
INDEX_WORDS = 300_000
#: Words whose bits are summed at a time.
REGION = 50_000
_PUNCTUATION = bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256))
_FACTOR = np.uint64(0x100000001B3)


def normal_words(text: str | None) -> list[bytes]:
    """Words in lower case, ASCII punctuation as blanks."""
    return (text or "").lower().encode("utf-8", "replace").translate(_PUNCTUATION).split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; fewer words give none."""
    n = len(words) - size + 1
    if n < 1 or size < 1:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        out = each[:n].copy()
        for k in range(1, size):
            out = (out ^ (out >> np.uint64(29))) * _FACTOR + each[k : k + n]
    return mix64(out)


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of the 64 bits, with a row of zeros before the first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.concatenate([np.zeros((1, 64), dtype=np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def _prints(sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """SimHash of shingles low..high-1 of each window."""
    majority = 2 * (sums[high] - sums[low]) > (high - low)[:, None]
    return np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)


def counted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minima over sum of maxima of the counts of equal values."""
    left, n = np.unique(a, return_counts=True)
    right, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


class ItemIndex:
    """Fingerprints of some benchmark items by size and block, and the shingles that lead to them."""

    def __init__(self, texts: list[str | None], radius: int = RADIUS, shingle: int = SHINGLE, similarity: float = SIMILARITY):
        self.radius, self.similarity = radius, similarity
        words = [normal_words(t) for t in texts]
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.size = np.minimum(self.length, shingle)
        self.shingles = [shingles(w, int(k)) for w, k in zip(words, self.size, strict=True)]
        self.prints = np.array(
            [_prints(_bit_sums(s), np.array([0]), np.array([len(s)]))[0] if len(s) else 0 for s in self.shingles], dtype=np.uint64
        )
        self.kinds = {}
        for size in sorted(set(self.size.tolist()) - {0}):
            own = np.flatnonzero(self.size == size)
            pairs = np.unique(
                np.concatenate([np.stack([self.shingles[i], np.full(len(self.shingles[i]), self.length[i], dtype=np.uint64)], 1) for i in own]), axis=0
            )
            values, first = np.unique(pairs[:, 0], return_index=True)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[values & np.uint64((1 << 20) - 1)] = True
            self.kinds[size] = (seen, values, np.r_[first, len(pairs)], pairs[:, 1].astype(np.int64))
        self._index_blocks()

    def _index_blocks(self) -> None:
        reach = self.radius // (len(BLOCKS) - 1)
        keys, items = [], []
        own = np.flatnonzero(self.length > 0)
        for block, (low, high) in enumerate(zip(BLOCKS, BLOCKS[1:], strict=False)):
            width = high - low
            masks = [sum(1 << b for b in c) for n in range(min(reach, width) + 1) for c in combinations(range(width), n)]
            near = self._block(self.prints[own], block)[:, None] ^ np.array(masks, dtype=np.uint64)[None, :]
            keys.append(self._key(self.length[own][:, None], block, near).ravel())
            items.append(np.repeat(own, len(masks)))
        keys, items = np.concatenate(keys), np.concatenate(items)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items = keys[order], items[order]

    @staticmethod
    def _block(prints: np.ndarray, block: int) -> np.ndarray:
        low, width = BLOCKS[block], BLOCKS[block + 1] - BLOCKS[block]
        return (prints >> np.uint64(low)) & np.uint64((1 << width) - 1)

    @staticmethod
    def _key(length: np.ndarray | int, block: int, value: np.ndarray) -> np.ndarray:
        return (np.asarray(length, dtype=np.uint64) << np.uint64(16)) | np.uint64(block << 12) | value

    def near(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, for windows of one length."""
        found = []
        for block in range(len(BLOCKS) - 1):
            key = self._key(length, block, self._block(prints, block))
            low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            item = self.items[np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())]
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
            found.append(np.stack([window[close], item[close]], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def _windows(self, at: np.ndarray, lengths: np.ndarray, size: int, words: int) -> Iterator[tuple[int, np.ndarray]]:
        """(length, starts) of the windows that hold a shingle of an item of that length."""
        for length in np.unique(lengths).tolist():
            hits = np.unique(at[lengths == length])
            if words <= length:
                yield length, np.array([0])
                continue
            low, high = np.maximum(hits - (length - size), 0), np.minimum(hits, words - length)
            edge = np.zeros(words - length + 2, dtype=np.int32)
            inside = low <= high
            np.add.at(edge, low[inside], 1)
            np.add.at(edge, high[inside] + 1, -1)
            yield length, np.flatnonzero(np.cumsum(edge)[:-1] > 0)

    def matches(self, text: str | None) -> list[tuple[int, float, int, int, int]]:
        """(item, similarity, first word, words, distance): the best window of each item that is similar enough."""
        words = normal_words(text)
        best: dict[int, tuple] = {}
        for size, (seen, values, first, lengths) in self.kinds.items():
            own = shingles(words, size)
            maybe = np.flatnonzero(seen[own & np.uint64((1 << 20) - 1)])
            slot = np.minimum(np.searchsorted(values, own[maybe]), len(values) - 1)
            real = values[slot] == own[maybe]
            if not real.any():
                continue
            at, slot = maybe[real], slot[real]
            count = first[slot + 1] - first[slot]
            spread = np.repeat(first[slot] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            for length, starts in self._windows(np.repeat(at, count), lengths[spread], size, len(words)):
                for part in np.split(starts, np.flatnonzero(np.diff(starts // REGION)) + 1):
                    self._verify(own, size, length, part, best)
        return [best[i] for i in sorted(best)]

    def _verify(self, own: np.ndarray, size: int, length: int, starts: np.ndarray, best: dict[int, tuple]) -> None:
        low = int(starts[0])
        high = min(int(starts[-1]) + length - size + 1, len(own))
        ends = np.minimum(starts + length - size + 1, len(own))
        prints = _prints(_bit_sums(own[low:high]), starts - low, ends - low)
        window, item = self.near(prints, length)
        for w, i in zip(window.tolist(), item.tolist(), strict=True):
            if self.size[i] != size:
                continue
            alike = counted_similarity(own[starts[w] : ends[w]], self.shingles[i])
            if alike >= self.similarity and (i not in best or alike > best[i][1]):
                distance = int(np.bitwise_count(prints[w] ^ self.prints[i]))
                best[i] = (i, alike, int(starts[w]), int(ends[w] - starts[w]) + size - 1, distance)


def item_blocks(benchmark: DataFrame, ident: str, text: str) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of the items, a bounded number of words at a time."""
    ids, texts, words = [], [], 0
    for row in benchmark.select(F.col(ident), F.col(text).cast("string")).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        words += len((row[1] or "").split()) + 1
        if words >= INDEX_WORDS:
            yield ids, texts
            ids, texts, words = [], [], 0
    if ids:
        yield ids, texts


def _matcher(shared, kind: pa.DataType):
    def block_matches(column: pa.Array) -> pa.Array:
        names, index = shared.value
        fields = ("similarity", "first_word", "n_words", "distance")
        rows = [[{"item_id": names[m[0]]} | dict(zip(fields, m[1:], strict=True)) for m in index.matches(v)] for v in column.to_pylist()]
        return pa.array(rows, type=kind)

    block_matches.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return block_matches


def benchmark_matches(
    text: Column, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", radius: int = RADIUS, similarity: float = SIMILARITY
) -> Column:
    """An array of (``item_id``, ``similarity``, ``first_word``, ``n_words``, ``distance``) for a text column.

    Items of fewer than five words are compared as one shingle of their words; empty and NULL items match nothing, empty
    and NULL texts match nothing, equal items match alike. A text shorter than an item is compared as a whole. The items
    are indexed on the driver in blocks of at most ``INDEX_WORDS`` words (or one item), each broadcast on its own.
    """
    spark = benchmark.sparkSession
    id_type = benchmark.schema[item_id].dataType
    kind = f"array<struct<item_id:{id_type.simpleString()}, similarity:double, first_word:bigint, n_words:bigint, distance:int>>"
    found = []
    for ids, texts in item_blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast((ids, ItemIndex(texts, radius, similarity=similarity)))
        found.append(F.arrow_udf(_matcher(shared, _ARROW[id_type.simpleString()]), kind)(text.cast("string")))
    if not found:
        return F.expr(f"cast(array() as {kind})")
    return found[0] if len(found) == 1 else F.concat(*found)


def _match_type(item: pa.DataType) -> pa.DataType:
    fields = [("item_id", item), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int32())]
    return pa.list_(pa.struct(fields))


_ARROW = {"bigint": _match_type(pa.int64()), "int": _match_type(pa.int32()), "string": _match_type(pa.string())}


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", columns: tuple[str, ...] = ("doc_id",), **names: str) -> DataFrame:
    """One row for each row of ``docs`` and benchmark item found in it, with the best window."""
    found = docs.select(*columns, benchmark_matches(F.col(text), benchmark, **names).alias("__found"))
    return found.select(*columns, F.explode("__found").alias("__m")).select(*columns, "__m.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, in place: no row is moved."""
    return docs.filter(F.size(benchmark_matches(F.col(text), benchmark, **names)) == 0)
