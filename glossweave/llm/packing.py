"""Best-fit packing of tokenised documents into sequences of a fixed size.

The plan needs only how many pieces there are of each length, at most ``capacity`` numbers, so it is made from that
histogram: pieces above a third of the capacity are matched greedily, largest with the largest that still fits, at most two
to a sequence, and smaller ones go to the tightest gap, longest first. The plan is a list of runs (this many pieces of a
length, from this rank on, go to consecutive sequences at this offset) whose number depends on the capacity, not on
the table. Ranks of equally long pieces are counted in salted groups, so no length is gathered in one task.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.common import TOKENIZERS, filled, text_bytes
from glossweave.session import materialise

CAPACITY = 4096
END_ID = 1
#: Words in each of a Python worker's two tables, of which the older goes when the newer is full.
WORDS_KEPT = 200_000
#: Groups that the pieces of one length are numbered in.
SALTS = 64


class WordIds:
    """Ids of single words, remembered by a worker.

    The vocabulary drops white space, ignores case and never merges across blanks or between letters and punctuation, so a
    text's ids are those of its words in a row. Words of Latin letters, also before one full stop or comma, go straight to
    the merges of the model; any other word takes the tokenizer's full way. Special tokens cut a text where they stand as they
    are spelt, before letters lose their case, so a word in lower case never becomes one.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.special = {token.content.encode(): array("I", [i]).tobytes() for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile(b"(" + b"|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        #: The characters that stand for bytes in a byte-level vocabulary.
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def whole(self, word: bytes) -> bytes:
        return array("I", self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def letters_only(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters; None for any other."""
        if not word.isalpha():
            return None
        low = word.lower()
        if not word.isascii():
            if max(word) >= "\u0250" or "\u0130" in word or not unicodedata.is_normalized("NFC", word):
                return None
            low = low.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(low)]).tobytes()

    def learn(self, word: bytes) -> bytes:
        """Ids of a word whose ASCII letters are in lower case; also remembers what stands before a full stop or comma."""
        ids = self.older.get(word)
        if ids is None and len(word) > 1 and word[-1] in b".,":
            stem, last = word[:-1], word[:-1].decode("utf-8", "replace")[-1]
            if last.isalpha() and last < "\u0250" and last != "\u0130":
                ids = (self.known.get(stem) or self.learn(stem)) + (self.known.get(word[-1:]) or self.learn(word[-1:]))
        if ids is None:
            ids = self.letters_only(word.decode("utf-8", "replace"))
        self.known[word] = ids = self.whole(word) if ids is None else ids
        return ids

    def text(self, data: bytes) -> bytes:
        """Little-endian 32-bit ids of a text."""
        parts = self.cut.split(data) if self.cut else [data]
        return b"".join(self.special[part] if k % 2 else self.words(part) for k, part in enumerate(parts))

    def words(self, data: bytes) -> bytes:
        """Ids of a text without special tokens."""
        if len(self.known) > WORDS_KEPT:
            self.older, self.known = self.known, {}
        known = self.known
        words = data.lower().split()
        for word in set(words).difference(known):
            self.learn(word)
        return b"".join(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_ids(data: bytes, path: str) -> bytes:
    """Little-endian 32-bit ids of a text."""
    return _word_ids(path).text(data)


def token_pieces(docs: DataFrame, ident: Column, text: str, path: str, capacity: int, end_id: int) -> DataFrame:
    """(``id``, ``piece``, ``start``, ``length``, ``ids_crc32``): each text's ids and the end id, cut at ``capacity``."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            for k, data in enumerate(text_bytes(batch.column(1))):
                ids = token_ids(data, path) + end
                for piece, low in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[low : low + 4 * capacity]
                    row.append(k)
                    out.append((piece, low // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    chosen = docs.select(ident.alias("id"), filled(F.col(text)).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


class _Sequences:
    """Groups of sequences that are filled alike: consecutive numbers with one free space."""

    def __init__(self, capacity: int):
        self.capacity, self.count = capacity, 0
        self.gaps: list[int] = []
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self.groups:
                bisect.insort(self.gaps, gap)
                self.groups[gap] = []
            self.groups[gap].append((first, n))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        """Takes out a group whose free space is the smallest that holds ``length``: (space, first, number)."""
        k = bisect.bisect_left(self.gaps, length)
        if k == len(self.gaps):
            return None
        gap = self.gaps[k]
        first, n = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap], self.gaps[k]
        return gap, first, n

    def open(self, n: int) -> int:
        self.count += n
        return self.count - n


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, rank from, rank before, first sequence, pieces a sequence, offset) for a count of each length."""
    sequences, runs = _Sequences(capacity), []
    ranked = dict.fromkeys(histogram, 0)

    def put(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        runs.append((length, ranked[length], ranked[length] + pieces, first, each, offset))
        ranked[length] += pieces

    left = {length: n for length, n in histogram.items() if 3 * length > capacity}
    large = sorted(left)
    for length in reversed(large):
        while left[length]:
            k = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while k >= 0 and not left[large[k]]:
                large.pop(k)
                k -= 1
            mate = large[k] if k >= 0 else None
            if mate == length and left[length] == 1:
                k -= 1
                while k >= 0 and not left[large[k]]:
                    large.pop(k)
                    k -= 1
                mate = large[k] if k >= 0 else None
            if mate is None:
                n = left[length]
            elif mate == length:
                n = left[length] // 2
            else:
                n = min(left[length], left[mate])
            first = sequences.open(n)
            if mate == length:
                put(length, 2 * n, first, 2, 0)
                left[length] -= 2 * n
            else:
                put(length, n, first, 1, 0)
                left[length] -= n
                if mate is not None:
                    put(mate, n, first, 1, length)
                    left[mate] -= n
            sequences.add(capacity - length - (mate or 0), first, n)
    for length in sorted((x for x in histogram if 3 * x <= capacity), reverse=True):
        rest = histogram[length]
        while rest:
            found = sequences.tightest(length)
            gap, first, n = found or (capacity, None, -(-rest // (capacity // length)))
            first = sequences.open(n) if first is None else first
            each = gap // length
            full = min(n, rest // each)
            if full:
                put(length, full * each, first, each, capacity - gap)
                sequences.add(gap - each * length, first, full)
                rest -= full * each
            if full < n and rest:
                put(length, rest, first + full, rest, capacity - gap)
                sequences.add(gap - rest * length, first + full, 1)
                full, rest = full + 1, 0
            sequences.add(gap, first + full, n - full)
    return runs


def _ranked(pieces: DataFrame) -> DataFrame:
    """``rank`` from 0 among the pieces of each length, numbered in salted groups with offsets from their sizes."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(SALTS)))
    sizes = salted.groupBy("length", "salt").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("length", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")
    numbered = salted.withColumn("rank", F.row_number().over(order) - 1)
    return numbered.join(offsets, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base")


def pack_documents(
    docs: DataFrame,
    ident: Column,
    text: str = "text",
    vocabulary: str = f"{TOKENIZERS}/word_bpe_49k.json",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row for each piece of each row of ``docs``, with its sequence and its place there.

    NULL and empty texts are one piece that holds the end id. Repeated rows, also with a NULL id, are packed each on its own.
    An empty table gives no pieces. The histogram (at most ``capacity`` rows) is all that reaches the driver; the
    broadcast plan has a few runs for each length.
    """
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, ident, text, vocabulary, capacity, end_id), "pieces")
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    runs = packing_plan(histogram, capacity)
    names = "length bigint, low bigint, high bigint, first bigint, each bigint, base bigint"
    plan = spark.createDataFrame(runs, names).groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "first", "each", "base"))).alias("runs"))
    placed = _ranked(pieces).join(F.broadcast(plan), "length")
    run = F.element_at(F.filter("runs", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"])), 1)
    step = F.col("rank") - F.col("run.low")
    return placed.withColumn("run", run).select(
        "id", "piece", "start", "length", "ids_crc32",
        (F.col("run.first") + F.floor(step / F.col("run.each"))).cast("bigint").alias("sequence_id"),
        (F.col("run.base") + F.col("length") * F.pmod(step, F.col("run.each"))).cast("bigint").alias("offset"),
    )
