"""SimHash near-duplicates, searched in BK-trees.

Distinct fingerprints are dealt to shards so that near ones meet in at least one: by equal 16-bit blocks (within a
radius of 3 one of four blocks is equal, so nothing is missed), or, for wide fingerprints with a large radius, by the
smallest of several hashes of the shingles. Each shard is cut into chunks of bounded size. A chunk's tree goes to the
chunks that query it, and nowhere else: a broadcast of all trees would have no size bound. Tasks send out only a
spanning forest of what they find, never all pairs, and components come from distributed rounds. Where links have to be
similar, a first reading links what a few forests show; then the texts of all fingerprints that are near one of another
component go to the meetings, and every such pair is tested there unless links have joined it by then.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.llm.bk_forest import BKForest, distance
from glossweave.llm.common import components, filled, mix64, text_bytes
from glossweave.llm.graphs import connected_components
from glossweave.session import materialise

#: Fingerprints in one tree, and in one block of queries.
CHUNK = 512
#: Spanning forests whose links are read first when links have to be similar; this saves tests and decides nothing.
FORESTS = 3
#: Rows, and bytes of text, of whole meetings that a task solves together.
MEETING_ROWS, MEETING_BYTES = 50_000, 1 << 24
#: Near pairs of a task that are handed on together, up to those of one piece of the search.
PAIRS = 1 << 18
#: A shard of equal 16-bit blocks with more fingerprints than this is divided by a second block of 12 bits.
WIDE_SHARD = 2048
_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


def shingle_hashes(data: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``size`` words, A-Z in lower case; fewer words give one hash of all of them."""
    words = data.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    start = np.r_[0, end[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(start[: len(words) - size + 1].tolist(), end[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype=np.uint64, count=len(words) - size + 1)


def simhash(hashes: np.ndarray, words: int = 1) -> np.ndarray:
    """A fingerprint of 64 x ``words`` bits: a bit is 1 if it is set in over half the hashes; none give zero."""
    out = np.zeros(words, dtype=np.uint64)
    if not len(hashes):
        return out
    for k in range(words):
        octets = (hashes if k == 0 else mix64(hashes, k)).astype(">u8").view(np.uint8).reshape(-1, 8)
        count = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
        out[k] = np.packbits(count * 2 > len(hashes)).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, ident: Column, text: str, shingle: int, words: int, minima: int) -> DataFrame:
    """(``id``, ``print``, ``mins``) of every row; ``mins`` are ``minima`` smallest hashes under different functions."""
    chosen = docs.select(ident.alias("id"), filled(F.col(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, mins = [], []
            for data in text_bytes(batch.column(1)):
                hashes = shingle_hashes(data, shingle)
                prints.append(simhash(hashes, words).view(np.int64))
                mins.append([int(mix64(hashes, 100 + k).min().view(np.int64)) if len(hashes) else k for k in range(minima)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.list_(pa.int64())), pa.array(mins, pa.list_(pa.int64()))], ["id", "print", "mins"]
            )

    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, print array<bigint>, mins array<bigint>")


def _block_shards(distinct: DataFrame) -> DataFrame:
    """(``shard``, ``print``): four 16-bit blocks of the fingerprint; a crowded block is divided by a further 12 bits.

    Within a crowded block a near fingerprint differs in at most 3 of the other 48 bits, so one of their four parts of
    12 bits is equal as well. There are at most 4 x 65,536 blocks, which bounds the broadcast list of crowded ones.
    """
    word = F.col("print")[0]

    def field(value: Column, low: int, bits: int) -> Column:
        return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << bits) - 1))

    blocks = F.array(*[F.struct(F.lit(k).alias("block"), field(word, 16 * k, 16).alias("value")) for k in range(4)])
    dealt = distinct.select("print", F.explode(blocks).alias("b")).select("print", "b.block", "b.value")
    crowded = dealt.groupBy("block", "value").count().filter(F.col("count") > WIDE_SHARD).select("block", "value", F.lit(True).alias("wide"))
    low = F.expr("print[0] & (shiftleft(1L, 16 * block) - 1)")
    high = F.expr("if(block = 3, 0L, shiftrightunsigned(print[0], 16 * (block + 1)))")
    rest = F.expr("shiftleft(_high, 16 * block) | _low")
    parts = F.array(*[F.struct(F.lit(k).alias("part"), field(F.col("_rest"), 12 * k, 12).alias("bits")) for k in range(4)])
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("bits")))
    return (
        dealt.join(F.broadcast(crowded), ["block", "value"], "left")
        .withColumns({"_low": low, "_high": high})
        .withColumn("_rest", rest)
        .select("print", "block", "value", F.explode(F.when(F.col("wide"), parts).otherwise(whole)).alias("p"))
        .select(F.struct("block", "value", F.col("p.part"), F.col("p.bits")).alias("shard"), "print")
    )


def _minima_shards(distinct: DataFrame, *more: str) -> DataFrame:
    return distinct.select("print", *more, F.posexplode("mins").alias("k", "least")).select(F.struct("k", "least").alias("shard"), "print", *more)


def _chunk_pairs(shards: DataFrame, *more: str) -> DataFrame:
    """One row for each (shard, tree chunk, query chunk) that a fingerprint belongs to; shards of one print are left out.

    Chunks i <= j of a shard meet once, the tree being that of chunk i. With a column ``root`` among ``more``, shards of one
    root are left out too.
    """
    several = [(F.min("root") != F.max("root")).alias("several")] if "root" in more else [F.lit(True).alias("several")]
    size = shards.groupBy("shard").agg(F.count("*").alias("count"), *several).filter("count > 1 AND several")
    chunks = F.ceil(F.col("count") / F.lit(CHUNK)).cast("int")
    rows = shards.join(size, "shard").select("shard", "print", *more, chunks.alias("n")).withColumn("own", F.pmod(F.xxhash64("print"), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")
    return rows.select("shard", "print", *more, "own", other).select(
        F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"),
        "shard", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("asks"),
        (F.col("own") <= F.col("other")).alias("in_tree"), (F.col("own") >= F.col("other")).alias("in_query"), "print", *more,
    )


def spanning_pairs(n: int, label: np.ndarray, a: np.ndarray, b: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The new components, and which of the links a[i] - b[i] make a spanning forest of them, short ones first.

    Each component takes its shortest link out until none is left.
    """
    took = [np.empty(0, dtype=np.int64)]
    left = np.arange(len(a))
    while True:
        left = left[label[a[left]] != label[b[left]]]
        if not len(left):
            return label, np.concatenate(took)
        rank = far[left] * len(a) + left
        best = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, label[a[left]], rank)
        np.minimum.at(best, label[b[left]], rank)
        pick = np.unique(best[best < np.iinfo(np.int64).max]) % len(a)
        took.append(pick)
        label = components(n, np.r_[a[pick], np.arange(n)], np.r_[b[pick], label])


def _spanning_links(meetings: DataFrame, words: int, radius: int, forests: int) -> DataFrame:
    """(``u``, ``v``) pairs within ``radius`` that span what is linked in each meeting of two chunks, near pairs first.

    Further forests are made of the pairs that earlier ones leave, so that four fingerprints give all of their pairs to three.
    """

    def solve(table: pa.Table) -> pa.RecordBatch:
        prints = _words(table, "print", words)
        labels = [np.arange(len(prints))] * forests
        ends: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, dtype=np.int64),) * 2]
        for a, b in _near_pairs(table, prints, radius):
            far = distance(prints[a], prints[b])
            for k in range(forests):
                labels[k], took = spanning_pairs(len(prints), labels[k], a, b, far)
                ends.append((a[took], b[took]))
                a, b, far = (np.delete(x, took) for x in (a, b, far))
        a, b = (np.concatenate([e[k] for e in ends]) for k in (0, 1))
        return _link_batch(prints, a, b) if forests > 1 else _star_batch(prints, a, b)

    return _solve_meetings(_by_meeting(meetings).select("change", "in_tree", "in_query", "print"), solve, "u array<bigint>, v array<bigint>")


def _by_meeting(meetings: DataFrame) -> DataFrame:
    """The rows of each meeting one after another, told apart by ``change``."""
    dealt = meetings.repartition("meeting").sortWithinPartitions("shard", "tree", "asks")
    return dealt.withColumn("change", F.struct("shard", "tree", "asks").cast("string"))


def _solve_meetings(rows: DataFrame, solve: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``solve`` on some whole meetings after another; rows of a meeting lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < MEETING_ROWS and sum(b.nbytes for b in held) < MEETING_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.column("change")[-1].as_py()
            change = table.column("change").to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(change != last)[-1]) + 1 if (change != last).any() else 0
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


def _words(table: pa.Table, column: str, words: int, kind: type = np.uint64) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy().view(kind).reshape(-1, words)


def _near_pairs(table: pa.Table, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs a > b within ``radius`` that one tree and its queries show, each once, in sorted batches as they are found."""
    group = table.column("change").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    in_tree, in_query = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("in_tree", "in_query"))
    members, asking = np.flatnonzero(in_tree), np.flatnonzero(in_query)
    forest = BKForest(prints[members], group[members])
    held: list[np.ndarray] = []

    def batch() -> tuple[np.ndarray, np.ndarray]:
        keys = np.sort(np.concatenate(held))
        held.clear()
        return keys // len(prints), keys % len(prints)

    for asked, found in forest.search(prints[asking], group[asking], radius):
        a, b = asking[asked], members[found]
        once = (a > b) | (a < b) & ~(in_tree[a] & in_query[b])
        held.append(np.maximum(a, b)[once] * len(prints) + np.minimum(a, b)[once])
        if sum(map(len, held)) >= PAIRS:
            yield batch()
    if held:
        yield batch()


def _link_batch(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    sides = [pa.array(list(prints[side].view(np.int64)), pa.list_(pa.int64())) for side in (a, b)]
    return pa.RecordBatch.from_arrays(sides, ["u", "v"])


def _star_batch(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Links of each fingerprint with the smallest one that a[i] - b[i] lead to; the rounds that follow are fewer."""
    ends, at = np.unique(prints[np.r_[a, b]].view(np.int64), axis=0, return_inverse=True)
    at = at.reshape(-1)
    root = components(len(ends), at[: len(a)], at[len(a) :])
    far = np.flatnonzero(root != np.arange(len(ends)))
    return _link_batch(ends.view(np.uint64), far, root[far])


def shared_share(a: bytes, b: bytes, size: int) -> float:
    """Shingles that two texts share, of all that either has."""
    left, right = (np.unique(shingle_hashes(x, size)) for x in (a, b))
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both / (len(left) + len(right) - both) if len(left) + len(right) else 1.0


def _texts_of(prints: DataFrame, distinct: DataFrame, docs: DataFrame, ident: Column, text: str) -> DataFrame:
    ends = prints.join(distinct.select("print", "first"), "print")
    texts = docs.select(ident.alias("first"), filled(F.col(text)).alias("text")).join(ends, "first").dropDuplicates(["print"])
    return materialise(texts.select("print", "text"), "near-texts")


def _similar_links(
    links: DataFrame, distinct: DataFrame, docs: DataFrame, ident: Column, text: str, shingle: int, words: int, similarity: float
) -> DataFrame:
    """Stars of the links whose texts, read once more, are similar enough."""
    links = materialise(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "near")
    texts = _texts_of(links.select(F.explode(F.array("u", "v")).alias("print")).distinct(), distinct, docs, ident, text)
    sides = [texts.select(F.col("print").alias(k), F.col("text").alias(f"text_{k}")) for k in ("u", "v")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(text_bytes(batch.column(2)), text_bytes(batch.column(3)), strict=True)
            keep = np.flatnonzero([shared_share(a, b, shingle) >= similarity for a, b in pairs])
            sides = [_words(pa.table({c: batch.column(c)}), c, words)[keep] for c in ("u", "v")]
            yield _star_batch(np.concatenate(sides), np.arange(len(keep)), np.arange(len(keep)) + len(keep))

    joined = links.join(sides[0], "u").join(sides[1], "v").select("u", "v", "text_u", "text_v")
    return joined.mapInArrow(run, "u array<bigint>, v array<bigint>")


def shared_shares(one: int, others: np.ndarray, ids: np.ndarray, start: np.ndarray, size: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """``shared_share`` of one row's set with others'; ``ids[start : start + size]`` are a row's shingles, ``mark`` is all False."""
    own = ids[start[one] : start[one] + size[one]]
    mark[own] = True
    n = size[others]
    first = np.cumsum(n) - n
    both = np.add.reduceat(mark[ids[np.repeat(start[others] - first, n) + np.arange(n.sum())]].astype(np.int64), first)
    mark[own] = False
    return both / (len(own) + n - both)


def _remaining_links(
    distinct: DataFrame, roots: DataFrame, docs: DataFrame, ident: Column, text: str, shingle: int, words: int, radius: int, minima: int, similarity: float
) -> DataFrame:
    """(``u``, ``v``) similar pairs that join what ``roots`` leaves apart, from all near pairs of different roots.

    A pair belongs to the first of its equal minima, so it is tested in one meeting only.
    """
    rooted = distinct.join(roots, F.col("print") == F.col("u"), "left").select("print", "mins", F.coalesce("root", "print").alias("root"))
    meetings = _by_meeting(_chunk_pairs(_minima_shards(rooted, "root", "mins"), "root", "mins"))
    kept = ["change", "k", "in_tree", "in_query", "print", "root", "mins"]
    schema = "change string, k int, in_tree boolean, in_query boolean, print array<bigint>, root array<bigint>, mins array<bigint>"

    def apart(table: pa.Table, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        root, mins, k = _words(table, "root", words), _words(table, "mins", minima, np.int64), table.column("k").to_numpy()
        for a, b in _near_pairs(table, prints, radius):
            keep = (root[a] != root[b]).any(axis=1) & ((mins[a] == mins[b]).argmax(axis=1) == k[a])
            yield a[keep], b[keep]

    def mark_rows(table: pa.Table) -> pa.RecordBatch:
        asked = np.zeros(table.num_rows, dtype=bool)
        for a, b in apart(table, _words(table, "print", words)):
            asked[a] = asked[b] = True
        return table.filter(pa.array(asked)).combine_chunks().to_batches()[0] if asked.any() else pa.RecordBatch.from_pylist([], table.schema)

    def solve(table: pa.Table) -> pa.RecordBatch:
        prints = _words(table, "print", words)
        sets = [np.unique(shingle_hashes(data, shingle)) for data in text_bytes(table.column("text").combine_chunks())]
        size = np.array([len(s) for s in sets])
        start = np.cumsum(size) - size
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(values), dtype=bool)
        label = np.unique(_words(table, "root", words), axis=0, return_inverse=True)[1].reshape(-1)
        ends: list[tuple[int, int]] = []
        for a, b in apart(table, prints):
            cut = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else a
            for one, others in zip(a[cut].tolist(), np.split(b, cut[1:]), strict=True) if len(a) else ():
                fits = np.minimum(size[others], size[one]) >= similarity * np.maximum(size[others], size[one]) - 1e-6
                others = others[fits & (label[others] != label[one])]
                if not len(others):
                    continue
                for other in others[shared_shares(one, others, ids, start, size, mark) >= similarity].tolist():
                    if label[one] != label[other]:
                        label[label == label[other]] = label[one]
                        ends.append((one, other))
        pairs = np.array(ends, dtype=np.int64).reshape(-1, 2)
        return _star_batch(prints, pairs[:, 0], pairs[:, 1])

    marked = materialise(_solve_meetings(meetings.select(*[F.col("shard.k") if c == "k" else F.col(c) for c in kept]), mark_rows, schema), "marked")
    texts = _texts_of(marked.select("print").distinct(), distinct, docs, ident, text)
    told = marked.join(texts, "print").select(*kept, "text").repartition("change").sortWithinPartitions("change")
    return _solve_meetings(told, solve, "u array<bigint>, v array<bigint>")


def near_duplicates(
    docs: DataFrame, ident: Column, text: str = "text", shingle: int = 3, words: int = 1, radius: int = 3, minima: int = 0,
    similarity: float | None = None,
) -> DataFrame:
    """(``id``, ``print``, ``component``) for every row of ``docs``; ``component`` is the smallest ``id`` reachable.

    ``ident`` is any orderable column. With ``minima`` 0 the fingerprint has 64 bits, ``radius`` is at most 3 and every
    link is found. With ``minima`` k, rows meet where one of k smallest shingle hashes is equal, so two texts of
    similarity s are missed with a chance of (1 - s)^k. With ``similarity`` a link also needs that share of common
    shingles, read from both texts (``ident`` then has to tell texts apart), and every pair within ``radius`` that meets is
    tested unless tested links already join it; this form needs ``minima``. NULL texts count as empty; texts without words have the
    fingerprint zero and form one group; equal rows share a group; a NULL id is never the smallest unless a
    component has no other. An empty table gives an empty result.
    """
    if not minima and (radius > 3 or words != 1):
        raise ValueError("blocks find fingerprints of 64 bits within a radius of 3; give minima for more")
    if similarity is not None and not minima:
        raise ValueError("similarity needs minima")
    prints = materialise(fingerprints(docs, ident, text, shingle, words, minima), "prints")
    distinct = prints.groupBy("print").agg(F.min("id").alias("first"), F.min("mins").alias("mins"))
    shards = _minima_shards(distinct) if minima else _block_shards(distinct)
    links = _spanning_links(_chunk_pairs(shards), words, radius, FORESTS if similarity is not None else 1)
    if similarity is not None:
        distinct = materialise(distinct, "distinct")
        links = materialise(_similar_links(links, distinct, docs, ident, text, shingle, words, similarity), "similar")
        rule = (shingle, words, radius, minima, similarity)
        links = links.unionByName(_remaining_links(distinct, connected_components(links), docs, ident, text, *rule))
    roots = connected_components(links)
    rooted = distinct.join(roots, F.col("print") == F.col("u"), "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return prints.select("id", "print").join(rooted.join(smallest, "root").select("print", "component"), "print", "left").select("id", "print", "component")


def fingerprint_hex(column: Column) -> Column:
    """The 64 bits of a one-word fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column[0]), 16, "0"))


def one_of_each_group(docs: DataFrame, ident: str = "doc_id", text: str = "text", **rule: float) -> DataFrame:
    """The rows of ``docs`` with one left of each group of near duplicates: that of the smallest id.

    Rows that repeat id and text count as one. Where ids repeat with different texts, or are NULL, the hash of the text
    decides; ids come before NULL.
    """
    key = F.struct(F.col(ident).isNull().alias("none"), F.col(ident).alias("id"), F.xxhash64(filled(F.col(text))).alias("h"))
    groups = near_duplicates(docs, key, text, **rule).groupBy("id", "component").count()
    kept = groups.filter(F.col("id") == F.col("component")).select(F.col("id").alias("__key"), (F.col("count") > 1).alias("__many"))
    rows = docs.withColumn("__own", key).join(kept, F.col("__own") == F.col("__key"))
    kept_rows = rows.filter(~F.col("__many")).unionByName(rows.filter("__many").dropDuplicates(["__own"]))
    return kept_rows.drop("__own", "__key", "__many")
