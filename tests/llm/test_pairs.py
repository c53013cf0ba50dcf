"""Near duplicates, line windows and benchmark search against brute force, and their edge cases."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glossweave.llm import graphs, near_dedup
from glossweave.llm.bk_forest import BKForest, distance
from glossweave.llm.decontaminate import ItemIndex, contaminated, counted_similarity, normal_words, shingles, without_contaminated
from glossweave.llm.graphs import connected_components
from glossweave.llm.line_dedup import remove_repeated_lines
from glossweave.llm.near_dedup import fingerprint_hex, near_duplicates, one_of_each_group, shingle_hashes, simhash

DOCS = "doc_id bigint, text string"


def words(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(60)) for _ in range(n)]


def roots(n, links):
    up = list(range(n))
    for a, b in links:
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)
    out = []
    for k in range(n):
        while up[k] != k:
            k = up[k]
        out.append(k)
    return out


@pytest.mark.parametrize("width", [1, 4])
def test_forest_finds_every_pair(width):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, (12, width), dtype=np.uint64)
    prints = base[rng.integers(0, 12, 600)] ^ (np.uint64(1) << rng.integers(0, 63, (600, width), dtype=np.uint64)) * rng.integers(0, 2, (600, width), dtype=np.uint64)
    tree = np.sort(rng.integers(0, 5, 600))
    found = {(int(a), int(b)) for q, i in BKForest(prints, tree).search(prints, tree, 3) for a, b in zip(q, i, strict=True)}
    want = {(a, b) for a in range(600) for b in np.flatnonzero((distance(prints, prints[a : a + 1]) <= 3) & (tree == tree[a])).tolist()}
    assert found == want


def test_search_of_a_crowd_is_bounded_in_memory():
    """Each of 4,096 queries is near all 512 items of its tree; what is held at once must not grow with these two million pairs."""
    rng = np.random.default_rng(6)
    flips = np.uint64(1) << rng.integers(0, 63, (4, 4096, 4), dtype=np.uint64)
    prints = rng.integers(0, 1 << 63, (1, 4), dtype=np.uint64) ^ np.bitwise_xor.reduce(flips, axis=0)
    tree = np.repeat(np.arange(8), 512)
    forest, found = BKForest(prints, tree), 0
    tracemalloc.start()
    for asked, _ in forest.search(prints, tree, 52):
        found += len(asked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 8 * 512 * 512 and peak < 40e6


def test_near_pairs_come_once():
    rng = np.random.default_rng(7)
    prints = np.unique(rng.integers(0, 1 << 20, (300, 1), dtype=np.uint64), axis=0)
    n = len(prints)
    for alone in (True, False):
        in_tree = np.arange(n) % 2 == 0 if alone else np.ones(n, dtype=bool)
        in_query = ~in_tree if alone else in_tree
        table = pa.table({"change": ["m"] * n, "in_tree": in_tree, "in_query": in_query})
        got = [(int(a), int(b)) for x, y in near_dedup._near_pairs(table, prints, 6) for a, b in zip(x, y, strict=True)]
        far = [(a, b) for a in range(n) for b in range(a) if int(prints[a, 0] ^ prints[b, 0]).bit_count() <= 6 and (in_tree[a] != in_tree[b] or not alone)]
        assert sorted(got) == far


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graphs, "materialise", lambda df, label, write=graphs.materialise: written.append(label) or write(df, label))
    stars = [(10 + k, k % 3) for k in range(30)] + [(4, 4)]
    got = {r["u"]: r["root"] for r in connected_components(spark.createDataFrame(stars, "u bigint, v bigint")).collect()}
    assert got == {u: v for u, v in stars if u != v} and len(written) == 1


def test_star_links_lead_to_the_smallest_fingerprint():
    prints = np.array([[5, 1], [2**63, 9], [7, 7], [1, 1], [5, 1], [8, 8]], dtype=np.uint64)
    links = near_dedup._star_batch(prints, np.array([0, 4, 3]), np.array([1, 2, 5])).to_pylist()
    assert sorted((r["u"], r["v"]) for r in links) == [([5, 1], [-(2**63), 9]), ([7, 7], [-(2**63), 9]), ([8, 8], [1, 1])]
    assert near_dedup._star_batch(prints[:0], np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)).num_rows == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    got = {r["u"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 50)} | {200 + k: 200 for k in range(1, 9)}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_components_with_a_hub_of_most_links(spark):
    rng = random.Random(11)
    links = [(5000, k) for k in range(1, 3000)] + [(rng.randrange(3000, 5000), rng.randrange(3000, 5000)) for _ in range(1500)] + [(7, 5000), (9, 9)]
    root = roots(5001, links)
    got = {r["u"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {k: root[k] for k in range(5001) if root[k] != k}


@pytest.mark.parametrize("wide", [2048, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, wide):
    """Also with crowded shards that are divided and cut into many chunks."""
    monkeypatch.setattr(near_dedup, "WIDE_SHARD", wide)
    monkeypatch.setattr(near_dedup, "CHUNK", 8 if wide == 3 else 512)
    rng = random.Random(3)
    rows, base = [], [words(rng, 400) for _ in range(6)]
    for k in range(150):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(400)] = "changed"
        rows.append((k * 3 + 7, " ".join(text)))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (None, "one"), (None, "alone here"), (4, "one"), (6, "x " * 50_000)]
    got = near_duplicates(spark.createDataFrame(rows, DOCS), F.col("doc_id")).select("id", fingerprint_hex(F.col("print")).alias("f"), "component").collect()
    prints = [int(simhash(shingle_hashes((t or "").encode(), 3))[0]) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = roots(len(rows), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    want = sorted((str(i), f"{p:016x}", str(least.get(root[k]))) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True)))
    assert sorted((str(r["id"]), r["f"], str(r["component"])) for r in got) == want
    assert near_duplicates(spark.createDataFrame([], DOCS), F.col("doc_id")).count() == 0


def test_fingerprint_is_the_bitwise_majority():
    hashes = np.array([0b1110, 0b0110, 0b0011], dtype=np.uint64)
    assert int(simhash(hashes)[0]) == 0b0110
    assert int(simhash(np.array([1, 2], dtype=np.uint64))[0]) == 0
    assert len(shingle_hashes(b"a b", 3)) == 1 and len(shingle_hashes(b"a b c d", 3)) == 2


def test_one_of_each_group_keeps_clean_rows_and_one_copy(spark):
    rng = random.Random(9)
    clean = [(k, " ".join(words(rng, 120))) for k in range(30)]
    edited = [(100 + k, t.replace(t.split()[50], "other", 1)) for k, t in clean[:10]]
    rows = clean + edited + [clean[3], clean[3], (None, clean[4][1]), (500, None), (501, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, component string")
    got = one_of_each_group(docs, shingle=5, words=4, radius=52, minima=6, similarity=0.8)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [*range(30), 500]


def brute_lines(rows):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    first, covered = {}, [set() for _ in rows]
    for k in order:
        lines = (rows[k][1] or "").split("\n")
        solid = [p for p, line in enumerate(lines) if line.strip(" \t\r\x0b\x0c")]
        for a in range(len(solid) - 2):
            window = tuple(lines[p].strip(" \t\r\x0b\x0c") for p in solid[a : a + 3])
            low, high = solid[a], solid[a + 2]
            if window in first:
                doc, end = first[window]
                covered[k] |= set(range(max(low, end + 1) if doc == k else low, high + 1))
            else:
                first[window] = (k, high)
    return [None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in covered[k]) for k, (_, t) in enumerate(rows)]


def test_repeated_lines_equal_brute_force(spark):
    rng = random.Random(1)
    passage = ["p one", "p two ", "p three", "p four"]
    rows = []
    for k in range(60):
        lines = [" ".join(words(rng, 3)) if rng.random() < 0.7 else rng.choice(["", "same", "\t same"]) for _ in range(rng.randrange(12))]
        if k % 3 == 0:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage
        rows.append((k, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "a\na\na\na\na"), (None, "\n".join(passage)), (73, "\n".join(["long"] * 20_000))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, covered int")
    got = remove_repeated_lines(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(str, zip((r[0] for r in rows), brute_lines(rows), strict=True)))
    twice = remove_repeated_lines(spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc")], DOCS)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in twice) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "")]
    assert remove_repeated_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_contaminated_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, rng.randrange(8, 40)))) for k in range(25)] + [(90, None), (91, ""), (92, "Tiny item"), (93, "Tiny, item!")]
    rows = []
    for k in range(80):
        text = words(rng, rng.randrange(0, 150))
        if k % 2:
            leak = rng.choice(items[:25])[1].split()
            if k % 4 == 1:
                leak[len(leak) // 2 :] = [w.upper() + "," for w in leak[len(leak) // 2 :]]
            if k % 8 == 3:
                leak = leak[:-1]
            if k % 8 == 7:
                leak = leak[: len(leak) // 2]
            text[len(text) // 2 : len(text) // 2] = leak
        rows.append((k, " ".join(text)))
    rows += [(200, None), (201, ""), (202, "so a tiny item here"), (203, "x " * 60_000 + items[0][1]), (None, items[1][1]), (1, rows[1][1])]
    docs, bench = spark.createDataFrame([(*r, 0.5) for r in rows], DOCS + ", similarity double"), spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(map(str, ((r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect())))
    want, leaky = [], set()
    for at, (i, t) in enumerate(rows):
        for j, item in items:
            size = min(5, len(normal_words(item)))
            own, wanted = shingles(normal_words(t), size), shingles(normal_words(item), size)
            starts = range(max(1, len(own) - len(wanted) + 1)) if len(own) and len(wanted) else ()
            keep = set(wanted.tolist())
            starts = [s for s in starts if keep & set(own[s : s + len(wanted)].tolist())] if len(own) < 5000 else range(60_000 - 5, 60_001)
            if any(counted_similarity(own[s : s + len(wanted)], wanted) >= 0.8 for s in starts):
                want.append(str((i, j)))
                leaky.add(at)
    assert got == sorted(want)
    kept = without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len(leaky)
    assert without_contaminated(docs, bench.limit(0)).count() == len(rows)
    assert contaminated(docs.limit(0), bench).count() == 0


def test_index_finds_every_fingerprint_within_its_radius():
    index = ItemIndex(["a b c d e f g h", "i j k l m n o p"])
    rng = random.Random(2)
    for _ in range(300):
        flips = rng.sample(range(64), rng.randrange(index.radius + 1))
        near = np.array([int(index.prints[1]) ^ sum(1 << b for b in flips)], dtype=np.uint64)
        assert 1 in index.near(near, 8)[1]


def test_links_are_verified_and_spanning(spark):
    rng = random.Random(6)
    rows = []
    for k in range(12):
        base = words(rng, 200)
        rows.append((10 * k, " ".join(base)))
        for copy, n_changes in ((1, 2), (2, 4), (3, 30)):
            text = list(base)
            for at in rng.sample(range(200), n_changes):
                text[at] = f"new{rng.randrange(10**6)}"
            rows.append((10 * k + copy, " ".join(text)))
    got = {r["id"]: r["component"] for r in near_duplicates(spark.createDataFrame(rows, DOCS), F.col("doc_id"), shingle=5, words=4, radius=52, minima=6, similarity=0.8).collect()}
    texts = dict(rows)
    ids = sorted(texts)
    links = [(a, b) for a in range(len(ids)) for b in range(a) if near_dedup.shared_share(texts[ids[a]].encode(), texts[ids[b]].encode(), 5) >= 0.8]
    root = roots(len(ids), links)
    assert got == {i: ids[root[k]] for k, i in enumerate(ids)}


@pytest.mark.parametrize("chunk", [512, 40])
def test_a_crowd_of_variants_keeps_its_links(spark, monkeypatch, chunk):
    """Each variant is similar to its base only, while nearly all pairs of variants are within the radius."""
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    rng = random.Random(12)
    base = words(rng, 500)
    rows = [(1000, " ".join(base))]
    for k in range(300):
        text = list(base)
        for at in rng.sample(range(0, 500, 5), 8):
            text[at] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    got = {r["id"]: r["component"] for r in near_duplicates(spark.createDataFrame(rows, DOCS), F.col("doc_id"), shingle=5, words=4, radius=52, minima=6, similarity=0.8).collect()}
    texts = dict(rows)
    ids = sorted(texts)
    sets = [np.unique(shingle_hashes(texts[i].encode(), 5)) for i in ids]
    links = []
    for a in range(len(ids)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    root = roots(len(ids), links)
    assert len(links) < 5000 and got == {i: ids[root[k]] for k, i in enumerate(ids)}


def test_spanning_pairs_are_a_forest_of_the_same_components():
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 60, 150), rng.integers(0, 60, 150)
    label, took = near_dedup.spanning_pairs(60, np.arange(60), a, b, rng.integers(0, 9, 150))
    u, v = a[took], b[took]
    want = roots(60, list(zip(a.tolist(), b.tolist(), strict=True)))
    assert label.tolist() == want == roots(60, list(zip(u.tolist(), v.tolist(), strict=True))) and len(u) == 60 - len(set(want))
