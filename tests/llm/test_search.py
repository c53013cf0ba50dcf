"""Search, fingerprints and clustering against brute force; every edge case has a defined result."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from glossweave.llm import lexical_search
from glossweave.llm.centroids import MAX_COMPONENT, centroid_clusters, nearest, vantage_tree
from glossweave.llm.imatch import FINGERPRINTS_SQL, document_fingerprints, likeness
from glossweave.llm.lexical_search import ranked_search, term_weight, terms_of

WORDS = ["alpha", "beta", "gamma", "delta", "ñandú", "x1", "x2", "über", "the", "of"]


def ranked_by_hand(docs, items, k=10):
    terms = [(d, re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for d, t in docs]
    n_docs, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = Counter(t for _, w in terms for t in set(w))
    rows = []
    for item, text in items:
        scores = []
        for doc, words in terms:
            if words:
                m, tf = 25 + (75 * len(words) * n_docs) // total, Counter(words)
                query = [t for t in terms_of((text or "").encode()) if t.decode() in tf]
                parts = [term_weight(n_docs, df[t.decode()]) * ((10**9 * tf[t.decode()]) // (1000 * tf[t.decode()] + 8 * m)) for t in query]
                scores.append((-sum(parts), doc is None, doc))
        best = sorted((s for s in scores if s[0] < 0), key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        rows += [(item, rank + 1, doc, -score) for rank, (score, _, doc) in enumerate(best)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_ranked_search_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 60)
    monkeypatch.setattr(lexical_search, "ITEM_COLUMNS", 6)
    monkeypatch.setattr(lexical_search, "SHARD_CELLS", 400)
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice(WORDS[: draw.choice([2, 10])]) for _ in range(n))
    docs = [(i, text(draw.randint(1, 30))) for i in range(300)] + [(i + 300, "alpha beta") for i in range(100)]
    docs += [(7, "Alpha, BETA"), (7, "Alpha, BETA"), (None, "gamma x1"), (None, None), (900, None), (901, ""), (902, "... !"), (903, "alpha " * 50_000)]
    items = [(i, text(draw.randint(1, 12))) for i in range(12)] + [(50, None), (51, "unknown words"), (52, "GAMMA gamma"), (None, "x1"), (3, "the of"), (3, "the of")]
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit("x"), "n": F.lit(2)}).repartition(5)
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(0))
    found = [tuple(r) for r in ranked_search(left, right).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(found, key=key) == sorted(ranked_by_hand(docs, items), key=key)


def test_ranked_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = F.lit(False)
    for left, right in ((docs.filter(none), items), (docs, items.filter(none)), (docs.withColumn("text", F.lit(None)), items)):
        assert ranked_search(left, right).collect() == []
    # The only document holds every term: its weight is floor(1000 ln(4 / 3)).
    assert ranked_search(docs, items).collect()[0]["score"] == 2 * math.floor(1000 * math.log(4 / 3)) * (10**9 // 1800)


def test_bounds_hold_for_whole_numbers_beyond_doubles(spark):
    assert lexical_search.item_groups([(np.array([0]), np.array([2**50]))], 1)[0].kind is np.int64


def fingerprints_by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return con.execute(FINGERPRINTS_SQL).fetchall()


def test_fingerprints_equal_sql_and_tell_edits_from_others(spark):
    draw = random.Random(5)
    lexicon = [f"w{i}" for i in range(30_000)]
    rows = [(i, " ".join(draw.choices(lexicon, k=draw.choice([0, 1, 3, 40, 200, 700])))) for i in range(250)]
    rows += [(1000, None), (1001, ""), (1002, "!!"), (1003, rows[5][1]), (1004, "é" * 9), (1005, " ".join(lexicon) * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "pos": F.lit(2), "term": F.lit("t")}).repartition(4)
    found = [tuple(r) for r in document_fingerprints(docs).collect()]
    assert sorted(found) == sorted(fingerprints_by_sql(rows))
    by_id = {r[0]: r for r in found}
    assert by_id[1003][3] == by_id[5][3] and by_id[1000][3] == by_id[1002][3] == "" != by_id[1004][3]
    for doc, text in rows:
        following = rows[([r[0] for r in rows].index(doc) + 1) % len(rows)][1] or ""
        text = text or ""
        edited = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        assert by_id[doc][1:3] == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    long = [r for r in found if r[1] > 700]
    assert np.mean([r[5] for r in long]) > 0.3 > 0.1 > np.mean([r[6] for r in long])


def test_fingerprints_of_repeated_rows_null_ids_and_nothing(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f g h"), (None, "q r s t"), (2, "u v w x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(document_fingerprints(docs).collect(), key=str)
    assert [r["doc_id"] for r in found].count(1) == 3 and len(found) == 5
    once = [r for r in found if r["doc_id"] == 1 and r["n_chars"] == 5]
    assert len(once) == 2 and once[0] == once[1]
    last = next(r for r in found if r["doc_id"] == 2)
    # The row without an id comes first, so it follows the last one.
    assert last["edited_sha256"] == hashlib.sha256(b"u v w q").hexdigest()
    assert document_fingerprints(docs.filter("false")).collect() == []
    alone = document_fingerprints(docs.filter("doc_id = 2")).collect()[0]
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"u v w u").hexdigest()


def test_likeness(spark):
    none = ",".join(["-"] * 15)
    rows = [(f"2:a,{none},b,{none}", f"2:a,{none},c,{none}", 0.5), (f"2:a,{none},b,{none}", f"3:b,{none},x,{none}", 1.0), ("", "", 1.0), ("", "*:1", 0.0)]
    rows += [(f"2:a,{none},b,{none}", f"4:b,{none},a,{none}", 0.0), ("*:1", f"0:a,{none},b,{none}", 0.0), ("*:1", "*:1", 1.0)]
    found = spark.createDataFrame(rows, "a string, b string, want double").select(likeness(F.col("a"), F.col("b")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in found)


def clusters_by_hand(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, v) for i, v in kept if max(map(abs, v)) <= MAX_COMPONENT]
    centres = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)]
    final = [(i, *reversed(near(v))) for i, v in kept]
    of = Counter()
    for _, c, d in final:
        of[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, c, d, of[c], sum(of.values()), digest[c]) for i, c, d in final]


@pytest.mark.parametrize("spread", [1.0, 0.004])
def test_clusters_equal_brute_force(spark, spread):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=64) * spread).tolist()) for i in range(160)]
    rows += [(i + 500, rows[0][1]) for i in range(80)] + [(7, rows[7][1]), (None, rows[3][1])]
    rows += [(900, None), (901, []), (902, [0.0] * 63), (903, [0.0] * 65), (904, [None] * 64), (905, [math.nan] * 64), (906, [math.inf] + [0.0] * 63)]
    rows += [(907, [1e30] * 64), (908, [-131072.0] + [0.0] * 63)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit("c"), "v": F.lit(1), "label": F.lit(2)})
    found = [tuple(r) for r in centroid_clusters(df.repartition(6)).collect()]
    assert sorted(found, key=str) == sorted(clusters_by_hand(rows), key=str)


def test_clusters_of_few_and_no_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in centroid_clusters(df).collect()) == sorted(clusters_by_hand(rows))
    assert centroid_clusters(df.filter("vec_id > 5")).collect() == []
    assert centroid_clusters(df.withColumn("embedding", F.lit(None).cast("array<float>"))).collect() == []
    with pytest.raises(ValueError):
        centroid_clusters(df, k=0)


@pytest.mark.parametrize("k", [1, 2, 8, 61])
def test_tree_finds_the_nearest_and_the_smaller_number(k):
    draw = np.random.default_rng(k)
    points, vectors = draw.integers(-4, 4, (k, 3)), draw.integers(-5, 5, (500, 3))
    points[k // 2] = points[0]
    apart = ((vectors[:, None] - points) ** 2).sum(2)
    who, distance = nearest(vantage_tree(points), vectors)
    assert (distance == apart.min(1)).all() and (who == apart.argmin(1)).all()
