"""Packing, archives, the pipeline and the registered queries."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from glossweave.llm.bk_forest import distance
from glossweave.llm.near_dedup import shared_share, shingle_hashes, simhash
from glossweave.llm import queries
from glossweave.llm.packing import CAPACITY, pack_documents, packing_plan, token_ids
from glossweave.llm.warc import MAGIC, archive_round_trip, read_archives, record_length
from pyspark.sql import functions as F

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def plain(frame):
    """Rows in no order, columns by name, NULL as None, whole numbers alike in every type."""
    value = lambda v: None if pd.isna(v) else int(v) if not isinstance(v, str) and v == int(v) else v
    return sorted(str([value(v) for v in row]) for row in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


@pytest.mark.parametrize("capacity", [7, 100, 4096])
def test_plan_places_every_piece_once(capacity):
    rng = random.Random(capacity)
    for trial in range(40):
        lengths = [min(capacity, 1 + int(rng.expovariate(rng.choice([2, 5, 20]) / capacity))) for _ in range(rng.randrange(300))]
        bins, ranks = defaultdict(list), Counter()
        for length, low, high, first, each, base in packing_plan(dict(Counter(lengths)), capacity):
            assert ranks[length] == low
            ranks[length] = high
            for r in range(high - low):
                bins[first + r // each].append((base + length * (r % each), length))
        assert ranks == Counter(lengths)
        for held in bins.values():
            ends = np.cumsum([n for _, n in sorted(held)])
            assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= capacity
            assert sum(3 * n > capacity for _, n in held) <= 2
        large = Counter(n for n in lengths if 2 * n > capacity)
        assert len(bins) >= max(math.ceil(sum(lengths) / capacity), sum(large.values()))
        assert len(bins) <= 11 / 9 * max(math.ceil(sum(lengths) / capacity), sum(large.values())) + 1


def test_word_ids_are_those_of_the_tokenizer(tokenizer):
    rng = random.Random(0)
    texts = [r["text"] for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()[:80]]
    texts += [" ".join(chr(rng.randrange(33, 0x400)) * rng.randrange(1, 3) + rng.choice(["", ".", ",", ".,", "é."]) for _ in range(3000)) for _ in range(3)]
    texts += ["<|endoftext|>", "a <|ENDOFTEXT|> <|endoftext|><|startoftext|>. <|end<|endoftext|>́a <|endoftext|", "x<|StartOfText|>y"]
    texts += ["ΑΣ ΣΑΣ. İİ. it's 'S <|endoftext|> a<|startoftext|>b 日本語 😀👍🏽\x1cq ﬁ é. ́x", ""]
    for text in texts:
        assert tokenizer.encode(text, add_special_tokens=False).ids == np.frombuffer(token_ids(text.encode(), VOCABULARY), "<u4").tolist()


def test_packing_against_the_tokenizer(spark, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()]
    rows += [(900, None), (901, ""), (903, "one <|endoftext|> two<|startoftext|>" * 700), (902, "word " * 9000), (902, "word " * 9000), (None, "x"), (None, "x")]
    got = pack_documents(spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, length int"), F.col("doc_id")).collect()
    want = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, low in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[low : low + CAPACITY]
            want[i, piece, low, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        ends = np.cumsum([n for _, n in sorted(held)])
        assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= CAPACITY
    assert len(places) <= math.ceil(sum(r["length"] for r in got) / CAPACITY) + 2
    assert pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), F.col("doc_id")).count() == 0


def test_archives_with_magic_inside_payloads(spark):
    fake = MAGIC.decode() + "Content-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(k, f"http://h/{k}", f"page {k % 4} " * 40) for k in range(12)]
    rows += [(50, "u", fake * 60), (51, "u", "x" * 3000 + fake + MAGIC.decode() + "Content-Length: 99999\r\n\r\n" + "z" * 4000), (52, None, None), (53, "u\r\nv", ""),
             (None, "q", fake * 60), (54, "u", MAGIC.decode() * 700), (55, "u", "é" * 99), (55, "u", "é" * 99), (56, "u", "small"), (57, "u", "small")]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id bigint, url string, html string, payload_digest string").coalesce(2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6k")
    try:
        got = archive_round_trip(pages).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    con = duckdb.connect()
    con.register("pages", pages.drop("payload_digest").toPandas().astype({"page_id": "Int64"}))
    want = con.execute(queries.ORACLES["op10_warc"]).fetchdf()
    assert plain(got) == plain(want)
    assert archive_round_trip(pages.limit(0)).count() == 0


def test_repeated_ids_with_other_payloads_lose_no_revisit(spark, tmp_path):
    texts = [f"version {v} " * 30 for v in range(8)]
    rows = [(1, "u", t) for t in texts] + [(5 + k, "u", t) for k, t in enumerate(texts)]
    got = archive_round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string")).toPandas()
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    assert plain(got) == plain(con.execute(queries.ORACLES["op10_warc"]).fetchdf()) and len(got) == 16
    alone = b"WARC-Type: revisit\r\nWARC-Record-ID: <a>\r\nWARC-Refers-To: <b>\r\nWARC-Payload-Digest: sha256:0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    (tmp_path / "alone.warc").write_bytes(MAGIC + alone)
    with pytest.raises(Exception, match="no response for revisit <a>"):
        read_archives(spark, str(tmp_path)).collect()


def test_a_file_that_does_not_start_with_a_record_has_none(spark, tmp_path):
    (tmp_path / "odd.warc").write_bytes(b"junk" + MAGIC + b"Content-Length: 1\r\n\r\nx\r\n\r\n")
    assert read_archives(spark, str(tmp_path)).count() == 0
    assert record_length(MAGIC + b"Content-Length: 7\r\n\r\n") == len(MAGIC) + 21 + 7 + 4 and record_length(MAGIC + b"Content-Length: x\r\n\r\n") == -1


def test_pipeline_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[1] == sizes[0] > 0.7 * spark.read.parquet(f"{SMALL}/documents.parquet").count() and sizes[3] <= sizes[2] <= sizes[1]
    drop = ("sequence_id", "offset")
    assert sorted(corpus_pipeline.run(spark, SMALL).drop(*drop).collect()) == sorted(docs.drop(*drop).collect())


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "word " * 60, "en", None, 3), (3, "Some words. " * 400, None, "s", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() <= len(rows)
        assert stage(spark, docs.limit(0), SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, SMALL).toPandas(), con.execute(queries.ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SMALL).count() > 0


def test_near_dedup_of_the_pipeline_links_what_op5_links(spark):
    """Texts within 3 bits of the 64-bit fingerprint are one group, also where few of their distinct shingles are common."""
    chant = "lorem ipsum dolor sit amet " * 20
    texts = [chant, chant + " ".join(f"word{i}" for i in range(71)), "a text of its own that nothing else in this table is like"]
    near, wide = (int(distance(*(simhash(shingle_hashes(t.encode(), k), n)[None] for t in texts[:2]))[0]) for k, n in ((3, 1), (5, 4)))
    assert near <= 3 and wide > 0 and shared_share(texts[0].encode(), texts[1].encode(), 5) < 0.2
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id bigint, text string")
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]
