"""Positions, chunks, joins and the memory against brute force on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from glossweave.operators import chunks, lookup
from glossweave.operators.inference import call_tasks, run_requests
from glossweave.operators.ordering import ordered_positions
from glossweave.operators.pool import build_pool
from glossweave.session import stage_path
from glossweave.sources import memory as mem
from glossweave.sources.delimited import scan_delimited, scan_folder, scan_with_rejects, sniff_files, write_by_language
from glossweave.sources.protocol import CARRIED_ROW, PROTOCOL_COLUMNS, ProtocolTable, upsert_protocol


def next_fit(sizes, max_items, max_chars):
    out, chunk, n, used = [], -1, max_items, 0
    for size in sizes:
        if n == max_items or used + size > max_chars:
            chunk, n, used = chunk + 1, 0, 0
        out.append((chunk, n))
        n, used = n + 1, used + size
    return out


@pytest.fixture(scope="module")
def sized(spark):
    rng = random.Random(7)
    rows = [(g, k, rng.choice([0, 1, 2, 3, 5, 9, 30])) for g, n in (("hot", 400), ("b", 37), ("c", 1), (None, 60)) for k in range(n)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    return rows, spark.createDataFrame(shuffled, "g string, k bigint, size bigint")


@pytest.mark.parametrize("fan_in, block_rows", [(2, 5), (3, 7), (512, 50), (512, 100_000)])
def test_greedy_chunks_equal_one_pass(sized, monkeypatch, fan_in, block_rows):
    rows, frame = sized
    monkeypatch.setattr(chunks, "FAN_IN", fan_in)
    packed = chunks.greedy_chunks(frame, ["g"], ["k"], "size", 5, 20, block_rows)
    got = {(r.g, r.k): (r.chunk_no, r.item_no) for r in packed.collect()}
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]
        expected = next_fit([r[2] for r in mine], 5, 20)
        assert [got[(g, r[1])] for r in mine] == expected
    assert len(got) == len(rows)


def test_positions_and_running_sums(sized):
    rows, frame = sized
    placed = ordered_positions(frame, ["g"], ["k"], running={"done": "size"}, totals={"total": "size"}, partitions=5)
    got = {(r.g, r.k): (r.pos, r.done, r.total) for r in placed.collect()}
    for g in {r[0] for r in rows}:
        mine, done = [r for r in rows if r[0] == g], 0
        for at, (_, k, size) in enumerate(mine):
            done += size
            assert got[(g, k)] == (at, done, sum(r[2] for r in mine))


def test_fixed_batches_and_halves(spark):
    frame = spark.range(23).withColumn("lang", F.lit("x"))
    batched = chunks.fixed_batches(frame, ["lang"], ["id"], 5)
    assert all((r.batch_no, r.item_no) == divmod(r.id, 5) for r in batched.collect())
    halves = chunks.split_failed_chunks(batched, ["lang", "batch_no"])
    sizes = {(r.batch_no, r.half): r["count"] for r in halves.groupBy("batch_no", "half").count().collect()}
    assert sizes[(0, 0)] == 2 and sizes[(0, 1)] == 3 and sizes[(4, 0)] == 1 and sizes[(4, 1)] == 2


def test_row_requests_skip_blank_fields(spark):
    cells = spark.createDataFrame(
        [("EN", "1", 2, "A", "x"), ("EN", "1", 2, "B", " "), ("EN", "1", 1, "A", "y"), ("EN", "1", 3, "A", "")],
        "lang string, chunk_no string, row_id bigint, col string, value string",
    )
    row = chunks.row_requests(cells, ["lang", "chunk_no"]).first()
    assert row.request == '[{"row_index":1,"fields":{"A":"y"}},{"row_index":2,"fields":{"A":"x"}}]'
    assert row.n_items == 2 and row.ids == [1, 2]


def test_salted_join_equals_plain_join(spark, monkeypatch):
    rows = [(i, None if i % 5 == 0 else ("hot" if i % 3 else f"k{i % 7}")) for i in range(300)]
    big = spark.createDataFrame(rows, "row bigint, key string")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "key string, v int")
    counted = big.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    plain = sorted((r.row, r.key, r.v) for r in big.join(small, "key", "left").collect())
    monkeypatch.setattr(lookup, "MAX_HOT_KEYS", 1)
    hot = lookup.hot_keys(counted, "key", "n", at_least=10)
    assert hot is not None and hot.count() == 1
    for chosen in (None, hot):
        joined = lookup.salted_left_join(big, small, "key", ["row"], chosen)
        assert sorted((r.row, r.key, r.v) for r in joined.collect()) == plain


def test_pool_order_and_counts(spark):
    cells = spark.createDataFrame(
        [(-3, 1, "Was  ist das?"), (2, 0, "Eine Frage"), (1, 0, "Was ist das? "), (5, 1, "Eine Frage"), (7, 0, "12"), (8, 0, " ")],
        "row_id bigint, col_ord int, value string",
    )
    got = {r.text_norm: (r.first_col, r.first_row, r.n_cells) for r in build_pool(cells).collect()}
    assert got == {"Was ist das?": (0, 1, 2), "Eine Frage": (0, 2, 2)}
    only = spark.createDataFrame([(-3, 1, "Eine Frage")], "row_id bigint, col_ord int, value string")
    assert build_pool(only).first().first_row == -3


def _memory_rows(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, text_norm string, translation string, is_fallback boolean, attempt int")
    return frame.withColumns({"model": F.lit("m"), "rules_id": F.lit("r"), "updated_at": F.localtimestamp()})


def test_memory_latest_wins_and_replay(spark):
    memory = mem.TranslationMemory(spark, stage_path(spark, "memory"))
    assert memory.current().count() == 0
    memory.append(_memory_rows(spark, [("EN", "a b c", "one", False, 0), ("AR", "a b c", "a b c", True, 0)]), "1")
    for _ in range(2):
        memory.append(_memory_rows(spark, [("EN", "a b c", "two", False, 1), ("AR", "x y z", "z", False, 1), ("EN", "a b c", "a b c", True, 2)]), "2")
    assert memory.log().count() == 8  # a batch that comes again is added, never replaced
    now = {(r.lang, r.text_norm): r.translation for r in memory.current().collect()}
    assert now == {("EN", "a b c"): "two", ("AR", "a b c"): "a b c", ("AR", "x y z"): "z"}
    pool = spark.createDataFrame([("a b c",), ("x y z",)], "text_norm string")
    keyed = mem.with_memory_key(pool, ["EN", "AR"], "m", "r")
    misses = {(r.lang, r.text_norm) for r in mem.memory_misses(keyed, memory.current()).collect()}
    assert misses == {("EN", "x y z"), ("AR", "a b c")}
    small = memory.compact(stage_path(spark, "compact"))
    assert small.log().count() == 3 and small.current(["EN"]).first().translation == "two"


def test_apply_with_empty_memory_changes_nothing(spark):
    cells = spark.createDataFrame([(1, "A", "Eine Frage"), (2, "A", "12"), (3, "A", "")], "row_id bigint, col string, value string")
    empty = spark.createDataFrame([], "lang string, text_norm string, translation string, is_fallback boolean")
    applied = lookup.apply_memory(cells, empty, ["EN", "AR"]).collect()
    assert len(applied) == 6 and all(r.output == r.value and not r.is_hit for r in applied)


def test_delimited_round_trip(spark, tmp_path):
    text = ' Nr ;Frage;A\n1;"Zeile 1\nZeile ""2""";\n2;NA; x \n'
    for name, content in (("semi.csv", text), ("bom.csv", "﻿" + text)):
        (tmp_path / name).write_text(content, encoding="utf-8")
        got = [tuple(r) for r in scan_delimited(spark, str(tmp_path / name), ";", "utf-8-sig").collect()]
        assert got == [("1", 'Zeile 1\nZeile "2"', ""), ("2", "NA", " x ")]
    (tmp_path / "comma.csv").write_text("a,b,c;\n1,2,3\n", encoding="utf-8")
    found = {r.path.rsplit("/", 1)[1]: r.separator for r in sniff_files(spark, str(tmp_path)).collect()}
    assert found == {"semi.csv": ";", "bom.csv": ";", "comma.csv": ","}
    (tmp_path / "twice.csv").write_text("a; a \n1;2\n", encoding="utf-8")
    with pytest.raises(ValueError):
        scan_delimited(spark, str(tmp_path / "twice.csv"), ";")


def test_write_replaces_only_written_languages(spark, tmp_path):
    def frame(lang, value):
        return spark.createDataFrame([(1, value, "", lang)], "id int, v string, e string, lang string")

    path = str(tmp_path / "out")
    write_by_language(frame("EN", "a").union(frame("AR", "b")), path)
    write_by_language(frame("EN", 'c;"d"\n'), path, order=["v", "missing", "e"])
    english = scan_delimited(spark, path + "/lang=EN", ";").collect()
    assert [tuple(r) for r in english] == [('c;"d"\n', "")]
    assert scan_delimited(spark, path + "/lang=AR", ";").count() == 1


def test_protocol_upsert(spark):
    def rows(*values):
        base = spark.createDataFrame(values, "Sprache string, Manuell_korrigiert string, Anpassungen_am_Prompt string, Laufzeit string")
        return base.select(*[F.col(c) if c in base.columns else F.lit("").alias(c) for c in PROTOCOL_COLUMNS])

    old = rows(("en", "3 cells", "kept", "1m00s"), ("AR", " ", "", "2m00s"), ("TR", "x", "y", "3m00s"))
    new = rows(("EN", "", "new", "9m00s"), ("ar", "", "", "8m00s"), ("RU", "", "", "7m00s"))
    pool = {r.Sprache: (r.Manuell_korrigiert, r.Anpassungen_am_Prompt, r.Laufzeit) for r in upsert_protocol(old, new).collect()}
    assert pool == {"EN": ("3 cells", "kept", "9m00s"), "ar": ("", "", "8m00s"), "RU": ("", "", "7m00s"), "TR": ("x", "y", "3m00s")}
    row = {r.Sprache: r.Anpassungen_am_Prompt for r in upsert_protocol(old, new, CARRIED_ROW).collect()}
    assert row["EN"] == "new"


def test_rows_that_do_not_fit_are_rejected_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n1;2\n3;4;LOST\n"x\ny";z\n5\n')
    good, bad = scan_with_rejects(spark, str(tmp_path / "a.csv"), ";")
    assert sorted(map(tuple, good.collect())) == [("1", "2"), ("x\ny", "z")]
    assert good.select("b").count() == 2 and sorted(r.row for r in bad.collect()) == ["3;4;LOST", "5"]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        scan_delimited(spark, str(tmp_path / "a.csv"), ";").collect()
    (tmp_path / "b.csv").write_text("b;a\nB;A\n")
    (tmp_path / "c.csv").write_text("a,b\n7,8\n")
    good, bad = scan_folder(spark, str(tmp_path))
    assert sorted(map(tuple, good.select("a", "b").collect())) == [("1", "2"), ("7", "8"), ("A", "B"), ("x\ny", "z")] and bad.count() == 2


def test_protocol_table_keeps_files_apart(spark, tmp_path):
    def rows(*values):
        data = [tuple({"Datei": d, "Sprache": s, "Datum": t}.get(c, "") for c in PROTOCOL_COLUMNS) for d, s, t in values]
        return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in PROTOCOL_COLUMNS))

    protocol = ProtocolTable(spark, str(tmp_path / "protocol"))
    assert protocol.upsert(rows(("one", "EN", "1"), ("two", "EN", "1")))
    assert protocol.upsert(rows(("two", "en", "2"), ("two", "AR", "2"))) and not protocol.upsert(rows(("x", "y", "z")).limit(0))
    got = sorted((r.Datei, r.Sprache, r.Datum) for r in protocol.read().collect())
    assert got == [("one", "EN", "1"), ("two", "AR", "2"), ("two", "en", "2")] and protocol.versions() == [0, 1]


def test_stages_can_be_removed(spark):
    path = stage_path(spark, "short")
    spark.range(3).write.parquet(path)
    from glossweave import session

    kept, session._STAGES[:] = session._STAGES[:-1], [path]
    assert session.remove_stages(spark) == 1 and session.remove_stages(spark) == 0
    session._STAGES[:] = kept


def test_small_calls_share_tasks(spark):
    """Calls of a few words, as halving leaves them, do not get a task for every 50; full calls do."""
    requests = spark.range(400).select(
        F.lit("EN").alias("lang"), F.col("id").cast("string").alias("chunk_no"), F.lit("[]").alias("request"),
        F.lit(0).alias("n_items"), F.lit(30).alias("n_chars"), F.array().cast("array<bigint>").alias("ids"),
    )
    sent = run_requests(requests, lambda lang, request, attempt: {"raw": "[]"})
    assert sent.select(F.input_file_name()).distinct().count() <= 4
    assert call_tasks(480_000, 480_000 * 60, 200) == 480 and call_tasks(50_000, 50_000 * 18_000, 200) == 1_000
    assert call_tasks(3, 0, 200) == 3 and call_tasks(0, 0, 200) == 1


def test_calls_are_spread_as_asked(spark):
    """Requests that are partitioned by their chunk already are dealt out all the same, and answers come in their rows."""
    items = spark.range(400).select(
        F.lit("EN").alias("lang"), (F.col("id") % 80).cast("string").alias("chunk_no"), "id", F.col("id").cast("string").alias("text_norm")
    )
    requests = chunks.text_requests(items, ["lang", "chunk_no"])
    sent = run_requests(requests, lambda lang, request, attempt: {"raw": request.replace("text", "translation")})
    assert sent.select(F.input_file_name()).distinct().count() == 4
    assert sent.where("status = 'ok'").selectExpr("inline(items)").where("id = translation").count() == 400
