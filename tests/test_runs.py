"""Whole runs on a hand-written exam table, with a model that fails in every known way."""

import hashlib
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glossweave.catalog.models import pseudo_translate
from glossweave.operators.inference import translate_items
from glossweave.operators.ordering import with_row_id
from glossweave.operators.quality import MAX_ROUNDS
from glossweave.plans.by_pool import localize_pool
from glossweave.plans.by_row import localize_rows
from glossweave.plans.common import Settings, run_statistics
from glossweave.session import stage_path
from glossweave.sources.delimited import scan_delimited
from glossweave.sources.memory import TranslationMemory
from glossweave.sources.protocol import PROTOCOL_COLUMNS, ProtocolTable, protocol_rows, with_recommendations
from glossweave.sources.stages import RunStages

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER = "row_id;FrageNr;Zwischenprüfung;Abschlussprüfung; LF ;Abschnitt;Frage;A;B;C;Richtig1;Richtig_Text1;Richtig1_Text;Richtig2;Richtig_Text2;Bild;Sprache"
LINES = [
    '1;F1;x;;Lernfeld Eins;Abschnitt 1;"Was ist\n""das""?";Eine Antwort;NA;12 %;A;;;B;;;de',
    "2;F2;;x;Lernfeld Eins;Abschnitt 1;Welche Prüfung?;Die Antwort;Das Buch;;b;;;;;;de",
    "3;F3;;;Lernfeld Eins;Abschnitt 2;Was ist  das;Die Antwort;Das Buch;;Das Buch;alt;;;;;de",
    "4;F4;;;Lernfeld Zwei;Abschnitt 2;Was ist das;gleich gleich;gleich gleich;;gleich gleich;;;C;;;de",
    "5;F5;;;Lernfeld Zwei;;;;;;unbekannt;alt;;;;;de",
    "6;F6;;;Lernfeld Zwei;Abschnitt 2;Wer & wo?;Rechnung;ALG II;http://x.de;;;;;;;de",
]


@pytest.fixture(scope="module")
def exam(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("exam") / "exam.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", encoding="utf-8-sig")
    return scan_delimited(spark, str(path), ";", "utf-8-sig").withColumn("row_id", F.col("row_id").cast("bigint"))


def memory(spark):
    return TranslationMemory(spark, stage_path(spark, "memory"))


def test_pool_run_and_rerun(spark, exam):
    store, settings = memory(spark), Settings(["EN", "AR"], "m", "r", rename_exam_columns=True, max_rounds=0)
    first = localize_pool(exam, store, pseudo_translate, settings, "one")
    rows = {(r.row_id, r.lang): r for r in first.output.collect()}
    assert len(rows) == 12 and "Abschlussprüfung Teil 1" in first.output.columns and "Zwischenprüfung" not in first.output.columns
    one = rows[(1, "EN")]
    assert one["Frage"] == '[EN] Was ist\n"das"?' and one["LF"] == "[EN] Lernfeld Eins" and one["B"] == "NA" and one["C"] == "12 %"
    assert one["Richtig_Text1"] == one["Richtig1_Text"] == "[EN] Eine Antwort" and one["Richtig_Text2"] == "NA" and one["Sprache"] == "en"
    assert rows[(3, "AR")]["Richtig1"] == "B" and rows[(3, "AR")]["Richtig_Text1"] == "[AR] Das Buch"
    assert rows[(4, "EN")]["Richtig1"] == "A" and rows[(4, "EN")]["Frage"] == rows[(3, "EN")]["Frage"] == "[EN] Was ist das"
    assert rows[(5, "EN")]["Richtig1"] == "unbekannt" and rows[(5, "EN")]["Richtig_Text1"] == ""
    assert rows[(6, "EN")]["A"] == "Rechnung" and rows[(6, "EN")]["B"] == "ALG II" and rows[(6, "EN")]["FrageNr"] == "F6"
    assert len(first.checks) == 1 and first.checks[-1]["EN"] > 0
    second = localize_pool(exam, store, pseudo_translate, Settings(["EN", "AR"], "m", "r", max_rounds=0), "two")
    assert all(r.api_calls == 0 for r in second.usage.collect())


def test_retry_is_bounded(spark, exam):
    """The prefix leaves the German words in place; a short text stays suspect, and the run still ends."""
    run = localize_pool(exam, memory(spark), pseudo_translate, Settings(["EN"], "m", "r"))
    assert len(run.checks) == 1 + MAX_ROUNDS and run.checks[-1]["EN"] == 1
    suspects = {(r.row_id, r.col): r.output for r in run.suspects.collect()}
    assert suspects[(2, "Frage")] == "[EN] " * (1 + MAX_ROUNDS) + "Welche Prüfung?"


def digest(lang, request, attempt):
    got = [{"id": x["id"], "translation": f"{lang} {hashlib.sha256(x['text'].encode()).hexdigest()}"} for x in json.loads(request)]
    return {"raw": json.dumps(got), "prompt_tokens": 10, "completion_tokens": 20, "api_calls": 1}


def test_retry_stops_when_clean_and_feeds_the_protocol(spark, exam):
    def late(lang, request, attempt):
        if attempt < 2:
            got = [{"id": x["id"], "translation": x["text"]} for x in json.loads(request)]
            return digest(lang, request, attempt) | {"raw": json.dumps(got)}
        return digest(lang, request, attempt)

    settings = Settings(["EN"], "m", "r", column_order=["FrageNr", "Frage", "A", "Sprache"])
    run = localize_pool(exam, memory(spark), late, settings)
    assert run.output.columns == ["FrageNr", "Frage", "A", "Sprache", "lang"]
    counts = [c["EN"] for c in run.checks]
    assert len(counts) == 3 and counts[0] == counts[1] > 0 and counts[2] == 0
    stats = with_recommendations(run_statistics(run, settings, "exam", 6, 754.0))
    row = protocol_rows(stats).first()
    assert list(row.asDict()) == list(PROTOCOL_COLUMNS)
    assert row.Sprache == "EN" and row.Anzahl_Retries == "2" and row.Laufzeit == "12m34s" and row.Endgueltige_Deutsch_Reste == "0"
    assert row.Deutsch_Reste_automatisch == str(counts[0]) and row.Verdachtsfaelle_gesamt == row.Neu_uebersetzt == str(2 * counts[0])
    assert "Ergebnis OK nach 2 Retry(s)" in row.Empfehlung_naechster_Lauf


def faulty(lang, request, attempt):
    """Rejects any chunk of more than two items, each size in another way, and fails on one text for good."""
    items = json.loads(request)
    good = [{"id": str(x["id"]), "translation": f"<{x['text']}>"} for x in items]
    usage = {"prompt_tokens": 1, "completion_tokens": 1, "api_calls": 1}
    if any(x["text"] == "text number 3" for x in items):
        return usage | {"raw": "service down"}
    if len(items) > 8:
        return usage | {"raw": json.dumps(good)[:-4]}
    if len(items) > 4:
        return usage | {"raw": json.dumps(good[:-1])}
    if len(items) > 2:
        return usage | {"raw": json.dumps([*good[1:], good[1]])}
    return usage | {"raw": "```json\n" + json.dumps(good) + "\n```"}


def test_failed_chunks_are_halved(spark):
    items = spark.createDataFrame([("EN", 0, i, i, f"text number {i}") for i in range(19)], "lang string, chunk_no bigint, item_no bigint, id bigint, text_norm string")
    resolved, responses, failed = translate_items(items, faulty, 20)
    got = {r.id: (r.translation, r.is_fallback) for r in resolved.collect()}
    assert got == {i: (f"<text number {i}>", False) for i in range(19) if i != 3}
    kinds = {r.status for r in responses.select("status").distinct().collect()}
    assert kinds == {"ok", "unparsable", "size_mismatch", "id_mismatch"}
    assert [tuple(r) for r in failed.collect()] == [("EN", "text number 3", "unparsable", 0)]


def dead(lang, request, attempt):
    raise ConnectionError("service down")


def test_a_dead_service_is_not_halved_and_raises(spark, exam):
    items = spark.createDataFrame([("EN", 0, i, i, f"text number {i}") for i in range(9)], "lang string, chunk_no bigint, item_no bigint, id bigint, text_norm string")
    done = translate_items(items, dead, 20)
    assert done.responses.count() == 1 and done.resolved.count() == 0
    assert {tuple(r)[2] for r in done.failed.collect()} == {"ConnectionError: service down"} and done.failed.count() == 9
    with pytest.raises(RuntimeError, match="service down"):
        localize_pool(exam, memory(spark), dead, Settings(["EN"], "m", "r"))
    with pytest.raises(RuntimeError, match="service down"):
        localize_rows(exam, dead, Settings(["EN"]))
    run = localize_pool(exam, memory(spark), dead, Settings(["EN"], "m", "r", strict=False, max_rounds=0))
    assert run.failed.count() > 0 and run.usage.first().api_calls == 0


def test_answers_need_no_usage_figures(spark):
    items = spark.createDataFrame([("EN", 0, 0, 0, "a text")], "lang string, chunk_no bigint, item_no bigint, id bigint, text_norm string")
    done = translate_items(items, lambda lang, request, attempt: {"raw": pseudo_translate(lang, request, attempt)["raw"]}, 20)
    assert done.resolved.first().translation == "[EN] a text" and done.responses.first().api_calls == 0


def test_growing_input_with_default_ids_sends_new_texts_only(spark):
    store, settings = memory(spark), Settings(["EN"], "m", "r", max_rounds=0)
    frame = spark.createDataFrame([(i, f"Frage nummer {i}?") for i in range(3)], "row_id bigint, text string")
    localize_pool(frame.where("row_id < 2"), store, pseudo_translate, settings)
    run = localize_pool(frame, store, pseudo_translate, settings)
    assert sorted(r.text for r in run.output.collect()) == [f"[EN] Frage nummer {i}?" for i in range(3)]
    assert run.usage.first().api_calls == 1 and store.log().count() == 3


def test_row_ids_must_be_unique_and_can_be_assigned(spark):
    frame = spark.createDataFrame([(1, "Eine Frage?"), (1, "Zweite Frage?")], "row_id bigint, text string")
    for start in (lambda: localize_pool(frame, memory(spark), pseudo_translate, Settings(["EN"])), lambda: localize_rows(frame, pseudo_translate, Settings(["EN"]))):
        with pytest.raises(ValueError, match="unique"):
            start()
    numbered = with_row_id(frame.drop("row_id"))
    assert sorted(map(tuple, numbered.collect())) == [(0, "Eine Frage?"), (1, "Zweite Frage?")]
    run = localize_pool(numbered, memory(spark), pseudo_translate, Settings(["EN"], max_rounds=0))
    assert sorted(r.text for r in run.output.collect()) == ["[EN] Eine Frage?", "[EN] Zweite Frage?"]


def test_blank_answers_are_not_hits(spark, exam):
    def blank(lang, request, attempt):
        got = [{"id": x["id"], "translation": " "} for x in json.loads(request)]
        return digest(lang, request, attempt) | {"raw": json.dumps(got)}

    store, settings = memory(spark), Settings(["EN"], "m", "r", max_rounds=0)
    run = localize_pool(exam, store, blank, settings, "blank")
    assert {r.Frage for r in run.output.collect()} == {r.Frage for r in exam.collect()}
    assert store.log().where(~F.col("is_fallback")).count() == 0
    again = localize_pool(exam, store, digest, settings, "again")
    assert again.usage.first().api_calls > 0 and again.checks == [{"EN": 0}]


def test_row_strategy(spark, exam):
    seen = spark.sparkContext.accumulator(0)

    def stubborn(lang, request, attempt):
        seen.add(1)
        got = []
        for x in json.loads(request):
            same = {c: v if attempt == 0 and "Antwort" in v else f"[{lang}] {v}" for c, v in x["fields"].items()}
            got.append({"row_index": x["row_index"], "fields": same | {"unasked": "x"}})
        return {"raw": json.dumps(got), "prompt_tokens": 1, "completion_tokens": 1, "api_calls": 1}

    protected = [*Settings([]).protected, "Frage"]
    frame = exam.drop("Frage").join(exam.select("row_id", "Frage"), "row_id").select(*exam.columns)
    run = localize_rows(frame, stubborn, Settings(["EN"], protected=protected, row_batch=2, forced_dedup=["LF"]))
    rows = {r.row_id: r for r in run.output.collect()}
    assert rows[1]["A"] == "[EN] Eine Antwort" and rows[1]["Frage"] == 'Was ist\n"das"?' and rows[1]["LF"] == "[EN] Lernfeld Eins"
    assert rows[1]["B"] == "[EN] NA" and rows[5]["A"] == "" and rows[2]["Richtig_Text1"] == "[EN] Das Buch"
    assert run.checks == [{"EN": 3}, {"EN": 0}] and run.resent == [{"EN": 3}]
    assert run.usage.first().api_calls == seen.value


def test_row_strategy_by_rows(spark):
    frame = spark.createDataFrame([(i, f"Satz Nummer {i}") for i in range(500)], "row_id bigint, text string")
    run = localize_rows(frame, pseudo_translate, Settings(["EN"], row_batch=40))
    assert all(r.text == f"[EN] Satz Nummer {r.row_id}" for r in run.output.collect())
    assert run.usage.first().api_calls == 13


def test_stages_are_built_once(spark):
    stages, built = RunStages(spark, stage_path(spark, "run")), []

    def build():
        built.append(1)
        return spark.range(3)

    assert stages.get("a", build).count() == stages.get("a", build).count() == 3
    assert built == [1]


class Breaking(TranslationMemory):
    """Breaks off at one append."""

    def __init__(self, spark, path, at):
        super().__init__(spark, path)
        self.at = at

    def append(self, rows, batch_id):
        if batch_id.endswith(f"-{self.at}"):
            raise InterruptedError("broken off")
        super().append(rows, batch_id)


@pytest.mark.parametrize("at", [1])
def test_a_broken_run_goes_on_without_a_repeated_call(spark, exam, at):
    sent = spark.sparkContext.accumulator(0)

    def counting(lang, request, attempt):
        sent.add(1)
        return pseudo_translate(lang, request, attempt)

    settings = Settings(["EN"], "m", "r", resume_root=stage_path(spark, "runs"), calls_per_commit=2, max_items=6, max_rounds=1)
    whole = localize_pool(exam, memory(spark), counting, Settings(["EN"], "m", "r", max_items=6, max_rounds=1))
    expected, all_calls = sorted(map(tuple, whole.output.collect())), sent.value
    path = stage_path(spark, "memory")
    with pytest.raises(InterruptedError):
        localize_pool(exam, Breaking(spark, path, at), counting, settings)
    resumed = localize_pool(exam, TranslationMemory(spark, path), counting, settings)
    assert sorted(map(tuple, resumed.output.collect())) == expected and resumed.checks[-1] == whole.checks[-1]
    assert sent.value == 2 * all_calls
    other = Settings(["EN"], "m2", "r", resume_root=settings.resume_root, max_items=6, max_rounds=0)
    assert localize_pool(exam, memory(spark), counting, other).usage.first().api_calls > 0


def test_lasting_suspects_are_not_sent_again(spark, exam):
    store, settings = memory(spark), Settings(["EN"], "m", "r", max_rounds=1)
    first = localize_pool(exam, store, pseudo_translate, settings)
    second = localize_pool(exam, store, dead, settings)
    assert second.usage.first().api_calls == 0 and second.checks[-1] == first.checks[-1] != {"EN": 0}
    assert sorted(map(tuple, second.output.collect())) == sorted(map(tuple, first.output.collect()))


def test_row_strategy_resumes_from_its_answers(spark):
    frame = spark.createDataFrame([(i, f"Satz Nummer {i}") for i in range(500)], "row_id bigint, text string")
    settings = Settings(["EN"], row_batch=40, resume_root=stage_path(spark, "runs"))
    localize_rows(frame, pseudo_translate, settings)
    again = localize_rows(frame, dead, settings)
    assert again.usage.first().api_calls == 0 and all(r.text == f"[EN] Satz Nummer {r.row_id}" for r in again.output.collect())


def test_texts_without_a_translation_are_judged_by_their_form(spark):
    """Blank answers leave the cells as they are; two forms of one text are checked on their own."""
    def blank(lang, request, attempt):
        got = [{"id": x["id"], "translation": ""} for x in json.loads(request)]
        return {"raw": json.dumps(got), "api_calls": 1}

    frame = spark.createDataFrame([(1, "Was ist  das?"), (2, "Was ist das?"), (3, "Was ist das?"), (4, "hello world")], "row_id bigint, text string")
    run = localize_pool(frame, memory(spark), blank, Settings(["AR"], max_rounds=1, check_script=True))
    assert run.checks == [{"AR": 4}, {"AR": 4}]
    assert sorted((r.row_id, r.output) for r in run.suspects.collect()) == [(r.row_id, r.text) for r in frame.collect()]
    report = {(r.lang, r.col): (r.level, r.cells, r.suspect) for r in run.completeness().collect()}
    assert report == {(None, None): (0, 4, 4), ("AR", None): (1, 4, 4), ("AR", "text"): (2, 4, 4)}


def test_two_writers_of_one_protocol_version(spark):
    protocol = ProtocolTable(spark, stage_path(spark, "protocol"))
    rows = protocol_rows(spark.createDataFrame([("f", "EN")], "datei string, sprache string"))
    late = ProtocolTable(spark, protocol.path)
    late._numbers = lambda: []
    assert protocol.upsert(rows)
    with pytest.raises(Exception, match="already exists"):
        late.upsert(rows)
    assert protocol.versions() == [0] and protocol.read().count() == 1


def test_a_run_removes_what_only_it_reads(spark, exam):
    """Requests, responses and places are gone after a run with retries, and its output can still be read."""
    from glossweave import session

    before = set(session._STAGES)
    run = localize_pool(exam, memory(spark), pseudo_translate, Settings(["EN"], "m", "r"))
    left = {path.rsplit("/", 1)[1][:-33] for path in session._STAGES if path not in before}
    assert left <= {"memory", "pool", "answered", "failed", "judged", "retried"}
    assert run.output.count() == 6 and run.suspects.count() == 1 and run.failed.count() == 0
    assert spark.conf.get(session.CLEANUP, "false") == "false"


def test_what_got_no_answer_stays_in_the_output(spark, exam):
    def silent(lang, request, attempt):
        return {"raw": "no answer", "api_calls": 1} if "Lernfeld Eins" in request else pseudo_translate(lang, request, attempt)

    run = localize_pool(exam, memory(spark), silent, Settings(["EN"], "m", "r", strict=False, max_rounds=0))
    rows = {r.row_id: r for r in run.output.collect()}
    assert rows[1]["LF"] == "Lernfeld Eins" and rows[4]["LF"] == "[EN] Lernfeld Zwei" and len(rows) == 6
    assert [r.text for r in run.failed.collect()] == ["Lernfeld Eins"]


def test_items_travel_with_their_request(spark):
    """Halving gathers nothing again: it writes responses only, joins nothing, and drops what was to be halved."""
    from glossweave import session

    items = spark.createDataFrame(
        [("EN", i // 10, i % 10, i, f"text number {i}", f"key {i}") for i in range(40)],
        "lang string, chunk_no bigint, item_no bigint, id bigint, text_norm string, text_key string",
    )
    before = set(session._STAGES)
    resolved, responses, failed = translate_items(items, faulty, 20)
    named = [path for path in session._STAGES if path not in before]
    assert {path.rsplit("/", 1)[1][:-33] for path in named} == {"responses"}
    assert not [path for path in named[:-1] if os.path.exists(f"{path}/again=true")]
    assert "Join" not in resolved._jdf.queryExecution().optimizedPlan().toString() + failed._jdf.queryExecution().optimizedPlan().toString()
    assert resolved.columns == [*items.columns, "translation", "is_fallback"]
    got = {(r.text_key, r.translation, r.chunk_no.split("/")[0]) for r in resolved.collect()}
    assert got == {(f"key {i}", f"<text number {i}>", str(i // 10)) for i in range(40) if i != 3}
    assert responses.where("status = 'ok'").select(F.sum("n_items")).first()[0] == 39 and failed.count() == 1


def test_an_answer_in_any_order_finds_its_text(spark):
    """Ids of an answer may come in another order; each translation stays beside its own text."""
    def turned(lang, request, attempt):
        return {"raw": json.dumps([{"id": x["id"], "translation": f"<{x['text']}>"} for x in reversed(json.loads(request))])}

    items = spark.createDataFrame([("EN", 0, i, 100 - i, f"text {i}") for i in range(12)], "lang string, chunk_no bigint, item_no bigint, id bigint, text_norm string")
    got = translate_items(items, turned, 20).resolved.collect()
    assert len(got) == 12 and all(r.translation == f"<{r.text_norm}>" and r.id == 100 - r.item_no for r in got)


def test_portions_hold_whole_chunks_and_each_text_once(spark, monkeypatch):
    """Items of two languages keep one copy of a text, and sending them in portions gives what sending all at once gives."""
    from glossweave.operators.pool import language_fanout
    from glossweave.plans import by_pool

    pool = spark.range(300).select(
        F.format_string("text number %d", "id").alias("text_norm"), F.lit(0).alias("first_col"), F.col("id").alias("first_row"), F.lit("k").alias("text_key")
    ).localCheckpoint()
    pairs = language_fanout(pool, ["EN", "AR"]).where("lang = 'EN' OR first_row % 3 > 0").withColumn("tried", F.lit(0))
    whole = by_pool.chunk_misses(pairs, 7, 1000, ["text_key", "tried"])
    monkeypatch.setattr(by_pool, "PORTION_CHARS", 2_000)
    items = by_pool.chunk_misses(pairs, 7, 1000, ["text_key", "tried"], texts=pool)
    named = ["lang", "chunk_no", "item_no", "id", "text_norm", "text_key", "tried", "n_chars"]
    assert sorted(items.select(named).collect()) == sorted(whole.select(named).collect()) and items.count() == 500
    assert items.select("portion").distinct().count() > 2
    assert items.groupBy("lang", "chunk_no").agg(F.count_distinct("portion").alias("n")).where("n > 1").isEmpty()
    stored = spark.read.parquet(os.path.dirname(os.path.dirname(items.inputFiles()[0])))
    assert stored.count() < 330 and stored.select("text_norm").distinct().count() == 300
    done, once = translate_items(items, pseudo_translate, 7), translate_items(whole, pseudo_translate, 7)
    assert "portion" not in done.resolved.columns
    assert sorted(done.resolved.select("lang", "id", "text_norm", "translation").collect()) == sorted(once.resolved.select("lang", "id", "text_norm", "translation").collect())
    assert done.responses.count() == once.responses.count() and done.failed.isEmpty()
    assert by_pool.chunk_misses(pairs.where("false"), 7, 1000, texts=pool).isEmpty()
    assert translate_items(by_pool.chunk_misses(pairs.where("false"), 7, 1000, texts=pool), pseudo_translate, 7).resolved.isEmpty()


def never_better_but_one(lang, request, attempt):
    """Every text comes back as it was sent, but for those of number 7, which get no answer."""
    got = [{"id": x["id"], "translation": None if x["text"].endswith(" 7") else x["text"]} for x in json.loads(request)]
    return {"raw": json.dumps(got), "api_calls": 1}


def stage_texts(spark, named):
    """Texts in the stages that are left, by label."""
    found = {}
    for path in named:
        table = spark.read.option("recursiveFileLookup", "true").parquet(path) if os.path.exists(path) and os.listdir(path) else None
        for column in ("text_norm", "translation", "output"):
            if table is not None and column in table.columns:
                label = path.rsplit("/", 1)[1][:-33]
                found[label] = max(found.get(label, 0), table.where(f"{column} IS NOT NULL").count())
    return found


def test_a_run_stores_its_answers_once_and_portion_by_portion(spark, monkeypatch):
    """Of 60 answers, one a fallback, only the memory has all when the run has ended; the stages keep suspects and open texts."""
    from glossweave import session
    from glossweave.plans import by_pool

    monkeypatch.setattr(by_pool, "PORTION_CHARS", 500)
    frame = spark.createDataFrame(
        [(i, f"welche Frage ist das, und wie, für {i}" if i % 20 == 0 else f"a plain text of number {i}") for i in range(60)], "row_id bigint, text string"
    )
    store, before = memory(spark), set(session._STAGES)
    settings = Settings(["EN", "AR"], "m", "r", max_items=8, max_rounds=1, check_script=False)
    run = localize_pool(frame, store, never_better_but_one, settings, "one")
    named = [path for path in session._STAGES if path not in before]
    left = stage_texts(spark, named)
    assert left and max(left.values()) <= 8
    assert run.checks == [{"EN": 3, "AR": 3}, {"EN": 3, "AR": 3}]
    assert store.log().where("attempt = 0").count() == 120 and store.log().where("is_fallback").count() == 2
    assert len({f for f in store.log().where("attempt = 0 AND lang = 'EN'").inputFiles() if "batch_id=one-0" in f}) > 1
    got = {(r.row_id, r.lang): r.text for r in run.output.collect()}
    assert len(got) == 120 and all(got[r.row_id, lang] == r.text for r in frame.collect() for lang in ("EN", "AR"))


def test_a_second_run_moves_keys_and_suspects_only(spark):
    """What a run reads of the memory is judged where it lies: no stage holds the texts that are known and fine. A run of
    the name of an earlier one shows what the memory has, not what the earlier one stored first."""
    from glossweave import session

    frame = spark.createDataFrame([(i, f"Frage nummer {i}, und das ist die {i}") for i in range(40)], "row_id bigint, text string")
    store, settings = memory(spark), Settings(["EN"], "m", "r", max_rounds=1)

    def better_later(lang, request, attempt):
        got = [{"id": x["id"], "translation": x["text"] if attempt == 0 and " 3" in x["text"] else f"fine {len(x['text'])} {x['text'][14:16]}"} for x in json.loads(request)]
        return {"raw": json.dumps(got), "api_calls": 1}

    def no_call(lang, request, attempt):
        raise AssertionError("sent again")

    first = localize_pool(frame, store, better_later, settings, "same")
    assert first.checks[0]["EN"] > 0 and first.checks[-1]["EN"] == 0
    before = set(session._STAGES)
    second = localize_pool(frame, store, no_call, settings, "same")
    left = stage_texts(spark, [path for path in session._STAGES if path not in before])
    assert max(left.values(), default=0) == 0
    more = frame.unionByName(spark.createDataFrame([(100, "Ein neuer Text"), (101, "  Ein neuer   Text")], frame.schema))
    third = localize_pool(more, store, better_later, settings, "same")
    shown = lambda run: {r.row_id: r.text for r in run.output.collect()}
    assert shown(second) == shown(first) and {k: v for k, v in shown(third).items() if k < 100} == shown(first)
    assert shown(third)[100] == shown(third)[101] and shown(third)[100].startswith("fine 14")
    assert third.usage.first().api_calls == 1 and second.usage.first().api_calls == 0
