"""Text rules on literal tables."""

import pytest
from pyspark.sql import functions as F

from glossweave.functions import text as t
from glossweave.functions.answers import fill_answer_text, repair_answer_letter
from glossweave.functions.payload import extract_payload, validate_responses
from glossweave.functions.report import duration_text, one_decimal
from glossweave.functions.rules import CONSTRAINTS, TRUNCATION_MARK, compact_rules

NBSP = " "
RULES = [
    ("", "empty", "empty"), ("  ", "empty", "empty"), ("A", "len2", "len2"), ("ab", "len2", "len2"),
    (f"{NBSP}ab ", "len2", "len2"), ("12,5", "numeric", "numeric"), ("25 %", "numeric", "numeric"),
    ("------", "numeric", "numeric"), ("١٢٣٤٥٦", "numeric", "numeric"),
    (f"1{NBSP}000 €", "unit", "unit"), ("abc", "len5", "len5"), ("C&A", "len5", "len5"), ("10 kg", "len5", "len5"),
    ("MFA-001", "code", "code"), ("Rechnung", "code", "code"), ("\u001cabcdef\u0085", "code", "code"),
    ("http://x.de a", "url", "url"), ("a@b.de x", "url", "url"), ("»«–…!?»", "punct", "punct"),
    ("ALG II", "abbr", "abbr"), ("ALG II ABC", "abbr", "abbr"), ("B/C-D & E", "abbr", "abbr"),
    ("ALG II ABCD", None, "abbr"), ("ALG II ABCDE", None, "abbr"), ("ALG II ABCDEF", None, None),
    ("Prüfung", None, None), ("siehe http://x.de", None, None), ("ä_ö-ü!!", None, None),
    ("Was ist das?", None, None), ("Müller GmbH", None, None), ("250 kg", None, None),
]
SCORES = [
    ("", 0.0), ("Was ist das?", 2.0), ("und und und", 1.0), ("öein x", 2.0),
    ("Welche Prüfung ist für die Abschlussprüfung zuständig?", 2.4074074074074074),
    ("Which exam is responsible?", 0.0), ("Hangi sınav için gönderilir?", 1.4285714285714286),
]
NORMAL = [
    ("a\r\nb\rc", "a\nb\nc"), ("a \t b", "a b"), ("a\n\n\n\nb", "a\n\nb"), (f"{NBSP} x  ", "x"), ("", ""),
    ("StraÃŸe", "Straße"), ("PrÃ¼fung", "Prüfung"), ("„ja“ ‘x’", "\"ja\" 'x'"),
    ("R&amp;D &lt;x&gt;", "R&D <x>"), ("<b>R&amp;D</b>", "<b>R&amp;D</b>"), ("a\x07b\x1cc", "abc"), ("&amp;lt;", "&lt;"),
    ("Größe Ä", "Größe Ä"), ("10 € für Ã¼", "10 € für Ã¼"),
]


def _column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("abbr_max, place", [(10, 1), (12, 2)])
def test_untranslatable_rules(spark, abbr_max, place):
    values, expected = [r[0] for r in RULES], [r[place] for r in RULES]
    assert _column(spark, values, lambda v: t.untranslatable_rule(v, abbr_max)) == expected
    assert _column(spark, values, lambda v: t.is_translatable(v, abbr_max)) == [e is None for e in expected]


def test_residue_score(spark):
    assert _column(spark, [s[0] for s in SCORES], t.residue_score) == [s[1] for s in SCORES]


def test_normalise(spark):
    assert _column(spark, [n[0] for n in NORMAL], t.normalise) == [n[1] for n in NORMAL]


def test_strip_matches_python(spark):
    values = [chr(p) + "x" + chr(p) for p in range(1, 0x3001) if not 0xD800 <= p < 0xE000]
    assert _column(spark, values, t.strip) == [v.strip() for v in values]
    blanks = [chr(p) for p in range(1, 0x3001)]
    assert _column(spark, blanks, t.non_blank) == [bool(b.strip()) for b in blanks]


def test_expected_script(spark):
    rows = [("AR", "سلام", True), ("ar", "abc", False), ("RU", "да", True), ("UK", "abc", False), ("EN", "abc", True), ("AR", " ", True)]
    got = spark.createDataFrame(rows, "lang string, v string, e boolean").select(
        "e", t.expected_script(F.col("lang"), F.col("v")).alias("x")
    )
    assert all(r.e == r.x for r in got.collect())


def test_payload_extraction(spark):
    values = ["```json\n[1]\n```", "x [1,2] y", '{"a": 1} z', "plain", "", '```\n{"a":[1]}\n```']
    assert _column(spark, values, extract_payload) == ["[1]", "[1,2]", '{"a": 1}', "plain", "", "[1]"]
    assert _column(spark, values, lambda v: extract_payload(v, False)) == ["[1]", "x [1,2] y", '{"a": 1} z', "plain", "", '{"a":[1]}']


def test_response_status(spark):
    def pair(a, b):
        return f'[{{"id":{a},"translation":"x"}},{{"id":{b},"translation":null}}]'

    rows = [
        (pair(0, 1), "ok"), ("```json\n" + pair(0, 1) + "\n```", "ok"), ("Here: " + pair(1, 0) + " done", "ok"),
        (pair('"0"', '"1"'), "ok"), (pair(0, 0), "id_mismatch"), (pair(0, 7), "id_mismatch"), (pair(0, 1)[:-5], "not_array"), (pair(0, 1)[:20], "unparsable"),
        ('{"id":0,"translation":"x"}', "not_array"), ('[{"id":0,"translation":"x"}]', "size_mismatch"), ("[1,2]", "bad_items"),
        ("[]", "size_mismatch"), (None, "unparsable"), (pair(0, 1) + ' and {"x":[2]}', "unparsable"), ("no json", "unparsable"),
    ]
    frame = spark.createDataFrame([(r, [0, 1], e) for r, e in rows], "raw string, ids array<bigint>, e string")
    wrong = [(r.raw, r.e, r.status) for r in validate_responses(frame).collect() if r.e != r.status]
    assert wrong == []


def test_row_response(spark):
    raw = '[{"row_index": 5, "fields": {"A": "x", "B": "y"}}, {"row_index": "6", "fields": {}}]'
    frame = spark.createDataFrame([(raw, [5, 6])], "raw string, ids array<bigint>")
    row = validate_responses(frame, "row").first()
    assert row.status == "ok" and row["items"][0].fields == {"A": "x", "B": "y"}


def test_answers(spark):
    rows = [
        ("x", "y", "A", ""), ("x", "y", "b", ""), ("x", "y", " B ", ""), ("x", "y", "y", "old"), ("z", "z", "z", ""),
        ("x", "y", "none", "old"), ("x", "y", "", "old"), (" x ", "y", "x", ""),
    ]
    frame = spark.createDataFrame(rows, "A string, B string, Richtig1 string, Richtig_Text1 string")
    fixed = repair_answer_letter(frame, flag="f")
    assert [r.Richtig1 for r in fixed.collect()] == ["A", "b", " B ", "B", "A", "none", "", "A"]
    assert [r.f for r in fixed.collect()] == [False, False, False, True, True, False, False, True]
    assert [r.Richtig_Text1 for r in fill_answer_text(fixed).collect()] == ["x", "y", "y", "y", "z", "", "", " x "]


def test_rules_text(spark):
    values = ["  a \n\n\t\n b\r\nc", "x" * 2499, "x" * 2500, "x" * 2501]
    expected = ["a\nb\nc", "x" * 2499, "x" * 2500, "x" * 2500 + TRUNCATION_MARK]
    assert _column(spark, values, lambda text: compact_rules(text, 2500)) == [e + CONSTRAINTS for e in expected]


def test_report_numbers(spark):
    values = [i / 40 for i in range(0, 400)] + [0.05, 0.15, 0.25, 0.35, 1.45, 2.675, 1234.55]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.x for r in frame.select(one_decimal(F.col("v")).alias("x")).collect()] == [f"{v:.1f}" for v in values]
    seconds = spark.createDataFrame([(0.0,), (59.9,), (754.2,), (7205.0,)], "v double")
    assert [r.x for r in seconds.select(duration_text(F.col("v")).alias("x")).collect()] == ["0m00s", "0m59s", "12m34s", "120m05s"]
