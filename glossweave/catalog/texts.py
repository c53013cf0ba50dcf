"""Queries on single texts: filters, scalar functions, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossweave.catalog import sql
from glossweave.catalog.inputs import ANSWER_SQL, FIXED_SQL, answer_table, line_cells
from glossweave.catalog.registry import query, table
from glossweave.functions.answers import fill_answer_text, repair_answer_letter
from glossweave.functions.payload import extract_payload, validate_responses
from glossweave.functions.report import duration_text, recommendations
from glossweave.functions.rules import CONSTRAINTS, RULES_LIMIT, compact_rules as compact, rules_id
from glossweave.functions.text import (
    ABBREVIATION_MAX_POOL, ABBREVIATION_MAX_ROW, expected_script, memory_key as key_of, non_blank, normalise, repair,
    residue_score as score, rule_of_stripped, strip,
)
from glossweave.operators.reporting import elapsed_seconds
from glossweave.sources.delimited import sniff_separator


@query("sniff_delimiter", """
SELECT doc_id, CASE WHEN length(h) - length(replace(h, ';', '')) >= length(h) - length(replace(h, ',', ''))
  THEN ';' ELSE ',' END AS separator
FROM (SELECT doc_id, left(text, 4096) AS h FROM documents)""")
def sniff_delimiter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sniff_separator(F.col("text")).alias("separator"))


@query("non_blank_cells", f"""
WITH {sql.CELLS}, variants AS (
  SELECT row_id, 'line' AS kind, value FROM cells
  UNION ALL SELECT row_id, 'emptied', regexp_replace(value, '[^ ]', chr(160), 'g') || chr(9) FROM cells
  UNION ALL SELECT row_id, 'wrapped', chr(28) || value || chr(8195) FROM cells)
SELECT row_id, kind FROM variants WHERE {sql.strip('value')} <> ''""")
def non_blank_cells(spark, sf_dir):
    line = F.col("value")
    kinds = F.create_map(
        F.lit("line"), line,
        F.lit("emptied"), F.concat(F.regexp_replace(line, "[^ ]", " "), F.lit("\t")),
        F.lit("wrapped"), F.concat(F.lit("\x1c"), line, F.lit(" ")),
    )
    variants = line_cells(spark, sf_dir).select("row_id", F.explode(kinds).alias("kind", "value"))
    return variants.where(non_blank(F.col("value"))).select("row_id", "kind")


@query("classify_untranslatable", f"""
WITH tokens AS MATERIALIZED (SELECT value, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS value FROM documents) GROUP BY value),
stripped AS (SELECT value, n, {sql.strip('value')} AS v FROM tokens)
SELECT value, n, coalesce({sql.rule('v', 10)}, 'translate') AS rule_row, coalesce({sql.rule('v', 12)}, 'translate') AS rule_pool
FROM stripped""")
def classify_untranslatable(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("value"))
    counted = tokens.groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("_v", strip(F.col("value")))

    def named(abbr_max):
        return F.coalesce(rule_of_stripped(F.col("_v"), abbr_max), F.lit("translate"))

    return counted.select(
        "value", "n", named(ABBREVIATION_MAX_ROW).alias("rule_row"), named(ABBREVIATION_MAX_POOL).alias("rule_pool")
    )


@query("script_check", f"""
WITH texts AS (SELECT doc_id, CASE lang WHEN 'de' THEN text || ' ' || chr(1078) WHEN 'es' THEN text || ' ' || chr(1587) ELSE text END AS t FROM documents)
SELECT doc_id, l.lang, CASE WHEN {sql.strip('t')} = '' THEN true
  WHEN l.lang = 'AR' THEN regexp_matches(t, '[\\x{{0600}}-\\x{{06FF}}]')
  WHEN l.lang IN ('RU', 'UK') THEN regexp_matches(t, '[\\x{{0400}}-\\x{{04FF}}]') ELSE true END AS ok
FROM texts, {sql.languages('AR', 'RU', 'UK', 'EN')}""")
def script_check(spark, sf_dir):
    tail = F.when(F.col("lang") == "de", " ж").when(F.col("lang") == "es", " س").otherwise("")
    texts = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", tail).alias("text"))
    fanned = texts.withColumn("lang", F.explode(F.array(*[F.lit(x) for x in ("AR", "RU", "UK", "EN")])))
    return fanned.select("doc_id", "lang", expected_script(F.col("lang"), F.col("text")).alias("ok"))


_DIRTY_SQL = """replace(replace(replace(text, ' ', chr(9) || ' '), chr(10), chr(13) || chr(10) || chr(13) || chr(10) || chr(10)), ',', '’„ &amp;')"""


@query("normalise_text", f"""
WITH dirty AS (SELECT doc_id, text, {_DIRTY_SQL} AS d FROM documents)
SELECT doc_id, {sql.normalise('text')} AS clean, {sql.normalise('d')} AS repaired FROM dirty""")
def normalise_text(spark, sf_dir):
    dirty = F.replace(F.col("text"), F.lit(" "), F.lit("\t "))
    dirty = F.replace(dirty, F.lit("\n"), F.lit("\r\n\r\n\n"))
    dirty = F.replace(dirty, F.lit(","), F.lit("’„ &amp;"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", normalise(F.col("text")).alias("clean"), normalise(dirty).alias("repaired")
    )


_TITLE = "<title>([^<]*)</title>"


@query("repair_text", f"""
WITH titles AS (SELECT page_id, regexp_extract(html, '{_TITLE}', 1) AS t FROM pages),
variants AS (
  SELECT page_id, 'title' AS kind, t FROM titles
  UNION ALL SELECT page_id, 'misread', t FROM titles
  UNION ALL SELECT page_id, 'quoted', '„' || t || '“' || chr(7) FROM titles
  UNION ALL SELECT page_id, 'page', html FROM pages
  UNION ALL SELECT doc_id, 'document', '“' || replace(text, ' ', ' &amp; ') FROM documents)
SELECT page_id, kind, {sql.repair('t')} AS repaired FROM variants""")
def repair_text(spark, sf_dir):
    """Titles, whole pages and whole documents. The ``misread`` variant is a title whose UTF-8 bytes were read as Latin-1; repair must restore it."""
    title = F.regexp_extract("html", _TITLE, 1)
    kinds = F.create_map(
        F.lit("title"), F.col("t"),
        F.lit("misread"), F.decode(F.encode("t", "UTF-8"), "ISO-8859-1"),
        F.lit("quoted"), F.concat(F.lit("„"), F.col("t"), F.lit("“\x07")),
        F.lit("page"), F.col("html"),
    )
    variants = table(spark, sf_dir, "pages").withColumn("t", title).select("page_id", F.explode(kinds).alias("kind", "t"))
    joined = F.concat(F.lit("“"), F.replace(F.col("text"), F.lit(" "), F.lit(" &amp; ")))
    whole = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.lit("document").alias("kind"), joined.alias("t"))
    return variants.unionByName(whole).select("page_id", "kind", repair(F.col("t")).alias("repaired"))


@query("residue_score", f"""
WITH {sql.CELLS} SELECT row_id, length(value)::BIGINT AS n_chars, {sql.residue('value')} AS score FROM cells""")
def residue_score(spark, sf_dir):
    return line_cells(spark, sf_dir).select(
        "row_id", F.length("value").cast("bigint").alias("n_chars"), score(F.col("value")).alias("score")
    )


@query("memory_key", """
SELECT doc_id, sha256('EN|m1|' || left(sha256(source), 16) || '|' || text) AS key, left(sha256(source), 16) AS rules_id FROM documents""")
def memory_key(spark, sf_dir):
    rules = rules_id(F.col("source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", key_of(F.lit("EN"), F.lit("m1"), rules, F.col("text")).alias("key"), rules.alias("rules_id")
    )


@query("compact_rules", f"""
WITH short AS (
  SELECT doc_id, text, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql.strip('x')}), lambda x: x <> ''), chr(10)) AS s
  FROM documents)
SELECT doc_id, CASE WHEN length(s) > 2500 THEN left(s, 2500) || chr(10) || '[TRUNCATED_RULES]' ELSE s END || '{CONSTRAINTS}' AS prompt,
  left(sha256(text), 16) AS rules_id, greatest(length(s) - 2500, 0) AS n_cut, s || '{CONSTRAINTS}' AS uncut FROM short""")
def compact_rules(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        compact(F.col("text"), RULES_LIMIT).alias("prompt"),
        rules_id(F.col("text")).alias("rules_id"),
        F.greatest(F.length(compact(F.col("text"))) - len(CONSTRAINTS) - RULES_LIMIT, F.lit(0)).cast("bigint").alias("n_cut"),
        compact(F.col("text")).alias("uncut"),
    )


_FENCE = "CASE doc_id % 4 WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```' WHEN 1 THEN 'Result: ' || body || ' done' WHEN 2 THEN '  ' || substr(body, 2, length(body) - 2) || chr(160) ELSE '```' || body END"


@query("extract_payload", f"""
WITH bodies AS (SELECT doc_id, '[{{"id":' || doc_id || ',"translation":' || to_json(text)::VARCHAR || '}}]' AS body FROM documents),
raws AS (SELECT doc_id, {sql.strip(_FENCE)} AS t FROM bodies),
open AS (SELECT doc_id, CASE WHEN starts_with(t, '```') THEN
  {sql.strip(r"regexp_replace(regexp_replace(t, '\A```[a-zA-Z]*[\s]*', ''), '[\s]*```\z', '')")} ELSE t END AS u FROM raws)
SELECT doc_id, u AS unfenced, CASE WHEN regexp_extract(u, '(?s)\\[.*\\]', 0) <> '' THEN regexp_extract(u, '(?s)\\[.*\\]', 0)
  WHEN regexp_extract(u, '(?s)\\{{.*\\}}', 0) <> '' THEN regexp_extract(u, '(?s)\\{{.*\\}}', 0) ELSE u END AS payload FROM open""")
def extract_payload_query(spark, sf_dir):
    body = F.to_json(F.array(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("translation"))))
    kind = F.col("doc_id") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit("```json\n"), "body", F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit("Result: "), "body", F.lit(" done")))
        .when(kind == 2, F.concat(F.lit("  "), F.expr("substr(body, 2, length(body) - 2)"), F.lit(" ")))
        .otherwise(F.concat(F.lit("```"), "body"))
    )
    raws = table(spark, sf_dir, "documents").select("doc_id", body.alias("body")).select("doc_id", raw.alias("raw"))
    return raws.select(
        "doc_id",
        extract_payload(F.col("raw"), widest_block=False).alias("unfenced"),
        extract_payload(F.col("raw")).alias("payload"),
    )


@query("validate_responses", f"""
WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
items AS (SELECT doc_id, len(ls) AS n, list_transform(ls, lambda x, i: CASE WHEN doc_id % 9 = 6
    THEN '{{"id":"' || (i - 1) || '","translation":' || to_json(x)::VARCHAR || '}}'
    ELSE '{{"id":' || CASE WHEN doc_id % 9 = 7 THEN 0 ELSE i - 1 END || ',"translation":' || to_json(x)::VARCHAR || '}}' END) AS js FROM lines),
bodies AS (SELECT doc_id, n, '[' || array_to_string(CASE WHEN doc_id % 9 = 5 THEN js[1:len(js) - 1] ELSE js END, ',') || ']' AS b, js FROM items),
raws AS (SELECT doc_id, n, CASE doc_id % 9 WHEN 1 THEN '```json' || chr(10) || b || chr(10) || '```' WHEN 2 THEN 'Here: ' || b || ' Bye.'
    WHEN 3 THEN left(b, length(b) - 3) WHEN 4 THEN js[1] WHEN 8 THEN '[' || array_to_string(list_transform(js, lambda x, i: i::VARCHAR), ',') || ']' ELSE b END AS t FROM bodies),
open AS (SELECT doc_id, n, CASE WHEN starts_with(t, '```') THEN regexp_replace(regexp_replace(t, '\\A```[a-zA-Z]*\\s*', ''), '\\s*```\\z', '') ELSE t END AS u FROM raws),
pays AS (SELECT doc_id, n, CASE WHEN regexp_extract(u, '(?s)\\[.*\\]', 0) <> '' THEN regexp_extract(u, '(?s)\\[.*\\]', 0)
  WHEN regexp_extract(u, '(?s)\\{{.*\\}}', 0) <> '' THEN regexp_extract(u, '(?s)\\{{.*\\}}', 0) ELSE u END AS p FROM open),
typed AS (SELECT doc_id, n, p, CASE WHEN json_valid(p) THEN json_type(p) END AS ty, CASE WHEN json_valid(p) AND json_type(p) = 'ARRAY' THEN p END AS a FROM pays)
SELECT doc_id, n::BIGINT AS n_items, CASE
  WHEN ty IS NULL THEN 'unparsable' WHEN ty = 'OBJECT' THEN 'not_array'
  WHEN json_array_length(a) <> n THEN 'size_mismatch'
  WHEN len(list_filter(json_extract(a, '$[*]'), lambda x: json_type(x) <> 'OBJECT')) > 0 THEN 'bad_items'
  WHEN list_sort(list_transform(json_extract_string(a, '$[*].id'), lambda x: try_cast(x AS BIGINT))) = range(0, n) THEN 'ok'
  ELSE 'id_mismatch' END AS status FROM typed""")
def validate_responses_query(spark, sf_dir):
    """Each document is a chunk of its lines; nine kinds of response take turns."""
    kind = F.col("doc_id") % 9
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("ls"))

    def item(text, at):
        ident = F.when(kind == 7, 0).otherwise(at).cast("string")
        quoted = F.when(kind == 6, F.concat(F.lit('"'), ident, F.lit('"'))).otherwise(ident)
        rest = F.substring(F.to_json(F.struct(text.alias("translation"))), 2, 2_000_000_000)
        return F.concat(F.lit('{"id":'), quoted, F.lit(","), rest)

    js = lines.select("doc_id", F.size("ls").alias("n"), F.transform("ls", item).alias("js"))
    kept = F.when(kind == 5, F.slice("js", 1, F.col("n") - 1)).otherwise(F.col("js"))
    bodies = js.withColumn("b", F.concat(F.lit("["), F.array_join(kept, ","), F.lit("]")))
    numbers = F.concat(F.lit("["), F.array_join(F.transform("js", lambda x, i: (i + 1).cast("string")), ","), F.lit("]"))
    raw = (
        F.when(kind == 1, F.concat(F.lit("```json\n"), "b", F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("Here: "), "b", F.lit(" Bye.")))
        .when(kind == 3, F.expr("left(b, length(b) - 3)"))
        .when(kind == 4, F.col("js")[0])
        .when(kind == 8, numbers)
        .otherwise(F.col("b"))
    )
    responses = bodies.select("doc_id", "n", raw.alias("raw"), F.expr("sequence(0L, n - 1L)").alias("ids"))
    return validate_responses(responses).select("doc_id", F.col("n").cast("bigint").alias("n_items"), "status")


@query("repair_answer_letter", f"WITH {FIXED_SQL} SELECT row_id, A, B, C, D, Richtig1, was_fixed FROM fixed")
def repair_answer_letter_query(spark, sf_dir):
    fixed = repair_answer_letter(answer_table(spark, sf_dir), flag="was_fixed")
    return fixed.select("row_id", "A", "B", "C", "D", "Richtig1", "was_fixed")


@query("fill_answer_text", f"""
WITH {ANSWER_SQL}, filled AS (
  SELECT row_id, Richtig1, CASE upper(trim(Richtig1)) WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE '' END AS t FROM answers)
SELECT row_id, Richtig1, t AS Richtig_Text1, t AS Richtig1_Text FROM filled""")
def fill_answer_text_query(spark, sf_dir):
    return fill_answer_text(answer_table(spark, sf_dir)).select("row_id", "Richtig1", "Richtig_Text1", "Richtig1_Text")


@query("format_duration", """
WITH spans AS (SELECT user_id, floor(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 + 1e-9)::BIGINT AS s, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events GROUP BY user_id)
SELECT user_id, (us // 1000000)::BIGINT AS seconds, printf('%dm%02ds', us // 1000000 // 60, us // 1000000 % 60) AS duration FROM spans""")
def format_duration(spark, sf_dir):
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    seconds = elapsed_seconds("a", "b")
    return spans.select("user_id", F.floor(seconds).cast("bigint").alias("seconds"), duration_text(seconds).alias("duration"))


def _joined(default: str, *hints: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN {text} END" for condition, text in hints)
    return f"coalesce(nullif(concat_ws(' | ', {cases}), ''), {default})"


_RATIO = "(tokens_out / tokens_in)"
_HAS = "tokens_in > 0 AND tokens_out > 0"
_SHOWN = f"printf('%.1f', CASE WHEN {_HAS} THEN {_RATIO} ELSE 1 END)"
W = sql.wording


@query("run_recommendations", f"""
WITH stats AS (SELECT l_suppkey AS lang, count_if(l_discount > 0.09) AS reste, count_if(l_discount > 0.08) AS first,
    count(DISTINCT l_linenumber) - 4 AS retries, count(*) AS calls,
    sum(l_quantity)::BIGINT * 17 AS tokens_in, sum(l_linenumber)::BIGINT * 100 AS tokens_out FROM lineitem GROUP BY l_suppkey)
SELECT lang,
  {_joined(W('technical_none'), ("reste > 0", W('left', 'reste', 'retries')), ("retries >= 3", W('retries', 'retries')),
           (f"{_HAS} AND {_RATIO} > 1.5", W('ratio_high', _SHOWN)), (f"{_HAS} AND {_RATIO} < 0.3", W('ratio_low', _SHOWN)))} AS technical,
  {_joined(W('prompt_none'), ("reste > 10", W('many_left')), ("first > 0 AND retries > 0 AND reste = first", W('no_progress')))} AS prompt,
  {_joined(W('pipeline_none'), ("calls > 200", W('calls', 'calls')), ("retries >= 2 AND reste < first", W('effective', 'first', 'reste')))} AS run,
  {_joined(W('next_none'), ("reste > 0", W('rerun', 'lang', 'reste')), ("reste = 0 AND retries = 0", W('perfect')),
           ("reste = 0 AND retries > 0", W('fine', 'retries')),
           ("tokens_in + tokens_out > 500000", W('tokens', "format('{:,}', tokens_in + tokens_out)")))} AS following
FROM stats""")
def run_recommendations(spark, sf_dir):
    stats = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("lang")).agg(
        F.count_if(F.col("l_discount") > 0.09).alias("reste"),
        F.count_if(F.col("l_discount") > 0.08).alias("first"),
        (F.count_distinct("l_linenumber") - 4).alias("retries"),
        F.count(F.lit(1)).alias("calls"),
        (F.sum("l_quantity").cast("bigint") * 17).alias("tokens_in"),
        (F.sum("l_linenumber") * 100).alias("tokens_out"),
    )
    texts = recommendations(*[F.col(c) for c in ("lang", "reste", "first", "retries", "calls", "tokens_in", "tokens_out")])
    return stats.select("lang", *[text.alias(name) for name, text in zip(("technical", "prompt", "run", "following"), texts.values())])
