"""Queries on whole tables: sources, sinks, header, projections, cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossweave.catalog import sql
from glossweave.catalog.inputs import labelled_cells, line_cells
from glossweave.catalog.registry import query, table
from glossweave.operators.cells import compare_cells, pivot_cells, scatter_response, tagged_fields, unpivot_cells, write_tagged
from glossweave.operators.pool import column_strategy as strategy_of, distinct_values as distinct_of, union_texts as union_of
from glossweave.operators.schema import (
    guarded_rename as rename, normalise_header as clean_header, ordered_projection as project, parse_column_order,
    restore_protected as restore, text_columns as text_columns_of,
)
from glossweave.session import stage_path
from glossweave.plans.common import run_stamp
from glossweave.sources.delimited import csv_options, scan_delimited, scan_folder, write_by_language
from glossweave.sources.split_scan import scan_split
from glossweave.sources.protocol import PROTOCOL_COLUMNS, ProtocolTable, protocol_rows, upsert_protocol

PART_TEXTS = ["p_name", "p_brand", "p_type"]


@query("scan_delimited", """
SELECT doc_id::VARCHAR AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, n_chars::VARCHAR AS n_chars FROM documents""")
def scan_delimited_query(spark, sf_dir):
    path = stage_path(spark, "delimited")
    table(spark, sf_dir, "documents").write.options(**csv_options(";")).csv(path)
    return scan_delimited(spark, path, ";")


@query("scan_split_quoted", """
SELECT doc_id::VARCHAR AS doc_id, coalesce(replace(text, ' the ', ';' || chr(10) || '"the"' || chr(10)), '') AS text, coalesce(lang, '') AS lang, n_chars::VARCHAR AS n_chars FROM documents""")
def scan_split_quoted(spark, sf_dir):
    """Large files, whose texts hold separators, quotes and line breaks, each read by many tasks."""
    path = stage_path(spark, "quoted")
    broken = F.replace("text", F.lit(" the "), F.lit(';\n"the"\n'))
    documents = table(spark, sf_dir, "documents").select("doc_id", broken.alias("text"), "lang", "n_chars")
    documents.write.options(**csv_options(";")).csv(path)
    return scan_split(spark, path, ";")[0]


@query("write_by_language", """
SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS n_chars, count(DISTINCT doc_id) AS n_docs FROM documents GROUP BY lang""")
def write_by_language_query(spark, sf_dir):
    path = stage_path(spark, "by-language")
    write_by_language(table(spark, sf_dir, "documents"), path, order=["doc_id", "text"])
    back = scan_delimited(spark, path, ";")
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text").cast("bigint")).alias("n_chars"),
        F.count_distinct("doc_id").alias("n_docs"),
    )




def _segment_stats(customers, lang):
    return customers.groupBy(lang.alias("sprache")).agg(
        F.count(F.lit(1)).alias("api_calls"),
        F.count(F.lit(1)).alias("gesamtzeilen"),
        F.count_distinct("c_nationkey").alias("input_tokens"),
        F.lit("customers").alias("datei"),
    )


_EMPTY = [c for c in PROTOCOL_COLUMNS if c not in ("Datei", "Sprache", "Anzahl_API_Calls", "Gesamt_Input_Tokens", "Gesamtzeilen", "Manuell_korrigiert")]
_PLAIN = "'' AS " + ", '' AS ".join(f'"{c}"' for c in _EMPTY)


@query("protocol_upsert", f"""
WITH base AS (SELECT c_mktsegment || '-' || c_nationkey AS lang, c_acctbal FROM customer),
old AS (SELECT lower(lang) AS "Sprache", count(*)::VARCHAR AS n, CASE WHEN count(*) % 2 = 0 THEN 'seen ' || count(*) ELSE '  ' END AS manual FROM base GROUP BY lower(lang)),
fresh AS (SELECT lang AS "Sprache", count(*)::VARCHAR AS n FROM base WHERE c_acctbal > 8500 GROUP BY lang),
merged AS (
  SELECT f."Sprache", f.n, CASE WHEN trim(o.manual) <> '' THEN o.manual ELSE '' END AS manual FROM fresh f LEFT JOIN old o ON upper(o."Sprache") = upper(f."Sprache")
  UNION ALL SELECT * FROM old o WHERE upper("Sprache") NOT IN (SELECT upper("Sprache") FROM fresh))
SELECT 'customers' AS "Datei", "Sprache", n AS "Anzahl_API_Calls", '1' AS "Gesamt_Input_Tokens", n AS "Gesamtzeilen", manual AS "Manuell_korrigiert", {_PLAIN} FROM merged""")
def protocol_upsert(spark, sf_dir):
    lang = F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string"))
    customers = table(spark, sf_dir, "customer")
    calls = F.col("Anzahl_API_Calls").cast("bigint")
    old = protocol_rows(_segment_stats(customers, F.lower(lang))).withColumn(
        "Manuell_korrigiert", F.when(calls % 2 == 0, F.concat(F.lit("seen "), "Anzahl_API_Calls")).otherwise("  ")
    )
    new = protocol_rows(_segment_stats(customers.where(F.col("c_acctbal") > 8500), lang))
    return upsert_protocol(old, new)


@query("normalise_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def normalise_header(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return clean_header(customers.toDF(*[f" {c}\t" for c in customers.columns]))


@query("guarded_rename", """
SELECT * RENAME (l_partkey AS part, l_linestatus AS status) FROM lineitem""")
def guarded_rename(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pairs = [("l_partkey", "part"), ("l_comment", "comment"), ("l_suppkey", "l_orderkey"), ("l_linestatus", "status")]
    return rename(lines, pairs)


@query("text_columns", "SELECT p_partkey, p_name, p_brand FROM part")
def text_columns(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", *text_columns_of(parts, protected=["p_type"], order=["p_name", "p_brand", "p_size"]))


@query("ordered_projection", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders")
def ordered_projection(spark, sf_dir):
    return project(table(spark, sf_dir, "orders"), parse_column_order("o_orderpriority, o_comment ,o_orderkey,o_totalprice"))


@query("restore_protected", "SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def restore_protected(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    damaged = orders.withColumns(
        {"o_orderstatus": F.lower("o_orderstatus"), "o_totalprice": -F.col("o_totalprice"), "o_orderpriority": F.lit("?")}
    )
    return restore(damaged, orders, "o_orderkey", protected=["o_totalprice", "o_orderpriority", "o_clerk"])


@query("unpivot_cells", """
SELECT p_partkey AS row_id, col, value FROM (SELECT p_partkey, p_name, p_brand, p_type FROM part) UNPIVOT (value FOR col IN (p_name, p_brand, p_type))""")
def unpivot_cells_query(spark, sf_dir):
    return unpivot_cells(table(spark, sf_dir, "part"), "p_partkey", PART_TEXTS).drop("col_ord")


@query("pivot_cells", "SELECT p_partkey AS row_id, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type FROM part")
def pivot_cells_query(spark, sf_dir):
    cells = unpivot_cells(table(spark, sf_dir, "part"), "p_partkey", PART_TEXTS).withColumn("value", F.upper("value"))
    return pivot_cells(cells, PART_TEXTS, keys=["row_id"])


@query("compare_cells", f"""
WITH {sql.CELLS} SELECT row_id, {sql.strip('value')} AS v_in,
  CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN {sql.strip("lower(value) || '  '")} ELSE '' END AS v_out,
  doc_id NOT IN (SELECT doc_id FROM labels) AS dropped FROM cells""")
def compare_cells_query(spark, sf_dir):
    """Output exists for labelled documents only; the other cells count as dropped."""
    source = line_cells(spark, sf_dir)
    output = labelled_cells(spark, sf_dir).withColumn("value", F.concat(F.lower("value"), F.lit("  ")))
    return compare_cells(source.select("row_id", "col", "value"), output).drop("col")


@query("scatter_response", """
WITH cells AS (SELECT p_partkey AS row_id, col, value, p_size FROM (SELECT p_partkey, p_size, p_name, p_brand, p_type FROM part) UNPIVOT (value FOR col IN (p_name, p_brand, p_type)))
SELECT row_id, col, CASE WHEN p_size > 25 AND col = 'p_name' THEN upper(value) ELSE value END AS value FROM cells""")
def scatter_response_query(spark, sf_dir):
    """Large parts are answered, with a column nobody asked for, and so are rows that do not exist."""
    parts = table(spark, sf_dir, "part")
    fields = F.create_map(F.lit("p_name"), F.upper("p_name"), F.lit("p_type"), F.lit("unasked"), F.lit("extra"), F.lit("x"))
    answers = parts.where(F.col("p_size") > 25).select(F.col("p_partkey").alias("row_index"), fields.alias("fields"))
    unknown = parts.select((-1 - F.col("p_partkey")).alias("row_index"), fields.alias("fields"))
    cells = unpivot_cells(parts, "p_partkey", PART_TEXTS).drop("col_ord")
    return scatter_response(cells, answers.unionByName(unknown), ["p_name", "p_brand"])


@query("rejected_answers", """
WITH fields AS (
  SELECT p_partkey AS row_id, p_partkey AS known, p_name, p_brand FROM part WHERE p_size > 25
  UNION ALL SELECT p_partkey, p_partkey, lower(p_name), p_brand FROM part WHERE p_size > 40
  UNION ALL SELECT -1 - p_partkey, NULL, p_name, p_brand FROM part),
answers AS (
  SELECT row_id, known, 'p_name' AS col, upper(p_name) AS value FROM fields
  UNION ALL SELECT row_id, known, 'p_type', 'unasked' FROM fields UNION ALL SELECT row_id, known, 'extra', 'x' FROM fields)
SELECT row_id, col, value, CASE WHEN known IS NULL THEN 'unknown id' WHEN col <> 'p_name' THEN 'not asked'
  WHEN row_number() OVER (PARTITION BY row_id, col ORDER BY value DESC) > 1 THEN 'duplicate' ELSE 'accepted' END AS status FROM answers""")
def rejected_answers(spark, sf_dir):
    """Every field of a response with what becomes of it: large parts are answered, the largest twice, with columns that
    nobody asked for, and so are rows that do not exist."""
    parts = table(spark, sf_dir, "part")

    def answered(rows, row_index, name):
        fields = F.create_map(F.lit("p_name"), F.upper(name), F.lit("p_type"), F.lit("unasked"), F.lit("extra"), F.lit("x"))
        return rows.select(row_index.alias("row_index"), fields.alias("fields"))

    once = answered(parts.where(F.col("p_size") > 25), F.col("p_partkey"), "p_name")
    twice = answered(parts.where(F.col("p_size") > 40), F.col("p_partkey"), F.lower("p_name"))
    unknown = answered(parts, -1 - F.col("p_partkey"), "p_name")
    cells = unpivot_cells(parts, "p_partkey", PART_TEXTS).drop("col_ord")
    path = stage_path(spark, "answers")
    write_tagged(tagged_fields(cells, once.unionByName(twice).unionByName(unknown), ["p_name", "p_brand"]), path)
    return spark.read.parquet(path).select("row_id", "col", "value", "status")


def _strategy_cells(spark, sf_dir):
    part = unpivot_cells(table(spark, sf_dir, "part"), "p_partkey", PART_TEXTS)
    customer = unpivot_cells(table(spark, sf_dir, "customer"), "c_custkey", ["c_name", "c_mktsegment"])
    talk = unpivot_cells(table(spark, sf_dir, "conversations"), "conv_id", ["role", "text"])
    return part.unionByName(customer).unionByName(talk)


_STRATEGY_CELLS = """cells AS (
  SELECT p_partkey AS row_id, col, value FROM (SELECT p_partkey, p_name, p_brand, p_type FROM part) UNPIVOT (value FOR col IN (p_name, p_brand, p_type))
  UNION ALL SELECT c_custkey, col, value FROM (SELECT c_custkey, c_name, c_mktsegment FROM customer) UNPIVOT (value FOR col IN (c_name, c_mktsegment))
  UNION ALL SELECT conv_id, col, value FROM (SELECT conv_id, role, text FROM conversations) UNPIVOT (value FOR col IN (role, text)))"""


@query("column_strategy", f"""
WITH {_STRATEGY_CELLS}, counted AS (SELECT col, count(DISTINCT CASE WHEN {sql.strip('value')} <> '' THEN value END) AS n_distinct FROM cells GROUP BY col)
SELECT col, n_distinct, CASE WHEN col = 'text' OR n_distinct BETWEEN 1 AND 400 THEN 'dedup' ELSE 'batch' END AS strategy FROM counted""")
def column_strategy(spark, sf_dir):
    return strategy_of(_strategy_cells(spark, sf_dir), forced=["text"])


@query("distinct_values", f"""
WITH {_STRATEGY_CELLS} SELECT col, value, min(row_id) AS first_row, count(*) AS n_cells FROM cells WHERE {sql.strip('value')} <> '' GROUP BY col, value""")
def distinct_values(spark, sf_dir):
    return distinct_of(_strategy_cells(spark, sf_dir))


@query("union_texts", "SELECT text FROM documents UNION SELECT text FROM benchmark UNION SELECT text FROM conversations")
def union_texts(spark, sf_dir):
    return union_of(*[table(spark, sf_dir, name).select("text") for name in ("documents", "benchmark", "conversations")])


@query("scan_ragged", """
SELECT CASE WHEN doc_id % 5 <> 0 THEN doc_id::VARCHAR END AS doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang,
  CASE WHEN doc_id % 5 <> 0 THEN source END AS source,
  CASE WHEN doc_id % 5 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN doc_id || ';' || lang || ';' || source ELSE source || ';' || doc_id || ';' || lang END || ';more' END AS rejected
FROM documents""")
def scan_ragged(spark, sf_dir):
    """Files of two column orders, in which every fifth document has a field too many."""
    path = stage_path(spark, "ragged")
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "lang", "source")
    for rest, columns in ((0, ["doc_id", "lang", "source"]), (1, ["source", "doc_id", "lang"])):
        line = F.concat_ws(";", *columns, F.when(F.col("doc_id") % 5 == 0, "more"))
        rows = documents.where(F.col("doc_id") % 2 == rest).select(line.alias(";".join(columns)))
        rows.write.option("header", "true").option("sep", "|").csv(f"{path}/{rest}")
    good, bad = scan_folder(spark, path)
    missing = [F.lit(None).cast("string").alias(c) for c in ("doc_id", "lang", "source")]
    return good.select("doc_id", "lang", "source", F.lit(None).cast("string").alias("rejected")).unionByName(
        bad.select(*missing, F.col("row").alias("rejected"))
    )


_EVENT_STATS = """SELECT event_type AS "Datei", 'L' || user_id % 5 AS "Sprache", strftime(max(ts), '%Y-%m-%d %H:%M') AS "Datum", count(*)::VARCHAR AS "Anzahl_API_Calls"
  FROM events WHERE {chosen} GROUP BY ALL"""


@query("protocol_table", f"""
WITH first AS ({_EVENT_STATS.format(chosen="true")}), second AS ({_EVENT_STATS.format(chosen="user_id % 5 < 2 AND value > 50")})
SELECT * FROM second UNION ALL SELECT f.* FROM first f ANTI JOIN second s USING ("Datei", "Sprache")""")
def protocol_table(spark, sf_dir):
    """Rows of several files and languages in one table: all events, then a later run for two of the languages, which
    replaces their rows; an empty run changes nothing."""
    protocol = ProtocolTable(spark, stage_path(spark, "protocol"))
    events = table(spark, sf_dir, "events")
    for chosen in (events, events.where((F.col("user_id") % 5 < 2) & (F.col("value") > 50))):
        stats = chosen.groupBy(
            F.col("event_type").alias("datei"), F.concat(F.lit("L"), (F.col("user_id") % 5).cast("string")).alias("sprache")
        ).agg(run_stamp(F.max("ts")).alias("datum"), F.count(F.lit(1)).alias("api_calls"))
        protocol.upsert(protocol_rows(stats))
    protocol.upsert(protocol.read().limit(0))
    return protocol.read().select("Datei", "Sprache", "Datum", "Anzahl_API_Calls")
