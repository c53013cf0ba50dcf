"""Queries on the text pool, the translation memory and work batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossweave.catalog import sql
from glossweave.catalog.inputs import MODEL, RULES, earlier_memory, line_cells, line_pool
from glossweave.catalog.registry import query, table
from glossweave.operators import chunks
from glossweave.operators.lookup import apply_memory as apply, hot_keys, map_with_fallback as map_values
from glossweave.operators.pool import build_pool as pool_of, first_appearance as rank_pool, language_fanout as fan_out
from glossweave.operators.reporting import progress_eta as progress, work_estimate as estimate
from glossweave.session import materialise, stage_path
from glossweave.sources import memory as mem

LANGS = ["EN", "AR"]
_POOL_KEYS = f"{sql.POOL}, {sql.EARLIER}, keyed AS (SELECT text_norm, lang, {sql.key('lang', 'text_norm')} AS key FROM pool, {sql.languages(*LANGS)})"


@query("build_pool", f"WITH {sql.POOL} SELECT text_norm, sha256(text_norm) AS text_key, first_col, first_row, n_cells FROM pool")
def build_pool(spark, sf_dir):
    return line_pool(spark, sf_dir)


@query("first_appearance", f"WITH {sql.POOL} SELECT text_norm, first_row, row_number() OVER (ORDER BY first_col, first_row) - 1 AS pool_id FROM pool")
def first_appearance(spark, sf_dir):
    return rank_pool(line_pool(spark, sf_dir)).select("text_norm", "first_row", "pool_id")


@query("language_fanout", f"WITH {sql.POOL} SELECT text_norm, lang FROM pool, {sql.languages('AR', 'TR', 'RU')}")
def language_fanout(spark, sf_dir):
    return fan_out(line_pool(spark, sf_dir), ["AR", "TR", "RU"]).select("text_norm", "lang")


def _keyed_pool(spark, sf_dir):
    return mem.with_memory_key(line_pool(spark, sf_dir), LANGS, MODEL, RULES).select("text_norm", "lang", "key")


@query("memory_hits", f"""
WITH {_POOL_KEYS} SELECT key, lang, text_norm, '[EN] ' || text_norm AS translation FROM keyed WHERE lang = 'EN' AND text_norm IN (SELECT text_norm FROM earlier)""")
def memory_hits(spark, sf_dir):
    return mem.memory_hits(_keyed_pool(spark, sf_dir), earlier_memory(spark, sf_dir, "EN"))


@query("memory_misses", f"""
WITH {_POOL_KEYS} SELECT key, lang, text_norm FROM keyed WHERE NOT (lang = 'EN' AND text_norm IN (SELECT text_norm FROM earlier))""")
def memory_misses(spark, sf_dir):
    return mem.memory_misses(_keyed_pool(spark, sf_dir), earlier_memory(spark, sf_dir, "EN"))


@query("resume_remaining", f"""
WITH {sql.POOL}, {sql.EARLIER} SELECT text_norm, n_cells FROM pool WHERE text_norm NOT IN (SELECT text_norm FROM earlier)""")
def resume_remaining(spark, sf_dir):
    """A run that stopped after the labelled documents: stage tables are read back, the rest is what misses."""
    from glossweave.sources.stages import RunStages

    stages = RunStages(spark, stage_path(spark, "run"))
    stages.get("memory", lambda: earlier_memory(spark, sf_dir, "EN"))
    pool = stages.get("pool", lambda: line_pool(spark, sf_dir))
    keyed = mem.with_memory_key(pool, ["EN"], MODEL, RULES)
    return mem.memory_misses(keyed, stages.get("memory", lambda: None)).select("text_norm", "n_cells")


@query("memory_upsert", f"""
WITH {sql.POOL},
first AS (SELECT DISTINCT text_norm FROM normed WHERE text_norm <> '' AND doc_id % 2 = 0),
second AS (SELECT DISTINCT text_norm FROM normed WHERE text_norm <> '' AND doc_id % 2 <> 0),
log AS (SELECT text_norm, 'first ' || text_norm AS translation, 0 AS attempt FROM first
  UNION ALL SELECT text_norm, 'second ' || text_norm, 1 FROM second)
SELECT {sql.key("'EN'", 'text_norm')} AS key, text_norm, arg_max(translation, attempt) AS translation, max(attempt) AS attempt FROM log GROUP BY text_norm""")
def memory_upsert(spark, sf_dir):
    """First the documents with even numbers, then the odd ones; the second batch is written twice."""
    memory = mem.TranslationMemory(spark, stage_path(spark, "memory"))
    even, odd = (line_cells(spark, sf_dir).where(F.col("doc_id") % 2 == 0), line_cells(spark, sf_dir).where(F.col("doc_id") % 2 != 0))

    def rows(pool, word, attempt):
        return pool.select(
            F.lit("EN").alias("lang"), F.lit(MODEL).alias("model"), F.lit(RULES).alias("rules_id"), "text_norm",
            F.concat(F.lit(word), "text_norm").alias("translation"), F.lit(False).alias("is_fallback"),
            F.lit(attempt).alias("attempt"), F.localtimestamp().alias("updated_at"),
        )

    memory.append(rows(pool_of(even), "first ", 0), "b1")
    again = materialise(pool_of(odd).select("text_norm"), "pool")
    for _ in range(2):
        memory.append(rows(again, "second ", 1), "b2")
    return memory.current(["EN"], MODEL, RULES).select("key", "text_norm", "translation", "attempt")


@query("latest_translation", """
WITH log AS (SELECT user_id || ':' || event_type AS key, props AS translation, value < 1 AS is_fallback, ts, event_id FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY is_fallback, ts DESC, translation DESC, event_id::VARCHAR DESC) AS rn FROM log)
SELECT key, translation, is_fallback, event_id::VARCHAR AS batch_id FROM ranked WHERE rn = 1""")
def latest_translation(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("key"),
        F.col("props").alias("translation"),
        (F.col("value") < 1).alias("is_fallback"),
        F.lit(0).alias("attempt"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").cast("string").alias("batch_id"),
    )
    return mem.latest_translation(log).select("key", "translation", "is_fallback", "batch_id")


@query("apply_memory", f"""
WITH {sql.POOL}, {sql.EARLIER}
SELECT c.row_id, l.lang, CASE WHEN e.text_norm IS NOT NULL THEN {sql.repair("'[' || l.lang || '] ' || e.text_norm")} ELSE c.value END AS output, e.text_norm IS NOT NULL AS is_hit
FROM cells c CROSS JOIN {sql.languages(*LANGS)} LEFT JOIN normed n ON n.row_id = c.row_id LEFT JOIN earlier e ON e.text_norm = n.text_norm""")
def apply_memory(spark, sf_dir):
    hits = earlier_memory(spark, sf_dir, *LANGS)
    hot = hot_keys(materialise(line_pool(spark, sf_dir).select("text_key", "n_cells"), "pool"), "text_key", "n_cells")
    return apply(line_cells(spark, sf_dir), hits, LANGS, hot=hot).select("row_id", "lang", "output", "is_hit")


@query("map_with_fallback", """
WITH mapping AS (SELECT p_brand, upper(p_brand) || '!' AS t FROM part GROUP BY p_brand HAVING sum(p_size) > 25 * count(*))
SELECT p_partkey, coalesce(t, part.p_brand) AS p_brand FROM part LEFT JOIN mapping USING (p_brand)""")
def map_with_fallback(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    large = parts.groupBy("p_brand").agg((F.sum("p_size") > 25 * F.count(F.lit(1))).alias("large")).where("large")
    mapping = large.select(F.col("p_brand").alias("from_value"), F.concat(F.upper("p_brand"), F.lit("!")).alias("to_value"))
    counted = parts.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return map_values(parts.drop("p_size"), "p_brand", mapping, ["p_partkey"], hot_keys(counted, "p_brand", "n"))


@query("fixed_batches", """
SELECT doc_id, lang, (row_number() OVER w - 1) // 200 AS batch_no, (row_number() OVER w - 1) % 200 AS item_no FROM documents
WINDOW w AS (PARTITION BY lang ORDER BY doc_id)""")
def fixed_batches(spark, sf_dir):
    return chunks.fixed_batches(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], ["doc_id"])


# Next-fit is stateful: one recursion step per text.
_GREEDY = """numbered AS MATERIALIZED (SELECT doc_id, lang, text, length(text) AS n, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
packed AS (
  SELECT lang, rn, 0::BIGINT AS chunk_no, 0::BIGINT AS item_no, n::BIGINT AS used FROM numbered WHERE rn = 1
  UNION ALL
  SELECT d.lang, d.rn,
    CASE WHEN p.item_no + 1 = 200 OR p.used + d.n > 18000 THEN p.chunk_no + 1 ELSE p.chunk_no END,
    CASE WHEN p.item_no + 1 = 200 OR p.used + d.n > 18000 THEN 0 ELSE p.item_no + 1 END,
    CASE WHEN p.item_no + 1 = 200 OR p.used + d.n > 18000 THEN d.n ELSE p.used + d.n END
  FROM packed p JOIN numbered d ON d.lang = p.lang AND d.rn = p.rn + 1)"""


def _packed_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.length("text").alias("n_chars"))
    return chunks.greedy_chunks(documents, ["lang"], ["doc_id"], "n_chars")


@query("greedy_chunks", f"WITH RECURSIVE {_GREEDY} SELECT d.doc_id, d.lang, p.chunk_no, p.item_no FROM packed p JOIN numbered d USING (lang, rn)")
def greedy_chunks(spark, sf_dir):
    return _packed_documents(spark, sf_dir).select("doc_id", "lang", "chunk_no", "item_no")


@query("build_requests", f"""WITH RECURSIVE {_GREEDY}
SELECT lang, chunk_no, count(*) AS n_items, sum(n)::BIGINT AS n_chars, min(doc_id) AS first_id, max(doc_id) AS last_id,
  sum(length(text) + length(doc_id::VARCHAR))::BIGINT AS n_sent FROM packed JOIN numbered USING (lang, rn) GROUP BY lang, chunk_no""")
def build_requests(spark, sf_dir):
    """The request bodies are read back, so that the check covers the JSON as well."""
    requests = chunks.text_requests(_packed_documents(spark, sf_dir), ["lang", "chunk_no"], item_id="doc_id", text="text")
    body = F.from_json("request", "ARRAY<STRUCT<id: BIGINT, text: STRING>>")
    sizes = F.transform(body, lambda x: F.length(x["text"]) + F.length(x["id"].cast("string")))
    return requests.select(
        "lang", "chunk_no", F.col("n_items").cast("bigint").alias("n_items"), "n_chars",
        F.array_min("ids").alias("first_id"), F.array_max("ids").alias("last_id"),
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_sent"),
    )


@query("split_failed_chunks", f"""WITH RECURSIVE {_GREEDY}, sized AS (SELECT *, count(*) OVER (PARTITION BY lang, chunk_no) AS size FROM packed)
SELECT d.doc_id, s.lang, s.chunk_no, CASE WHEN s.item_no + 1 <= s.size // 2 THEN 0 ELSE 1 END AS half FROM sized s JOIN numbered d USING (lang, rn)""")
def split_failed_chunks(spark, sf_dir):
    items = _packed_documents(spark, sf_dir).select("doc_id", "lang", "chunk_no", "item_no")
    return chunks.split_failed_chunks(items, ["lang", "chunk_no"]).drop("item_no")


@query("work_estimate", """
SELECT lang, count(*) AS n_rows, ceil(count(*) / 100)::BIGINT AS n_batches, ceil(count(*) / 100)::BIGINT * 7 AS n_calls FROM documents GROUP BY lang""")
def work_estimate(spark, sf_dir):
    return estimate(table(spark, sf_dir, "documents"), ["lang"], batch=100, n_langs=7)


@query("progress_eta", """
WITH log AS (SELECT event_id, event_type, ts, json_extract_string(props, '$.k')::BIGINT AS n FROM events),
running AS (SELECT event_id, event_type, sum(n) OVER (w ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS done, sum(n) OVER w::BIGINT AS total,
    (epoch_us(ts) - epoch_us(min(ts) OVER w)) / 1e6 AS elapsed FROM log WINDOW w AS (PARTITION BY event_type)),
timed AS (SELECT *, CASE WHEN done > 0 THEN (total - done) * (elapsed / done) END AS eta_seconds FROM running)
SELECT event_id, event_type, done, total, elapsed, CASE WHEN total > 0 THEN done / total * 100 ELSE 100 END AS pct, eta_seconds,
  coalesce('~' || printf('%dm%02ds', floor(eta_seconds)::BIGINT // 60, floor(eta_seconds)::BIGINT % 60), '?') AS eta FROM timed""")
def progress_eta(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("n")
    )
    timed = progress(log, ["event_type"], "ts", "event_id", "n")
    return timed.select("event_id", "event_type", "done", "total", "elapsed", "pct", "eta_seconds", "eta")
