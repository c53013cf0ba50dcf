"""Removal of repeated passages by overlapping windows of three lines.

Every run of three consecutive lines that hold more than blanks is hashed. A window found again anywhere in the table
is removed there; only its first occurrence, by id and position, stays. Lines covered by several such windows are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import filled
from glossweave.session import materialise

BLANKS = " \t\r\x0b\x0c"


def row_key(ident: str, text: str) -> Column:
    """Orders rows by id (NULL last), then by a hash of the text; rows that repeat both share a key."""
    return F.struct(F.col(ident).isNull().alias("none"), F.col(ident).alias("id"), F.xxhash64(filled(F.col(text))).alias("h"))


def line_windows(text: Column) -> Column:
    """An array of (``h1``, ``h2``, ``low``, ``high``): hashes and first and last position of each three-line window."""
    lines = F.transform(F.split(filled(text), "\n"), lambda line, k: F.struct(k.alias("k"), F.btrim(line, F.lit(BLANKS)).alias("t")))
    solid = F.filter(lines, lambda line: line["t"] != "")

    def window(row: Column, k: Column) -> Column:
        a, b, c = (F.get(row["s"], k + i) for i in range(3))
        return F.struct(
            F.xxhash64(a["t"], b["t"], c["t"]).alias("h1"), F.xxhash64(F.lit(1), a["t"], b["t"], c["t"]).alias("h2"),
            a["k"].alias("low"), c["k"].alias("high"),
        )

    def windows(row: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(row["s"])), lambda k: k < F.size(row["s"]) - 2)
        return F.transform(starts, lambda k: window(row, k))

    return F.flatten(F.transform(F.array(F.struct(solid.alias("s"))), windows))


def repeated_ranges(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(``key``, ``covered``): positions of the lines of each row that later occurrences cover."""
    found = docs.select(row_key(ident, text).alias("key"), F.explode(line_windows(F.col(text))).alias("w"))
    found = materialise(found.select("key", "w.h1", "w.h2", F.struct("key", "w.low", "w.high").alias("at")).drop("key"), "windows")
    repeated = found.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    same_row = F.col("at.key") == F.col("first.key")
    low = F.when(same_row, F.greatest(F.col("at.low"), F.col("first.high") + 1)).otherwise(F.col("at.low"))
    later = found.join(repeated, ["h1", "h2"]).filter(F.col("at") != F.col("first"))
    ranges = later.select(F.col("at.key").alias("key"), low.alias("low"), F.col("at.high").alias("high")).filter("low <= high")
    merged = F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("low", "high")), lambda r: F.sequence(r["low"], r["high"]))))
    return ranges.groupBy("key").agg(merged.alias("covered"))


def remove_repeated_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with the covered lines taken out of ``text``; ``counts`` adds ``n_lines`` and ``n_removed``.

    A row may end up empty and stays. Texts of fewer than three lines that are not blank have no window; NULL texts stay
    NULL. Rows that repeat id and text are one occurrence and lose the same lines. Within a text, lines of the first
    occurrence stay although a later one overlaps it. An empty table stays empty.
    """
    covered = repeated_ranges(docs, ident, text).select(F.col("key").alias("__key"), F.col("covered").alias("__covered"))
    rows = docs.withColumn("__own", row_key(ident, text)).join(covered, F.col("__own") == F.col("__key"), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__covered"))
    rest = F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")
    out = rows.withColumn("__text", F.when(F.col("__covered").isNull(), F.col(text)).otherwise(rest))
    columns = [F.col("__text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        n_lines, n_removed = F.size(F.split(filled(F.col(text)), "\n")), F.greatest(F.size("__covered"), F.lit(0))
        columns += [n_lines.cast("bigint").alias("n_lines"), n_removed.cast("bigint").alias("n_removed")]
    return out.select(*columns)


REMOVED_LINES_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents
), solid AS (
  SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM lines
  WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''
), windows AS (
  SELECT doc_id, pos AS low, lead(pos, 2) OVER w AS high, t || chr(10) || lead(t, 1) OVER w || chr(10) || lead(t, 2) OVER w AS win
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY pos) QUALIFY high IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER o AS n, first_value(doc_id) OVER o AS first_doc, first_value(high) OVER o AS first_high
  FROM windows WINDOW o AS (PARTITION BY win ORDER BY doc_id, low)
), ranges AS (
  SELECT doc_id, CASE WHEN doc_id = first_doc THEN greatest(low, first_high + 1) ELSE low END AS low, high FROM ranked WHERE n > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS pos FROM ranges WHERE low <= high
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
)
"""
