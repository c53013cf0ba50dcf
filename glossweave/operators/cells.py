"""Wide table to cells and back, and cell-by-cell comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.functions.text import strip


def unpivot_cells(df: DataFrame, row_id: str, text_columns: Sequence[str]) -> DataFrame:
    """``cells(row_id, col, col_ord, value)``; NULL counts as the empty text.

    An inlined array rather than ``unpivot``: behind the latter's Expand node, generated code for
    shared subexpressions does not compile in Spark 4.1, and the text rules would run interpreted.
    """
    cells = [
        F.struct(F.lit(c).alias("col"), F.lit(i).alias("col_ord"), F.coalesce(F.col(f"`{c}`"), F.lit("")).alias("value"))
        for i, c in enumerate(text_columns)
    ]
    return df.select(F.col(row_id).alias("row_id"), F.inline(F.array(*cells)))


def pivot_cells(cells: DataFrame, text_columns: Sequence[str], keys: Sequence[str] = ("row_id", "lang"), value: str = "value") -> DataFrame:
    """One row per key again; the column names are given, so no job is needed to find them."""
    return cells.groupBy(*keys).agg(*[F.max(F.when(F.col("col") == c, F.col(value))).alias(c) for c in text_columns])


# Room for line numbers in a packed row id.
LINES_PER_DOCUMENT = 10_000_000


def document_cells(documents: DataFrame) -> DataFrame:
    """One cell per line of a document; the row id packs document and line number.

    A document or line number beyond what the packed id can hold is an error, never a shared id.
    """
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "value"))
    return lines.select(
        F.when(
            (F.col("pos") < LINES_PER_DOCUMENT) & (F.abs("doc_id") < (1 << 63) // LINES_PER_DOCUMENT),
            F.col("doc_id") * LINES_PER_DOCUMENT + F.col("pos"),
        ).otherwise(F.raise_error("document or line number too large for a packed row id")).cast("bigint").alias("row_id"),
        "doc_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.lit("text").alias("col"),
        "value",
    )


def compare_cells(source: DataFrame, output: DataFrame, keys: Sequence[str] = ("row_id", "col"), keep_dropped: bool = True) -> DataFrame:
    """Stripped input beside stripped output by cell.

    A cell without output is kept and marked ``dropped``, never counted as translated.
    """
    out = output.select(*keys, F.col("value").alias("_out"), F.lit(True).alias("_there"))
    joined = source.join(out, list(keys), "left" if keep_dropped else "inner")
    return joined.select(
        *keys,
        *[c for c in source.columns if c not in keys and c != "value"],
        strip(F.col("value")).alias("v_in"),
        strip(F.coalesce(F.col("_out"), F.lit(""))).alias("v_out"),
        F.col("_there").isNull().alias("dropped"),
    )


#: What becomes of a field of a response.
ACCEPTED, DUPLICATE, NOT_ASKED, UNKNOWN_ID = "accepted", "duplicate", "not asked", "unknown id"


def tagged_fields(cells: DataFrame, responses: DataFrame, requested: Sequence[str]) -> DataFrame:
    """``row_id, col, value, status`` of every field of ``responses(row_index, fields map)``, none left out.

    A field is accepted if its row was sent and its column asked for; of several for one cell the greatest text is, and
    the others are duplicates. Copies of a field collapse into a count before the shuffle, so that a row answered again
    and again stays small; they come out as often as they went in.
    """
    fields = responses.select(F.col("row_index").alias("row_id"), F.explode("fields").alias("col", "value"))
    distinct = fields.groupBy("row_id", "col", "value").agg(F.count(F.lit(1)).alias("n"))
    sent = cells.groupBy("row_id").agg(F.collect_set("col").alias("_sent"))
    joined = distinct.join(sent, "row_id", "left")
    asked = F.array_contains("_sent", F.col("col")) & F.col("col").isin(*requested)
    status = F.when(F.col("_sent").isNull(), UNKNOWN_ID).when(~asked, NOT_ASKED)
    best = Window.partitionBy("row_id", "col").orderBy(F.desc_nulls_last("value"))
    ranked = joined.select("row_id", "col", "value", "n", status.alias("status"), F.row_number().over(best).alias("_rank"))
    one = F.when(F.col("_rank") == 1, ACCEPTED).otherwise(DUPLICATE)
    statuses = F.transform(F.sequence(F.lit(1).cast("bigint"), "n"), lambda i: F.coalesce("status", F.when(i == 1, one).otherwise(DUPLICATE)))
    return ranked.select("row_id", "col", "value", F.explode(statuses).alias("status"))


def write_tagged(tagged: DataFrame, path: str) -> None:
    """One table with a directory per status: accepted fields and each kind of reject are read on their own."""
    tagged.write.mode("errorifexists").partitionBy("status").parquet(path)


def scatter_response(cells: DataFrame, responses: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Put the accepted fields of ``responses(row_index, fields map)`` onto cells."""
    tagged = tagged_fields(cells, responses, requested)
    fields = tagged.where(F.col("status") == ACCEPTED).select("row_id", "col", F.col("value").alias("_new"))
    return cells.join(fields, ["row_id", "col"], "left").select(
        *[F.coalesce(F.col("_new"), F.col(c)).alias(c) if c == "value" else F.col(c) for c in cells.columns]
    )
