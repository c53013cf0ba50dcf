"""Column strategy, distinct values and the pool of distinct normalised texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.functions.text import ABBREVIATION_MAX_POOL, non_blank, normalise, strip, text_key, translatable_stripped
from glossweave.operators.ordering import ordered_positions

# Fixed value: a column with at most this many distinct texts is translated once per value.
DEDUP_THRESHOLD = 400


def column_strategy(cells: DataFrame, forced: Iterable[str] = (), threshold: int = DEDUP_THRESHOLD) -> DataFrame:
    """Distinct non-blank values per column and whether to go by value or by row."""
    # 16 bytes a text, not the text, take part in the count.
    distinct = F.count_distinct(F.when(non_blank(F.col("value")), F.unhex(F.md5("value"))))
    counted = cells.groupBy("col").agg(distinct.alias("n_distinct"))
    by_value = F.col("col").isin(*forced) | F.col("n_distinct").between(1, threshold)
    return counted.withColumn("strategy", F.when(by_value, "dedup").otherwise("batch"))


def distinct_values(cells: DataFrame) -> DataFrame:
    """Distinct non-blank values per column with the first row that holds them."""
    return (
        cells.where(non_blank(F.col("value")))
        .groupBy("col", "value")
        .agg(F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("n_cells"))
    )


def translatable_cells(cells: DataFrame, abbr_max: int = ABBREVIATION_MAX_POOL) -> DataFrame:
    """Cells worth sending. The strip is computed once, then every rule reads it."""
    stripped = cells.withColumn("_v", strip(F.col("value")))
    return stripped.where(translatable_stripped(F.col("_v"), abbr_max)).drop("_v")


# First appearance is column-major: one exact number keeps it a plain hash aggregate (a struct would
# force sorting by the texts). The offset keeps negative row ids in order.
_SPAN = "100000000000000000000BD"
_OFFSET = "10000000000000000000BD"


def _first_place(col_ord: str, row_id: str):
    return F.expr(f"CAST(CAST({col_ord} AS DECIMAL(10,0)) * {_SPAN} + {_OFFSET} + {row_id} AS DECIMAL(38,0))")


def build_pool(cells: DataFrame, abbr_max: int = ABBREVIATION_MAX_POOL, texts: bool = True) -> DataFrame:
    """Distinct normalised translatable texts of ``cells(row_id, col_ord, value)``.

    Returns ``text_norm, text_key, first_col, first_row, n_cells``. Copies collapse on the map
    side, so a text that fills a third of all cells costs one row per task in the shuffle. Without ``texts`` the same rows
    have ``_h`` and ``n_chars``, hash and length, in place of the text, and only keys move.
    """
    normed = translatable_cells(cells, abbr_max).select(
        normalise(F.col("value")).alias("text_norm"), _first_place("col_ord", "row_id").alias("_place")
    )
    name, marks, key = "text_norm", [], text_key(F.col("text_norm"))
    if not texts:
        normed = normed.select(F.unhex(key).alias("_key"), F.xxhash64("text_norm").alias("_h"), F.length("text_norm").alias("n_chars"), "_place")
        name, marks, key = "_key", [F.max("_h").alias("_h")], F.lower(F.hex("_key"))
    size = F.length("text_norm") if texts else F.col("n_chars")
    # Asked of the aggregate: a filter on the text would be pushed below and normalise each cell once more.
    pooled = (
        normed.groupBy(name)
        .agg(F.min("_place").alias("_place"), F.count(F.lit(1)).alias("n_cells"), F.max(size).alias("n_chars"), *marks)
        .where("n_chars > 0")
    )
    return pooled.select(
        *(["text_norm"] if texts else []),
        key.alias("text_key"),
        F.expr(f"CAST(_place DIV {_SPAN} AS INT)").alias("first_col"),
        F.expr(f"CAST(_place % {_SPAN} - {_OFFSET} AS BIGINT)").alias("first_row"),
        "n_cells",
        *([] if texts else ["_h", "n_chars"]),
    )


def first_appearance(pool: DataFrame, position: str = "pool_id") -> DataFrame:
    """Stable 0-based rank of each pooled text: column by column, then row by row."""
    return ordered_positions(pool, [], ["first_col", "first_row", "text_key"], position=position)


def union_texts(*texts: DataFrame) -> DataFrame:
    """Distinct texts of several one-column frames."""
    merged = texts[0]
    for other in texts[1:]:
        merged = merged.unionByName(other)
    return merged.distinct()


def language_fanout(pool: DataFrame, langs: Iterable[str]) -> DataFrame:
    """Every text for every target language; the languages are a literal array, so nothing is joined."""
    return pool.withColumn("lang", F.explode(F.array(*[F.lit(x) for x in langs])))
