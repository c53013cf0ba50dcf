"""Quality checks on translated cells: suspects, completeness, samples, counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossweave.functions.text import (
    ABBREVIATION_MAX_POOL, ABBREVIATION_MAX_ROW, GERMAN, ResidueMarkers, expected_script, residue_at_least, residue_at_least_once, strip, translatable_stripped,
)
from glossweave.operators.ordering import null_safe_join

# When an output still looks like the source language, and the retry limit.
SUSPECT_SCORE = 1.2
SUSPECT_LENGTH = 6
RESEND_OUTPUT_SCORE = 1.0
MAX_ROUNDS = 4
SAMPLE_ROWS = 20


def checked_cells(compared: DataFrame, abbr_max: int) -> DataFrame:
    """Compared cells ``(v_in, v_out)`` with non-blank input, marked ``ignored`` when untranslatable."""
    return compared.where(F.col("v_in") != "").withColumn(
        "ignored", ~translatable_stripped(F.col("v_in"), abbr_max)
    )


def suspect_equal(compared: DataFrame, abbr_max: int = ABBREVIATION_MAX_ROW) -> DataFrame:
    """Translatable cells that came back unchanged."""
    return checked_cells(compared.where(F.col("v_in") == F.col("v_out")), abbr_max).where(~F.col("ignored")).drop("ignored")


def residue_score(v_out: Column, markers: ResidueMarkers = GERMAN) -> Column:
    """The score of a stripped output, 0 below the mark of a suspect."""
    return residue_at_least(v_out, SUSPECT_SCORE, markers)


def reads_like_source(v_out: Column, score: Column) -> Column:
    return (F.length(v_out) >= SUSPECT_LENGTH) & (score > 0)


def looks_untranslated(v_out: Column, markers: ResidueMarkers = GERMAN) -> Column:
    return reads_like_source(v_out, residue_score(v_out, markers))


def lacks_script(lang: Column, v_in: Column, v_out: Column) -> Column:
    """An unchanged cell without the script of its target language."""
    return (v_in == v_out) & ~expected_script(lang, v_out)


def suspect_residue(compared: DataFrame, abbr_max: int = ABBREVIATION_MAX_POOL, markers: ResidueMarkers = GERMAN) -> DataFrame:
    """Translatable cells whose output still reads like the source language."""
    # The filter is pushed to where the outputs are read, so it must not compute them for each of its marks.
    score = residue_at_least_once(F.col("v_out"), SUSPECT_SCORE, markers)
    return checked_cells(compared.where(reads_like_source(F.col("v_out"), score)), abbr_max).where(~F.col("ignored")).drop("ignored")


def suspect_script(compared: DataFrame, abbr_max: int = ABBREVIATION_MAX_POOL) -> DataFrame:
    """Unchanged translatable cells that lack the script of their target language."""
    wrong = lacks_script(F.col("lang"), F.col("v_in"), F.col("v_out"))
    return checked_cells(compared.where(wrong), abbr_max).where(~F.col("ignored")).drop("ignored")


def completeness_report(
    compared: DataFrame, keys: Sequence[str] = ("lang",), abbr_max: int = ABBREVIATION_MAX_ROW, row_key: str = "row_id", rollup: bool = False
) -> DataFrame:
    """Rows, cells, translated, ignored, suspect, dropped and percent per key.

    With ``rollup`` also per prefix of the keys and in all, in one pass; ``level`` is the number of keys that count.
    """
    filled = F.col("v_in") != ""
    ignored = ~translatable_stripped(F.col("v_in"), abbr_max)
    marked = compared.select(
        *keys,
        row_key,
        F.when(~filled, "blank")
        .when(F.col("dropped"), "dropped")
        .when(F.col("v_in") != F.col("v_out"), "translated")
        .when(ignored, "ignored")
        .otherwise("suspect")
        .alias("_kind"),
    )

    def count(kind: str) -> Column:
        return F.count_if(F.col("_kind") == kind)

    figures = [
        F.count_distinct(row_key).alias("rows"),
        F.count_if(F.col("_kind") != "blank").alias("cells"),
        *[count(kind).alias(kind) for kind in ("translated", "ignored", "suspect", "dropped")],
    ]
    if rollup:
        # The grouping id has a bit for each key that does not count.
        level = F.lit(len(keys)) - F.bit_count(F.grouping_id())
        counted = marked.rollup(*keys).agg(*figures, level.cast("int").alias("level"))
    else:
        counted = marked.groupBy(*keys).agg(*figures)
    done = (F.col("translated") + F.col("ignored")) / F.col("cells") * 100
    return counted.withColumn("percent", F.when(F.col("cells") > 0, done).otherwise(F.lit(100.0)))


def cell_report(cells: DataFrame, keys: Sequence[str] = ("lang", "col"), abbr_max: int = ABBREVIATION_MAX_ROW) -> DataFrame:
    """The rolled-up report of the output cells of a run, ``(row_id, col, lang, value, output)``."""
    shown = cells.select("row_id", *keys, strip(F.col("value")).alias("v_in"), strip(F.col("output")).alias("v_out"), F.lit(False).alias("dropped"))
    return completeness_report(shown, keys, abbr_max, rollup=True)


def suspect_sample(suspects: DataFrame, width: int = 80, rows: int = SAMPLE_ROWS, keys: Sequence[str] = ("lang",), order: Sequence[str] = ("row_id", "col_ord")) -> DataFrame:
    """The first suspects per key with cut texts, and how many more there are.

    The rank limit is applied inside each task before the shuffle, so a key never travels whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = suspects.withColumn("rank", rank).where(F.col("rank") <= rows)
    totals = suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    return null_safe_join(first, totals, keys).select(
        *keys,
        "row_id",
        "col",
        "rank",
        F.left("v_in", F.lit(width)).alias("v_in"),
        F.left("v_out", F.lit(width)).alias("v_out"),
        F.greatest(F.col("_all") - rows, F.lit(0)).alias("n_more"),
    )


def suspects_by_row(suspects: DataFrame, keys: Sequence[str] = ("row_id",)) -> DataFrame:
    """Suspect columns of each row; a row has no more of them than the table has columns."""
    return suspects.groupBy(*keys).agg(F.sort_array(F.collect_set("col")).alias("cols"))


def qa_counters(rounds: DataFrame, keys: Sequence[str] = ("lang",)) -> DataFrame:
    """Run counters from ``rounds(lang, round, n_suspects)``, where the last check has the highest round.

    A round is retried when it found suspects and another check follows.
    """
    last = F.max("round").over(Window.partitionBy(*keys))
    marked = rounds.withColumn("_retried", (F.col("round") < last) & (F.col("n_suspects") > 0))
    again = F.when(F.col("_retried"), F.col("n_suspects")).otherwise(0)
    return marked.groupBy(*keys).agg(
        F.min_by("n_suspects", "round").alias("first_suspects"),
        F.sum(again).alias("sum_suspects"),
        F.count_if("_retried").alias("retry_rounds"),
        F.max_by("n_suspects", "round").alias("final_suspects"),
    )
