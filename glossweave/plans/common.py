"""What both strategies share: options, results, source preparation, final tables, statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions.answers import fill_answer_text, repair_answer_letter
from glossweave.functions.report import duration_text
from glossweave.functions.text import ABBREVIATION_MAX_POOL, ABBREVIATION_MAX_ROW, GERMAN, ResidueMarkers
from glossweave.operators.cells import pivot_cells
from glossweave.operators.chunks import MAX_CHARS, MAX_ITEMS, ROW_BATCH
from glossweave.operators.inference import usage_totals
from glossweave.operators.quality import MAX_ROUNDS, cell_report
from glossweave.operators.schema import (
    FORCED_DEDUP, PROTECTED, guarded_rename, normalise_header, ordered_projection, tag_language, text_columns,
)
from glossweave.sources.stages import CALLS_PER_COMMIT, RunStages


@dataclass
class Settings:
    """Options of a run; the defaults follow the documented ones."""

    langs: Sequence[str]
    model: str = "default"
    rules_id: str = ""
    row_id: str = "row_id"
    protected: Iterable[str] = PROTECTED
    never: Iterable[str] = ()
    column_order: Sequence[str] | None = None
    rename_exam_columns: bool = False
    max_items: int = MAX_ITEMS
    max_chars: int = MAX_CHARS
    abbr_max: int = ABBREVIATION_MAX_POOL
    markers: ResidueMarkers = GERMAN
    max_rounds: int = MAX_ROUNDS
    forced_dedup: Iterable[str] = FORCED_DEDUP
    row_batch: int = ROW_BATCH
    row_abbr_max: int = ABBREVIATION_MAX_ROW
    parallelism: int | None = None
    #: Also send again what came back unchanged and lacks the script of its language.
    check_script: bool = False
    #: Raise if anything got no answer; what was answered is in the memory by then.
    strict: bool = True
    #: Shared folder for the stages of runs. A run that was broken off goes on from them when it is started again with
    #: equal input and settings, and no answer that was committed is asked for again.
    resume_root: str | None = None
    calls_per_commit: int = CALLS_PER_COMMIT

    def identity(self) -> list[object]:
        """What decides about the requests of a run."""
        free = {"strict", "resume_root", "calls_per_commit", "parallelism"}
        return [(f.name, repr(sorted(v) if isinstance(v := getattr(self, f.name), (set, frozenset)) else v)) for f in fields(self) if f.name not in free]

    def stages(self, df: DataFrame, strategy: str) -> RunStages | None:
        return RunStages.of_run(self.resume_root, df, [strategy, *self.identity()]) if self.resume_root else None


@dataclass
class Run:
    """Results of a run. ``output`` has one row per source row and language.

    ``checks`` holds the suspects per language of each check, the last one being final; ``resent``
    what each retry counted as re-translated. ``failed`` lists what got no answer.
    """

    output: DataFrame
    cells: DataFrame
    suspects: DataFrame
    usage: DataFrame
    checks: list[dict[str, int]] = field(default_factory=list)
    resent: list[dict[str, int]] = field(default_factory=list)
    failed: DataFrame | None = None

    def completeness(self) -> DataFrame:
        """Counts of translated, ignored and unchanged cells per language and column, per language and in all."""
        return cell_report(self.cells)


FAILED = "lang string, text string, reason string, attempt int"


def all_failed(parts: list[DataFrame], like: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else like.sparkSession.createDataFrame([], FAILED)


def require_unique_rows(df: DataFrame, row_id: str) -> None:
    """Two rows with one id would be merged into one, so they are refused; so is a row without an id."""
    twice = df.groupBy(F.col(f"`{row_id}`").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").first()
    if twice:
        raise ValueError(f"row id {twice['id']} in column {row_id} marks {twice['n']} rows; give unique ids or use with_row_id")


def prepare_source(df: DataFrame, settings: Settings, forced: Iterable[str] = ()) -> tuple[DataFrame, list[str]]:
    """Clean header, exam names, repaired answer letters, and the columns to translate."""
    source = normalise_header(df)
    if settings.rename_exam_columns:
        source = guarded_rename(source)
    source = repair_answer_letter(source)
    columns = text_columns(source, settings.protected, settings.never, settings.column_order, forced)
    columns = [c for c in columns if c != settings.row_id]
    if not columns:
        raise ValueError("no translatable text columns")
    return source, columns


def assemble(source: DataFrame, cells: DataFrame, columns: Sequence[str], settings: Settings) -> DataFrame:
    """Final tables: source columns, translated cells, then language tag and answer texts.

    Tag and answer texts belong to the last projection, so no retry can overwrite them. Placing the
    cells by row id once serves both the pivot and the join with the source.
    """
    placed = cells.repartition("row_id")
    wide = pivot_cells(placed, columns, ("row_id", "lang"), "output").withColumnRenamed("row_id", settings.row_id)
    joined = source.drop(*columns).join(wide, settings.row_id)
    full = fill_answer_text(tag_language(joined)).select(*[F.col(f"`{c}`") for c in source.columns], "lang")
    if settings.column_order is None:
        return full
    return ordered_projection(full, [*settings.column_order, "lang"])


def count_by_language(suspects: DataFrame, langs: Sequence[str], weight: Column | None = None) -> dict[str, int]:
    """Rows per language, or the sum of ``weight``."""
    number = F.count(F.lit(1)) if weight is None else F.sum(weight)
    found = {r["lang"]: r["n"] for r in suspects.groupBy("lang").agg(number.alias("n")).collect()}
    return {lang: found.get(lang, 0) for lang in langs}


def usage_by_language(responses: list[DataFrame], like: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Usage per language, with zeros for languages that needed no call."""
    base = like.sparkSession.createDataFrame(
        [(lang, 0, 0, 0) for lang in langs], "lang string, prompt_tokens bigint, completion_tokens bigint, api_calls bigint"
    )
    return usage_totals(reduce(DataFrame.unionByName, [base, *[r.select(*base.columns) for r in responses]]))


def run_stamp(at: Column) -> Column:
    """The time of a run as the protocol shows it."""
    return F.date_format(at, "yyyy-MM-dd HH:mm")


def run_statistics(run: Run, settings: Settings, file: str, rows: int, seconds: float, temperature: str = "default", at: Column | None = None) -> DataFrame:
    """One row per language in the layout of the protocol's statistics, stamped with the time ``at`` or now."""
    spark = run.output.sparkSession
    counters = []
    for lang in settings.langs:
        found = [check[lang] for check in run.checks]
        retried = [n for n in found[:-1] if n]
        again = sum(step.get(lang, 0) for step in run.resent)
        counters.append((lang, len(retried), found[0], sum(retried), again, found[-1]))
    names = "lang string, retries bigint, deutsch_reste_auto bigint, verdachtsfaelle_gesamt bigint, neu_uebersetzt bigint, endgueltige_deutsch_reste bigint"
    joined = spark.createDataFrame(counters, names).join(run.usage, "lang")
    return joined.select(
        run_stamp(F.localtimestamp() if at is None else at).alias("datum"),
        F.lit(file).alias("datei"),
        F.col("lang").alias("sprache"),
        F.lit(settings.model).alias("modell"),
        F.lit(temperature).alias("temperatur"),
        F.lit(settings.max_items).cast("string").alias("batchgroesse"),
        F.lit("Ja").alias("parallelisierung"),
        "api_calls",
        F.col("prompt_tokens").alias("input_tokens"),
        F.col("completion_tokens").alias("output_tokens"),
        duration_text(F.lit(float(seconds))).alias("laufzeit"),
        "retries",
        F.lit(rows).cast("bigint").alias("gesamtzeilen"),
        "deutsch_reste_auto",
        "verdachtsfaelle_gesamt",
        "neu_uebersetzt",
        "endgueltige_deutsch_reste",
    )
