"""Column roles, header clean-up and projections; all decided from names, without a job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that are never translated, and the exam columns with their later names.
PROTECTED = (
    "lfdNr", "FrageNr", "BerufNr", "Beruf", "LFNr", "AbschnNr", "Nr", "Richtig1", "Richtig2",
    "Schwierigkeit", "Sprache", "Richtig_Text1", "Richtig1_Text", "Richtig_Text2",
    "Abschlussprüfung Teil 1", "Abschlussprüfung Teil 2", "Lehrjahr", "Zwischenprüfung", "Abschlussprüfung",
)
FORCED_DEDUP = ("LF", "Abschnitt")
EXAM_NAMES = (("Zwischenprüfung", "Abschlussprüfung Teil 1"), ("Abschlussprüfung", "Abschlussprüfung Teil 2"))
LANGUAGE_COLUMN = "Sprache"


def normalise_header(df: DataFrame) -> DataFrame:
    """Trim the column names; names that become equal are an error."""
    names = [c.strip() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"duplicate column names after trimming: {twice}")
    return df.toDF(*names)


def guarded_rename(df: DataFrame, pairs: Iterable[tuple[str, str]] = EXAM_NAMES) -> DataFrame:
    """Rename each source that exists and whose target does not; judged on the header as given."""
    present = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in pairs if old in present and new not in present})


def parse_column_order(text: str | None) -> list[str] | None:
    """Names split on ``;``, or on ``,`` when ``;`` yields at most one."""
    if not text:
        return None

    def pieces(sep: str) -> list[str]:
        return [p.strip() for p in text.split(sep) if p.strip()]

    names = pieces(";")
    if len(names) <= 1 and "," in text:
        names = pieces(",")
    return names or None


def ordered_projection(df: DataFrame, order: Sequence[str] | None) -> DataFrame:
    """Only the listed columns that exist, in list order."""
    return df if order is None else df.select(*[_quoted(c) for c in order if c in df.columns])


def text_columns(
    df: DataFrame,
    protected: Iterable[str] = PROTECTED,
    never: Iterable[str] = (),
    order: Sequence[str] | None = None,
    forced: Iterable[str] = (),
) -> list[str]:
    """String columns minus protected, never-translate and left-out ones, then forced ones appended."""
    closed = {*protected, *never}
    if order is not None:
        closed |= set(df.columns) - set(order)
    found = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in closed]
    return found + [c for c in forced if c in df.columns and c not in found]


def restore_protected(output: DataFrame, source: DataFrame, row_id: str, protected: Iterable[str] = PROTECTED) -> DataFrame:
    """Take the protected columns from ``source`` by row id, everything else from ``output``."""
    wanted = {*protected} - {row_id}
    shared = [c for c in output.columns if c in wanted and c in source.columns]
    kept = output.drop(*shared)
    return kept.join(source.select(row_id, *shared), row_id, "left").select(*[_quoted(c) for c in output.columns])


def tag_language(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Lower-case language code into the language column, where the table has one."""
    return df.withColumn(LANGUAGE_COLUMN, F.lower(F.col(lang))) if LANGUAGE_COLUMN in df.columns else df


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")
